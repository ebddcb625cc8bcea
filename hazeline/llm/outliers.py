"""Quality rules by robust multivariate outliers: minimum covariance determinant.

Every text gives five transformed statistics. Per language and source, concentration steps
look for the half of the vectors with the smallest covariance determinant, from three starts;
a row far from its centre by Mahalanobis distance is rejected. Only Spark's own functions run.

Starts are medians with quartile ranges, the shortest halves of each statistic, and plain means
with covariances. After ``TRIED`` steps the start with the smallest determinant goes on; its
half, scaled for consistency, then weighs the rows once: those within ``NEAR`` give the result.
Equal vectors count once, so that a text copied many times is no dense half of its own; up to
nearly half of the other vectors of a group may be junk.

A step is one pass over small rows: distances are counted in bins per group together with the
sums that mean and covariance need, so no group is ever sorted or held by one task, and the
rows of the nearest bins that hold the half make up the next estimate. Groups of fewer than
``MIN_GROUP`` vectors are pooled by language, then all together; a pool still too small rejects
nothing. Covariances get a floor per statistic, as many statistics are zero for most texts.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.plans.staging import stage

MIN_WORDS, WINDOW_WORDS, MAX_REPEATED = 20, 8, 30
TRIED, STEPS, MIN_GROUP = 2, 3, 50
#: Parts into which joins with the estimates deal every group.
SALTS = 16
#: Squared distance of the nearest 97.5 % at five normal dimensions, and what makes the covariance
#: of the nearest half, and of those within that distance, consistent.
NEAR, HALF_SCALE, NEAR_SCALE = 12.833, 1.912, 1.055
#: Quantiles of which a start looks for the shortest half, as twentieths.
TWENTIETHS = 20
#: Squared distance from which a row goes: far beyond all normal quantiles, as counts are skewed.
CUT = 100.0
FLOORS = [0.2, 0.05, 0.3, 0.3, 0.5]
BINS_PER_DOUBLING, LEAST = 8, 2.0**-20
DIMS = range(len(FLOORS))
WHITE, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where lambdas use it per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def code_points(text: Column, left_out: str) -> Column:
    return F.length(F.translate(text, left_out, ""))


def repeated_words(words: Column) -> Column:
    """Words inside windows of eight words that occur again in the text, the first included."""

    def per_windows(windows: Column) -> Column:
        again = let(F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), per_sorted)
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(again)

    def per_sorted(pairs: Column) -> Column:
        def place(pair: Column, at: Column) -> Column:
            same = [F.get(pairs, at + step)["h"] == pair["h"] for step in (-1, 1)]
            return F.when(F.coalesce(same[0], F.lit(False)) | F.coalesce(same[1], F.lit(False)), pair["i"])

        return let(F.array_sort(F.array_compact(F.transform(pairs, place))), covered)

    def covered(places: Column) -> Column:
        width = F.lit(WINDOW_WORDS)
        own = F.transform(places, lambda p, i: F.least(width, F.coalesce(F.get(places, i + 1) - p, width)))
        return F.aggregate(own, F.lit(0), lambda total, n: total + n)

    def per_hashes(hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashes) - (WINDOW_WORDS - 1))
        windows = F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, WINDOW_WORDS)))
        return F.when(F.size(hashes) < WINDOW_WORDS, F.lit(0)).otherwise(let(windows, per_windows))

    return let(F.transform(words, lambda w: F.xxhash64(w)), per_hashes)


def base_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, counts, base_failed) of every text; a null text has no words."""
    text, whole = F.coalesce("text", F.lit("")), F.col("_text")
    spaced = F.translate(whole, WHITE, " " * len(WHITE))
    words = F.array_remove(F.split(spaced, " "), "")
    has_word = lambda line: code_points(line, WHITE) > 0
    lines = F.filter(F.split(whole, "\n"), has_word)
    counts = {
        "n_words": F.col("_words")[0],
        "word_chars": code_points(whole, WHITE),
        "n_symbols": F.length(whole) - code_points(whole, SYMBOLS),
        "n_dup_lines": let(lines, lambda kept: F.size(kept) - F.size(F.array_distinct(kept))),
        "n_repeat_words": F.col("_words")[1],
    }
    both = let(words, lambda w: F.array(F.size(w), repeated_words(w)))
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "source", text.alias("_text"))
    found = source.withColumn("_words", both).select(
        "doc_id", "lang", "source", *[c.cast("bigint").alias(name) for name, c in counts.items()]
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return found.withColumn("base_failed", failed)


def vector() -> list[Column]:
    """Size, word length, symbols, repeated lines and repeated words, each as a logarithm."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    per_hundred = lambda c: F.log1p(100 * F.col(c) / words)
    return [
        F.log1p("n_words"), F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words), per_hundred("n_symbols"),
        F.log1p("n_dup_lines"), per_hundred("n_repeat_words"),
    ]


def group_key() -> Column:
    part = lambda c: F.when(F.col(c).isNull(), "-").otherwise(F.concat(F.lit("+"), c))
    return F.concat(part("lang"), F.lit("\x1f"), part("source"))


def pooled_groups(rows: DataFrame, least: int = MIN_GROUP) -> DataFrame:
    """(_key, g): the group of estimates that each language and source belongs to."""
    lang = F.substring_index("_key", "\x1f", 1)
    sizes = stage(rows.groupBy("_key").agg(F.count("*").alias("n")).withColumn("_lang", lang), "sizes")
    small = sizes.where(F.col("n") < least)
    pools = small.groupBy("_lang").agg((F.sum("n") >= least).alias("enough"))
    pooled = small.join(pools, "_lang").select("_key", F.when(F.col("enough"), F.col("_lang")).otherwise("*").alias("g"))
    return sizes.where(F.col("n") >= least).select("_key", F.col("_key").alias("g")).union(pooled)


def _x(i: int) -> Column:
    return F.col(f"x{i}")


PAIRS = [(i, j) for i in DIMS for j in DIMS if j <= i]


def moments() -> list[Column]:
    """Count and sums that mean and covariance need."""
    sums = [F.sum(_x(i)).alias(f"s{i}") for i in DIMS]
    return [F.count("*").alias("n"), *sums, *[F.sum(_x(i) * _x(j)).alias(f"s{i}_{j}") for i, j in PAIRS]]


MOMENTS = ["n", *[f"s{i}" for i in DIMS], *[f"s{i}_{j}" for i, j in PAIRS]]
ESTIMATES = ["g", "start", "logdet", *[f"m{i}" for i in DIMS], *[f"w{i}_{j}" for i, j in PAIRS]]


def whitening(sums: DataFrame, scale: float) -> DataFrame:
    """Estimates from count and sums per group and start: means, the inverse Cholesky factor, and
    the logarithm of the covariance determinant."""
    n = F.col("n")
    out = sums.withColumns({f"m{i}": F.col(f"s{i}") / n for i in DIMS})
    for i, j in PAIRS:
        spread = (F.col(f"s{i}_{j}") / n - F.col(f"m{i}") * F.col(f"m{j}")) * scale
        inner = [F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)]
        rest = reduce(lambda a, b: a - b, inner, F.greatest(spread, F.lit(0.0)) + FLOORS[i] ** 2 if i == j else spread)
        out = out.withColumn(f"l{i}_{j}", F.sqrt(rest) if i == j else rest / F.col(f"l{j}_{j}"))
    for i, j in sorted(PAIRS, key=lambda p: p[0] - p[1]):
        top = F.lit(1.0) if i == j else -reduce(add, [F.col(f"l{i}_{k}") * F.col(f"w{k}_{j}") for k in range(j, i)])
        out = out.withColumn(f"w{i}_{j}", top / F.col(f"l{i}_{i}"))
    return out.withColumn("logdet", 2 * reduce(add, [F.log(F.col(f"l{i}_{i}")) for i in DIMS])).select(*ESTIMATES)


def squared_distance() -> Column:
    parts = [reduce(add, [F.col(f"w{i}_{j}") * (_x(j) - F.col(f"m{j}")) for j in range(i + 1)]) for i in DIMS]
    return reduce(add, [p * p for p in parts])


def with_estimates(vectors: DataFrame, estimates: DataFrame, how: str = "inner") -> DataFrame:
    """Rows with the estimates of their group. Groups are dealt in parts, so that the largest one
    fills many tasks also where the estimates are too many to be sent around."""
    parts = estimates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return vectors.join(parts, ["g", "salt"], how)


def first_estimates(vectors: DataFrame, least: int) -> DataFrame:
    """The starts of every group that is large enough."""
    half, quarter = TWENTIETHS // 2, TWENTIETHS // 4
    parts = [k / TWENTIETHS for k in range(TWENTIETHS + 1)]
    quantiles = [F.percentile_approx(_x(i), parts, 10000).alias(f"q{i}") for i in DIMS]
    found = stage(vectors.groupBy("g").agg(*moments(), *quantiles).where(F.col("n") >= least), "starts")

    def shortest(q: Column) -> Column:
        def part(k: Column) -> Column:
            return F.struct((F.get(q, k + half) - F.get(q, k)).alias("width"), F.get(q, k + quarter).alias("middle"))

        return F.array_min(F.transform(F.sequence(F.lit(0), F.lit(half)), part))

    def diagonal(start: int, middles: list[Column], widths: list[Column]) -> DataFrame:
        spread = [F.sqrt((width / 1.349) ** 2 + FLOORS[i] ** 2) for i, width in enumerate(widths)]
        weights = {f"w{i}_{j}": 1 / spread[i] if i == j else F.lit(0.0) for i, j in PAIRS}
        named = {"start": F.lit(start), "logdet": 2 * reduce(add, [F.log(s) for s in spread])}
        return found.withColumns(named | {f"m{i}": m for i, m in enumerate(middles)} | weights).select(*ESTIMATES)

    q = [F.col(f"q{i}") for i in DIMS]
    medians = diagonal(0, [c[half] for c in q], [c[half + quarter] - c[quarter] for c in q])
    halves = diagonal(1, [shortest(c)["middle"] for c in q], [shortest(c)["width"] for c in q])
    return medians.union(halves).union(whitening(found.withColumn("start", F.lit(2)), 1.0))


def concentrated(vectors: DataFrame, estimates: DataFrame) -> DataFrame:
    """One concentration step: estimates from the nearest bins that hold half of a group."""
    at = F.floor(BINS_PER_DOUBLING * F.log2(squared_distance() + LEAST)).cast("int")
    bins = with_estimates(vectors, estimates).withColumn("bin", at).groupBy("g", "start", "bin").agg(*moments())
    group = Window.partitionBy("g", "start")
    before = F.coalesce(F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    near = bins.withColumn("before", before).withColumn("all", F.sum("n").over(group))
    near = near.where(F.col("before") < F.floor((F.col("all") + len(FLOORS) + 1) / 2))
    return whitening(near.groupBy("g", "start").agg(*[F.sum(c).alias(c) for c in MOMENTS]), HALF_SCALE)


def best_starts(estimates: DataFrame) -> DataFrame:
    """The estimates of each group with the smallest determinant, ties to the first start."""
    rank = F.row_number().over(Window.partitionBy("g").orderBy("logdet", "start"))
    return estimates.withColumn("rank", rank).where(F.col("rank") == 1).drop("rank")


def reweighted(vectors: DataFrame, estimates: DataFrame) -> DataFrame:
    """Estimates from all vectors within ``NEAR``."""
    near = with_estimates(vectors, estimates).where(squared_distance() <= NEAR)
    return whitening(near.groupBy("g", "start").agg(*moments()), NEAR_SCALE)


def robust_estimates(vectors: DataFrame, least: int = MIN_GROUP, tried: int = TRIED, steps: int = STEPS) -> DataFrame:
    """Minimum covariance determinant estimates of the vectors of each group, a row per group."""
    estimates = stage(first_estimates(vectors, least), "estimates")
    for _ in range(tried):
        estimates = stage(concentrated(vectors, estimates), "estimates")
    estimates = stage(best_starts(estimates), "estimates")
    for _ in range(steps):
        estimates = stage(concentrated(vectors, estimates), "estimates")
    return stage(reweighted(vectors, estimates), "estimates")


def quality_verdicts(docs: DataFrame, cut: float = CUT, least: int = MIN_GROUP) -> DataFrame:
    """(doc_id, counts, base_failed, distance, kept) of every row.

    Rows that fail the base rules are not kept and take no part in estimates; their distance is
    null, as is that of rows whose pool is too small, which are kept. Languages and sources that
    are null make groups of their own. Rows with equal statistics count once in the estimates and
    come out each.
    """
    passed, x = ~F.col("base_failed"), [f"x{i}" for i in DIMS]
    found = base_statistics(docs).withColumn("_key", group_key())
    found = stage(found.withColumns({n: F.when(passed, c) for n, c in zip(x, vector())}), "statistics")
    distinct = stage(found.where(passed).select("_key", *x).distinct(), "distinct")
    groups = stage(pooled_groups(distinct, least), "groups")
    salt = F.pmod(F.xxhash64(*x), F.lit(SALTS)).cast("int")
    vectors = stage(distinct.join(groups, "_key").select("g", *x).distinct().withColumn("salt", salt), "vectors")
    estimates = robust_estimates(vectors, least)
    dealt = F.pmod(F.xxhash64("doc_id", *x), F.lit(SALTS)).cast("int")
    grouped = found.join(groups, "_key", "left").withColumns({"g": F.when(passed, F.col("g")), "salt": dealt})
    judged = with_estimates(grouped, estimates, "left").withColumn("distance", F.sqrt(squared_distance()))
    kept = passed & F.coalesce(F.col("distance") <= cut**0.5, F.lit(True))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance",
        kept.alias("kept"),
    )


def query(spark, folder: str) -> DataFrame:
    from hazeline.llm.inputs import table

    return quality_verdicts(table(spark, folder, "documents"))
