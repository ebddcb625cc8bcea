"""Data checks. Each gives a report frame; ``enforce`` turns findings into an error."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.functions.labels import in_list
from hazeline.functions.numbers import merged_mean, number_text
from hazeline.operators.prepare import keep_keys
from hazeline.operators.rollup import flag_counts
from hazeline.params import DEFAULTS, Params
from hazeline.plans.staging import stage

SHOWN = 20

# Types and texts of the report's warnings.
HIGH_TYPE, HIGH_TEXT = "high_pm25_gt", " has an average PM2.5 concentration above "
UNIT_TEXT = " µg/m³: "
TOP_TYPE, TOP_TEXT = "southern_city_in_top_10", " is in the top "
LOW_TYPE, LOW_TEXT, BETWEEN_TEXT = "low_value_lt", " has a value less than ", " has a value between "
REGION_TYPE, REGION_TEXT = "wrong_state_number", "Number of states in India in analysis was "


class DataCheckError(ValueError):
    """A hard stop. ``findings`` reads the written table of all findings."""

    def __init__(self, message: str, findings: DataFrame | None = None):
        super().__init__(message)
        self.findings = findings


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise DataCheckError(f"Columns missing in data: {', '.join(missing)}")
    return df


def enforce(findings: DataFrame, message: str) -> None:
    """Raise if a report has rows.

    The findings are written first, all of them; the text has their number, their folder and
    the first few.
    """
    written = stage(findings, "findings")
    total = written.count()
    if total:
        shown = written.orderBy(*written.columns).limit(SHOWN).collect()
        texts = "; ".join(", ".join(str(v) for v in row) for row in shown)
        folder = written.inputFiles()[0].rsplit("/", 1)[0]
        raise DataCheckError(
            f"{message}: first {len(shown)} of {total}: {texts} (all in {folder})", written
        )


def missing_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns a table must have and lacks, in a frame."""
    missing = [c for c in columns if c not in df.columns]
    names = F.explode(F.array(*map(F.lit, missing)).cast("array<string>")).alias("column")
    return df.sparkSession.range(1).select(names)


def rule_report(
    df: DataFrame, rules: Mapping[str, Column], types: Mapping[str, str] | None = None
) -> DataFrame:
    """Rows that fail each rule, in one aggregate; the data themselves pass on unchanged.

    A rule that is NULL for a row is neither met nor failed; such rows are counted apart as
    ``unknown_rows``. ``types`` are checked on the schema alone.
    """
    actual = dict(df.dtypes)
    checks = {
        f"{column} is {wanted}": F.count_if(F.lit(actual.get(column) != wanted))
        for column, wanted in (types or {}).items()
    }
    checks |= {name: F.count_if(~rule) for name, rule in rules.items()}
    unknown = {name: F.count_if(rule.isNull()) for name, rule in rules.items()}
    counts = df.agg(
        F.count("*").alias("_total"), *[c.alias(f"_{i}") for i, c in enumerate(checks.values())],
        *[unknown.get(name, F.lit(0)).alias(f"_u{i}") for i, name in enumerate(checks)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"), F.col(f"_{i}").alias("failed_rows"),
                F.col(f"_u{i}").cast("bigint").alias("unknown_rows"),
            )
            for i, name in enumerate(checks)
        ]
    )
    report = counts.select(F.inline(rows), F.col("_total").alias("total_rows"))
    return report.withColumn("ok", F.col("failed_rows") + F.col("unknown_rows") == 0)


def limit_checks(
    r: DataFrame, groups: DataFrame, day_threshold: float, params: Params = DEFAULTS
) -> DataFrame:
    """Too many entities, too many of the group, or too few days. Reads the rollup."""
    members = groups.where(F.col("name") == params.group).select(
        F.col("location_id").alias("_member")
    )
    ids = r.select("location_id").distinct()
    present = ids.join(members, ids["location_id"].eqNullSafe(members["_member"]), "left_semi")
    months = r.groupBy("year", "month").agg(F.bit_or("days_mask").alias("_mask"))
    entities = r.select("city_id").distinct()
    observed = {
        "entities": (entities.agg(F.count("*")), params.max_entities, "at most"),
        "group_entities": (present.agg(F.count("*")), params.max_group_entities, "at most"),
        "days": (months.agg(F.sum(F.bit_count("_mask"))), day_threshold, "at least"),
    }
    parts = [
        counted.toDF("observed").select(
            F.lit(check).alias("check"), F.coalesce("observed", F.lit(0)).alias("observed"),
            F.lit(float(limit)).alias("limit"), F.lit(relation).alias("relation"),
        )
        for check, (counted, limit, relation) in observed.items()
    ]
    report = reduce(DataFrame.unionByName, parts)
    ok = F.when(F.col("relation") == "at most", F.col("observed") <= F.col("limit")).otherwise(
        F.col("observed") >= F.col("limit")
    )
    return report.withColumn("ok", ok)


def warn_high_season_mean(r: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """City means of a cold month above each cut; above the higher cut means both warnings."""
    cold = r.where(F.col("month").isin(params.high_season_months))
    means = cold.groupBy("city_id", "month").agg(merged_mean(params).alias("mean"))
    passed = F.filter(
        F.array(*[F.lit(cut) for cut in params.high_season_cuts]), lambda cut: F.col("mean") > cut
    )
    rows = means.withColumn("cut", F.explode(passed))
    message = F.concat(
        F.lit("City "), "city_id", F.lit(" in "), F.col("month").cast("string"),
        F.lit(HIGH_TEXT), F.col("cut").cast("string"), F.lit(UNIT_TEXT), number_text("mean"),
    )
    return rows.select(
        F.concat(F.lit(HIGH_TYPE), F.col("cut").cast("string")).alias("type"),
        message.alias("message"),
    )


def warn_unexpected_top(r: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Cities of watched regions among the first n means - exactly n, whatever the ties."""
    keys = ["city_id", "city_name", "gadm1_id"]
    means = r.groupBy(*keys).agg(merged_mean(params).alias("mean"))
    top = means.orderBy(
        F.desc_nulls_last("mean"), *[F.asc_nulls_last(k) for k in keys]
    ).limit(params.top_n)
    found = top.where(in_list(F.col("gadm1_id"), params.watched_regions))
    message = F.concat(F.lit("City "), "city_name", F.lit(f"{TOP_TEXT}{params.top_n}"))
    return found.select(F.lit(TOP_TYPE).alias("type"), message.alias("message"))


def warn_low_values(m: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Single values under the low or the moderate cut."""
    value = F.col("value")
    low, moderate = params.low_value, params.moderate_value
    start = F.concat(F.lit("City "), "city_id", F.lit(" on "), F.col("date").cast("string"))
    text = F.when(value < low, f"{LOW_TEXT}{low:g}: ").otherwise(
        f"{BETWEEN_TEXT}{low:g} and {moderate:g}: "
    )
    kind = F.when(value < low, f"{LOW_TYPE}{low:g}").otherwise(f"{LOW_TYPE}{moderate:g}")
    return m.where(value < moderate).select(
        kind.alias("type"), F.concat(start, text, number_text("value")).alias("message")
    )


def duplicate_entries(m: DataFrame, months: DataFrame) -> DataFrame:
    """Location and date of repeated rows, with their number.

    ``months`` are the rows' ``month_counts``. Only months with more rows than days are looked
    into, so clean data never shuffle by date.
    """
    doubtful = months.where(F.col("rows") > F.coalesce(F.bit_count("days_mask"), F.lit(0)))
    doubtful = stage(doubtful.select("location_id", "month"), "doubtful")
    rows = m.select("location_id", "date", F.trunc("date", "MM").alias("month"))
    rows = keep_keys(rows, doubtful, ["location_id", "month"])
    counts = rows.groupBy("location_id", "date").agg(F.count("*").alias("entries"))
    return counts.where(F.col("entries") > 1)


def many_to_one(right: DataFrame, key: str) -> DataFrame:
    """Keys that repeat on the side of a join where they must not."""
    counts = right.groupBy(key).agg(F.count("*").alias("entries"))
    return counts.where(F.col("entries") > 1)


def compliance_invariant(flagged: DataFrame, keys: list[str]) -> DataFrame:
    """Groups where passed and not passed do not make up the total: a value is missing."""
    names = ["pass_who", "pass_naaqs", "pass_naaqs2"]
    counts = flagged.groupBy(*keys).agg(*flag_counts("_"))
    return broken_counts(counts, keys, "_").select(*keys, "total", *[f"{n}_unknown" for n in names])


def broken_counts(counts: DataFrame, keys: list[str], prefix: str = "") -> DataFrame:
    """The same for a frame that already holds the counts, such as the rollup."""
    names = ["pass_who", "pass_naaqs", "pass_naaqs2"]
    total = F.col(f"{prefix}total")
    unknown = [
        (total - F.col(f"{prefix}{n}") - F.col(f"{prefix}not_{n}")).alias(f"{n}_unknown")
        for n in names
    ]
    report = counts.select(*keys, total.alias("total"), *unknown)
    return report.where(" OR ".join(f"{n}_unknown <> 0" for n in names))


def warn_region_coverage(summary: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """One warning if fewer regions than expected are in the summary."""
    regions = summary.select("gadm1_name").distinct().agg(F.count("*").alias("n"))
    message = F.concat(
        F.lit(REGION_TEXT), F.col("n").cast("string"),
        F.lit(f" less than {params.expected_regions}"),
    )
    return regions.where(F.col("n") < params.expected_regions).select(
        F.lit(REGION_TYPE).alias("type"), message.alias("message")
    )


def missing_coordinates(summary: DataFrame) -> DataFrame:
    return summary.where("latitude IS NULL OR longitude IS NULL")


def reconcile_counts(stations: DataFrame, statuses: DataFrame) -> DataFrame:
    """Numbers of stations in the new registry and of statuses; they must agree."""
    zero = F.lit(0).cast("bigint")
    left = stations.agg(F.count("*").alias("stations"), zero.alias("statuses"))
    right = statuses.agg(zero.alias("stations"), F.count("*").alias("statuses"))
    both = left.unionByName(right).agg(
        F.sum("stations").alias("stations"), F.sum("statuses").alias("statuses")
    )
    return both.withColumn("ok", F.col("stations") == F.col("statuses"))


def vanished_stations(stations: DataFrame, statuses: DataFrame) -> DataFrame:
    """Stations with a status that the new registry no longer lists."""
    listed = stations.select(F.col("id").alias("_id"))
    return statuses.join(listed, statuses["id"].eqNullSafe(listed["_id"]), "left_anti").select(
        "id", "change"
    )


def warning(spark: SparkSession, kind: str, message: str) -> DataFrame:
    return spark.range(1).select(F.lit(kind).alias("type"), F.lit(message).alias("message"))


def empty_log(spark: SparkSession) -> DataFrame:
    return warning(spark, "", "").where(F.lit(False))


def collect_warnings(first: DataFrame, *more: DataFrame) -> DataFrame:
    """One log of (type, message) out of any frames that have these columns."""
    return reduce(
        DataFrame.unionByName, [df.select("type", "message") for df in (first, *more)]
    )
