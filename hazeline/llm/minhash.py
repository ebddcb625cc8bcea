"""Document fingerprints by MinHash, and near copies by their bands.

A text's words of ASCII white space give its set of five-word shingles (fewer words: the whole
sequence; none: an empty set). Every shingle has a 64-bit hash x; ``PERMUTATIONS`` universal hash
permutations a x + b modulo 2^64, a odd, run over all of them at once in numpy, and the least
value of each is kept. A fingerprint is 16 bits of each of these minima as hex digits, so equal
texts have equal fingerprints, and the share of equal places of two fingerprints estimates the
Jaccard similarity of their sets, with a standard error of at most 0.045.

``next_documents`` reads the table once: rows are range-partitioned and sorted by falling
doc_id, so a document and its next one are neighbours in a task. Only the first and last row of
each part meet again, one pair per part.

``near_copies`` joins signature bands of ``BAND_ROWS`` minima in Spark and verifies the Jaccard
similarity of every candidate on whole sets. A pair at 0.8 has no band in common with a chance
of (1 - 0.8 ** 4) ** 32 = 5e-8. All sets under a band are first compared with its smallest, in
work linear in the band; then in pairs, but only across what those links left apart, so many
texts that share much but less than 0.8 cost quadratic work in their band.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm.components import connected_components
from hazeline.llm.inputs import in_slices, table, text_bytes
from hazeline.plans.staging import stage

WORDS, SIMILARITY, SEED = 5, 0.8, 42
PERMUTATIONS, BANDS, BAND_ROWS = 128, 32, 4
FACTORS, SHIFTS = np.random.default_rng(SEED).integers(0, 1 << 64, (2, PERMUTATIONS), np.uint64)
FACTORS |= np.uint64(1)
EMPTY = np.iinfo(np.uint64).max
#: Spreads a minimum, which is small, over all its bits.
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Distinct hashes of the shingles, in order. Case counts."""
    parts = text.split()
    if not parts:
        return np.empty(0, np.uint64)
    line = b" ".join(parts)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    stops = np.cumsum([len(p) + 1 for p in parts]).tolist()
    starts = [0, *stops]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(line[i : j - 1], SEED) for i, j in zip(starts, stops[words - 1 :])], np.uint64))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of each permutation over the hashes; of none the largest value there is."""
    least = np.full(PERMUTATIONS, EMPTY, np.uint64)
    for at in range(0, len(hashes), 512):
        rows = hashes[at : at + 512, None] * FACTORS
        rows += SHIFTS
        np.minimum(least, rows.min(axis=0), out=least)
    return least


def fingerprint(least: np.ndarray) -> np.ndarray:
    return (((least ^ (least >> np.uint64(29))) * MIX) >> np.uint64(48)).astype(">u2")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of places in which two fingerprints agree."""
    return float((a == b).mean())


def of_text(text: str) -> np.ndarray:
    return fingerprint(minima(shingles(text.encode())))


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the start of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


#: Digits come last: the table between has half the bytes without.
DIGITS = ["fingerprint", "edited_fingerprint", "edited_sha256"]
NEXT_SCHEMA = (
    "doc_id bigint, n_chars bigint, fingerprint binary, edited_fingerprint binary, "
    "edited_sha256 binary, near_edited double, near_next double"
)


def _row(key: int | None, text: str, own: np.ndarray, following: str, other: np.ndarray) -> tuple:
    changed = edited(text, following)
    after = of_text(changed)
    return (
        key, len(text), own.tobytes(), after.tobytes(),
        hashlib.sha256(changed.encode()).digest(), likeness(own, after), likeness(own, other),
    )


def next_documents(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and their likeness, and that to the
    next document, by falling doc_id; after the last comes the first.

    Null and empty texts are empty texts of zero code points; two of them are alike. A null
    doc_id comes last, documents of one doc_id are ordered by a
    hash of their text. A row per row.
    """
    names = [c.split()[0] for c in NEXT_SCHEMA.split(", ")]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # The sample for the ranges has these keys, so no text is one.
    order = [F.desc_nulls_last("doc_id"), F.asc(F.xxhash64("text"))]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kinds = {"bigint": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    types = [kinds[c.split()[1]] for c in NEXT_SCHEMA.split(", ")]

    def batch_of(part: int, found: list[tuple], edges: list[tuple]) -> pa.RecordBatch:
        """Rows that are done, and (first, doc_id, text) of the part's two ends."""
        lines = [(*r, part, None, None) for r in found]
        lines += [(key, *[None] * (len(names) - 1), part, first, text) for first, key, text in edges]
        columns = [pa.array(c, t) for c, t in zip(zip(*lines), [*types, pa.int32(), pa.bool_(), pa.string()])]
        return pa.RecordBatch.from_arrays(columns, [*names, "part", "first", "text"])

    def per_part(batches):
        part, held = TaskContext.get().partitionId(), None
        for batch in in_slices(batches):
            found, edges = [], []
            for key, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                own = of_text(text)
                if held is None:
                    edges.append((True, key, text))
                else:
                    found.append(_row(*held, text, own))
                held = (key, text, own)
            if found or edges:
                yield batch_of(part, found, edges)
        if held is not None:
            yield batch_of(part, [], [(False, held[0], held[1])])

    done = stage(ranged.mapInArrow(per_part, f"{NEXT_SCHEMA}, part int, first boolean, text string"), "next")
    edge = done.where(F.col("first").isNotNull())
    # As many numbers as the table has parts.
    parts = sorted(r["part"] for r in edge.where("first").select("part").collect())
    around = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "last int, part int")
    lasts = edge.where(~F.col("first")).select("doc_id", "text", F.col("part").alias("last")).join(around, "last")
    firsts = edge.where("first").select("part", F.col("text").alias("following"))

    def per_pair(batches):
        for batch in in_slices(batches):
            found = []
            for key, text, following in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "following"))):
                found.append(_row(key, text, of_text(text), following, of_text(following)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names)

    ends = lasts.join(firsts, "part").select("doc_id", "text", "following").mapInArrow(per_pair, NEXT_SCHEMA)
    whole = done.where(F.col("first").isNull()).select(*names).union(ends)
    return whole.withColumns({c: F.lower(F.hex(c)) for c in DIGITS})


def band_keys(least: np.ndarray) -> list[int]:
    """A signed key per band: the hash of its minima."""
    rows = least.astype("<u8").reshape(BANDS, BAND_ROWS)
    keys = [xxhash.xxh64_intdigest(row.tobytes(), band) for band, row in enumerate(rows)]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def set_id(distinct: np.ndarray) -> int:
    """A signed hash of a sorted set of shingles; that of no shingles is 0."""
    digest = xxhash.xxh64_intdigest(distinct.astype("<u8").tobytes(), SEED) if len(distinct) else 0
    return int(np.uint64(digest).astype(np.int64))


def _text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, set_id, size, keys) of each row: its set of shingles and the band keys.

    Texts without shingles have no keys; they are one set.
    """

    def per_batch(batches):
        for batch in in_slices(batches):
            sets = [shingles(t) for t in batch["_text"].to_pylist()]
            keys = [band_keys(minima(s)) if len(s) else [] for s in sets]
            columns = [
                batch["doc_id"], batch["text_key"], pa.array(map(set_id, sets), pa.int64()),
                pa.array(map(len, sets), pa.int64()), pa.array(keys, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "set_id", "size", "keys"])

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _text_key().alias("text_key"), text_bytes().alias("_text"))
    return source.mapInArrow(per_batch, "doc_id bigint, text_key bigint, set_id bigint, size bigint, keys array<bigint>")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(set_id, hashes) of each text."""

    def per_batch(batches):
        for batch in in_slices(batches):
            sets = [shingles(t) for t in batch["_text"].to_pylist()]
            hashes = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(map(set_id, sets), pa.int64()), hashes], ["set_id", "hashes"])

    return texts.select(text_bytes().alias("_text")).mapInArrow(per_batch, "set_id bigint, hashes array<bigint>")


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of sets that are similar enough, counted on whole sets."""
    both = pairs.join(sets.select(F.col("set_id").alias("a"), F.col("hashes").alias("_a")), "a")
    both = both.join(sets.select(F.col("set_id").alias("b"), F.col("hashes").alias("_b")), "b")
    both = both.select("a", "b", (F.size("_a") + F.size("_b")).alias("total"), F.size(F.array_intersect("_a", "_b")).alias("common"))
    return both.where(F.col("common") / (F.col("total") - F.col("common")) >= similarity).select("a", "b")


def band_links(docs: DataFrame, distinct: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b) edges between distinct sets with the components of all similar pairs of a band."""
    each = distinct.select("set_id", "size", F.explode("keys").alias("key"))
    leaders = each.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("set_id", "size")).alias("least")).where("n > 1")
    shared = stage(each.join(leaders.select("key", "least"), "key"), "shared")
    texts = stage(shared.select("set_id").distinct().join(distinct, "set_id").select(F.col("text_key").alias("_wanted")), "texts")
    wanted = docs.withColumn("_key", _text_key()).join(texts, F.col("_key") == F.col("_wanted"), "left_semi")
    sets = stage(shingle_sets(wanted.dropDuplicates(["_key"])), "sets")

    fits = lambda m, n: F.least(m, n) >= similarity * F.greatest(m, n) - 1e-6
    stars = shared.where((F.col("set_id") != F.col("least.set_id")) & fits(F.col("size"), F.col("least.size")))
    stars = stage(stars.select(F.col("set_id").alias("a"), F.col("least.set_id").alias("b")).distinct(), "stars")
    near = stage(verified(stars, sets, similarity), "near")
    roots = connected_components(near).withColumnRenamed("node", "set_id")
    rooted = shared.join(roots, "set_id", "left").select("key", "set_id", "size", F.coalesce("root", "set_id").alias("root"))
    rooted = stage(rooted, "rooted")
    apart = rooted.groupBy("key").agg(F.min("root").alias("p"), F.max("root").alias("q")).where("p < q").select("key")
    split = stage(rooted.join(apart, "key"), "split")
    a, b = (split.select("key", *[F.col(c).alias(f"{c}_{side}") for c in ("set_id", "size", "root")]) for side in "ab")
    pairs = a.join(b, "key").where((F.col("root_a") < F.col("root_b")) & fits(F.col("size_a"), F.col("size_b")))
    pairs = pairs.select(F.col("set_id_a").alias("a"), F.col("set_id_b").alias("b")).distinct()
    return near.union(verified(stage(pairs, "pairs"), sets, similarity))


def near_copies(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, component_id) of each row: the smallest doc_id reachable by similar shingle sets.

    Texts without words are one group. A null doc_id is never the smallest unless there is none
    else. Repeated rows come out repeated.
    """
    found = stage(signatures(docs), "signatures")
    distinct = found.groupBy("set_id", "size").agg(
        F.min("doc_id").alias("first"), F.min("text_key").alias("text_key"), F.any_value("keys").alias("keys")
    )
    distinct = stage(distinct, "distinct")
    roots = connected_components(stage(band_links(docs, distinct, similarity), "similar"))
    rooted = distinct.join(roots, distinct["set_id"] == roots["node"], "left").select(
        "set_id", "first", F.coalesce("root", "set_id").alias("root")
    )
    rooted = stage(rooted, "roots")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = stage(rooted.join(least, "root").select("set_id", "component_id"), "classes")
    return found.join(classes, "set_id").select("doc_id", "component_id")


def query(spark, folder: str) -> DataFrame:
    return next_documents(table(spark, folder, "documents"))
