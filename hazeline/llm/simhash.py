"""Near duplicates by SimHash fingerprints and Golay-code fuzzy hashing.

Cost on N documents: one pass over the texts for 64-bit fingerprints. Distinct fingerprints
then give about 16 keys each; keys are counted, and only keys held by several fingerprints go
on. Fingerprints under a key of at most ``PAIRED`` are compared in pairs. Under a larger key,
each gives the 65 centres of radius one around it instead: two fingerprints that differ in at
most two bits have a centre in common and two that share one differ in at most two, so a link
to the smallest under each centre keeps every component, in work linear in the group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm.components import connected_components
from hazeline.llm.golay import codeword_indices
from hazeline.llm.inputs import in_slices, text_bytes
from hazeline.plans.staging import stage

SHINGLE_WORDS, SEED, LINK_BITS, PAIRED = 3, 42, 2, 64
SEGMENTS = [(0, 23), (23, 23), (46, 18)]


def shingle_hashes(text: bytes, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Unsigned XXH64 of each shingle. Fewer words give one shingle, no words none."""
    parts = text.lower().split()
    line = b" ".join(parts)
    if len(parts) <= words:
        spans = [line] if parts else []
    else:
        stops = np.cumsum([len(p) + 1 for p in parts]).tolist()
        starts = [0, *stops]
        spans = [line[i : j - 1] for i, j in zip(starts, stops[words - 1 :])]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, SEED) for s in spans], np.uint64)


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """A bit is 1 if set in over half the hashes. Long texts are counted in slices."""
    hashes = shingle_hashes(text, words)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        rows = hashes[at : at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long. Null, empty and blank texts give 0."""

    def per_batch(batches):
        for batch in in_slices(batches):
            found = [fingerprint(t, words) for t in batch["_text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, pa.int64())], ["doc_id", "fp"])

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("_text"))
    return source.mapInArrow(per_batch, "doc_id bigint, fp bigint")


def fuzzy_keys(fps: DataFrame) -> DataFrame:
    """(fp, key): some key is shared by any two fingerprints with at most two differing bits.

    Of three segments one is free of errors (pigeonhole) and the next has at most two; a key
    joins the exact segment with the index of a codeword near the next one.
    """

    def per_batch(batches):
        for batch in batches:
            fp = batch["fp"].to_numpy(zero_copy_only=False)
            words = fp.astype(np.int64).view(np.uint64)
            parts = [((words >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
            owners, keys = [], []
            for i, exact in enumerate(parts):
                near, n = codeword_indices(parts[(i + 1) % 3])
                used = np.arange(near.shape[1]) < n[:, None]
                key = (i << 40) | (exact[:, None] << 12) | near
                keys.append(key[used])
                owners.append(np.repeat(fp, n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(owners), pa.int64()), pa.array(np.concatenate(keys), pa.int64())],
                ["fp", "key"],
            )

    return fps.select("fp").mapInArrow(per_batch, "fp bigint, key bigint")


def differing_bits(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def fingerprint_links(distinct: DataFrame, paired: int = PAIRED) -> DataFrame:
    """(a, b) edges between distinct fingerprints with the components of the whole relation."""
    keys = stage(fuzzy_keys(distinct), "keys")
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = stage(keys.join(sizes, "key"), "shared")
    few = shared.where(F.col("n") <= paired)
    pairs = few.select("key", F.col("fp").alias("a")).join(few.select("key", F.col("fp").alias("b")), "key")
    close = (F.col("a") < F.col("b")) & (differing_bits(F.col("a"), F.col("b")) <= LINK_BITS)
    many = shared.where(F.col("n") > paired).select("fp").distinct()
    flips = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("shiftleft", F.lit(1).cast("bigint"), i))
    centres = many.select(
        "fp",
        F.explode(F.transform(F.array_prepend(flips, F.lit(0).cast("bigint")), lambda m: F.col("fp").bitwiseXOR(m))).alias("centre"),
    )
    centres = stage(centres, "centres")
    least = centres.groupBy("centre").agg(F.min("fp").alias("b"))
    stars = centres.join(least, "centre").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.where(close).select("a", "b").union(stars).distinct()


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, paired: int = PAIRED) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable by links.

    Repeated rows come out repeated. A null doc_id is never the smallest unless there is none
    else. An empty table gives an empty table.
    """
    fps = stage(fingerprints(docs, words), "fingerprints")
    distinct = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = connected_components(fingerprint_links(distinct, paired))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    rooted = stage(rooted, "roots")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = stage(rooted.join(least, "root").select(F.col("fp").alias("_fp"), "component_id"), "classes")
    return fps.join(classes, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest doc_id.

    Rows that repeat that doc_id stay too; rows without a doc_id stay, as nothing tells them
    apart from others. Null, empty and blank texts are one group. All columns are kept.
    """
    classes = near_duplicates(docs.where(F.col("doc_id").isNotNull()), words)
    gone = classes.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_gone")).distinct()
    gone = stage(gone, "gone")
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def query(spark, folder: str) -> DataFrame:
    from hazeline.llm.inputs import table

    found = near_duplicates(table(spark, folder, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")
