"""Substring dedup by sliding runs of consecutive sentences.

Every sentence starts a span: the fewest consecutive sentences, two at least, that hold
``MIN_WORDS`` words. Every sentence ends one too, the fewest up to it, so that short sentences
at a passage's end go with it. Spans are hashed and joined over all documents. A span that
occurs again keeps its first occurrence, in order of doc_id and place; the sentences of all
others go.

A sentence ends at a line's end, or after a full stop, exclamation or question mark before
white space; one of more than ``MAX_WORDS`` words is divided before the smallest word hash of
each ``PIECE_WORDS`` words in a row, so equal words are divided alike wherever they stand, but
for the first and last few of a passage. White space around sentences doesn't count in a span.

The first pass keeps the byte lengths of the sentences, so the second only cuts, and passes on
texts without repeats as they are.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.llm.inputs import in_slices, spare_name, text_bytes
from hazeline.plans.staging import stage

MIN_SENTENCES, MIN_WORDS, MAX_WORDS, PIECE_WORDS, SEED = 2, 16, 25, 8, 42
LAST = (1 << 63) - 1
ENDS = re.compile(rb"[.!?]+(?=\s)[^\S\n]*\n?|\n")
WORD = re.compile(rb"\S+")


def pieces(sentence: bytes) -> list[bytes]:
    """A long sentence in pieces of at most ``PIECE_WORDS`` words, cut by its words alone."""
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(w, SEED) for w in sentence.split()], np.uint64)
    places = [m.start() for m in WORD.finditer(sentence)]
    runs = len(hashes) - PIECE_WORDS + 1
    lowest, least = hashes[:runs].copy(), np.arange(runs)
    for k in range(1, PIECE_WORDS):
        lower = hashes[k : k + runs] < lowest
        lowest = np.where(lower, hashes[k : k + runs], lowest)
        least = np.where(lower, np.arange(k, k + runs), least)
    # Least places never fall, so equal ones are neighbours.
    cuts = [places[i] for i in least[np.flatnonzero(np.diff(least, prepend=-1))].tolist() if i]
    return [sentence[i:j] for i, j in zip([0, *cuts], [*cuts, len(sentence)])]


def sentences(text: bytes) -> list[bytes]:
    """Sentences with the white space after them; joined they are the text."""
    found, start = [], 0
    for stop in [*(m.end() for m in ENDS.finditer(text)), len(text)]:
        part, start = text[start:stop], stop
        if not part:
            continue
        if len(part) > 2 * MAX_WORDS and len(part.split()) > MAX_WORDS:
            found += pieces(part)
        else:
            found.append(part)
    return found


def span_ends(counts: list[int], min_words: int) -> list[int]:
    """For each sentence with words, the end of its span, or 0 if too few words follow."""
    ends, stop, held, full = [0] * len(counts), 0, 0, 0
    for start, n in enumerate(counts):
        while stop < len(counts) and (held < min_words or full < MIN_SENTENCES):
            held += counts[stop]
            full += counts[stop] > 0
            stop += 1
        if held >= min_words and full >= MIN_SENTENCES and n:
            ends[start] = stop
        held -= n
        full -= n > 0
    return ends


def span_bounds(counts: list[int], min_words: int) -> list[tuple[int, int]]:
    """(start, end) of the spans that start or end at a sentence, in order."""
    n = len(counts)
    onward = {(i, end) for i, end in enumerate(span_ends(counts, min_words)) if end}
    back = {(n - end, n - i) for i, end in enumerate(span_ends(counts[::-1], min_words)) if end}
    return sorted(onward | back)


def span_hashes(parts: list[bytes], min_words: int) -> tuple[list[int], list[int], list[int]]:
    """Starts and ends of the spans in a text and their hashes."""
    words = [p.split() for p in parts]
    joined = [b" ".join(w) for w in words]
    bounds = span_bounds([len(w) for w in words], min_words)
    digest = xxhash.xxh64_intdigest
    hashes = [digest(b" ".join([j for j in joined[i:end] if j]), SEED) for i, end in bounds]
    return [i for i, _ in bounds], [end for _, end in bounds], hashes


def spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, _row, lengths, bounds, hashes, inner): the byte lengths of each text's sentences,
    the first place of each of its spans, and the places where a span comes again in the text.

    A place is its start times 2^32 plus its end.
    """

    def per_batch(batches):
        for batch in in_slices(batches):
            lengths, bounds, hashes, inner = [], [], [], []
            for text in batch["_text"].to_pylist():
                parts = sentences(text)
                first: dict[int, int] = {}
                again = []
                for start, end, digest in zip(*span_hashes(parts, min_words)):
                    if digest in first:
                        again.append(start << 32 | end)
                    else:
                        first[digest] = start << 32 | end
                lengths.append([len(p) for p in parts])
                bounds.append(list(first.values()))
                hashes.append(np.array(list(first), np.uint64).view(np.int64))
                inner.append(again)
            columns = [pa.array(c, pa.list_(t)) for c, t in ((lengths, pa.int32()), (bounds, pa.int64()), (hashes, pa.int64()), (inner, pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["_row"], *columns], ["doc_id", "_row", "lengths", "bounds", "hashes", "inner"]
            )

    return docs.select("doc_id", "_row", text_bytes().alias("_text")).mapInArrow(
        per_batch, "doc_id bigint, _row bigint, lengths array<int>, bounds array<bigint>, hashes array<bigint>, inner array<bigint>"
    )


def repeated(held: DataFrame) -> DataFrame:
    """(_row, again): the places of each row's spans that an earlier row has.

    The aggregate and the join carry three numbers a span: its hash, its row and its place or
    its document.
    """
    each = held.select(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "_row", F.explode(F.arrays_zip("bounds", "hashes")).alias("s"))
    hashes = each.select("doc", "_row", F.col("s.hashes").alias("hash"))
    twice = hashes.groupBy("hash").agg(F.count("*").alias("n"), F.min_by("_row", "doc").alias("first")).where("n > 1")
    twice = stage(twice.select("hash", "first"), "repeated")
    places = each.select("_row", F.col("s.bounds").alias("place"), F.col("s.hashes").alias("hash"))
    again = places.join(twice, "hash").where("_row <> first")
    return again.groupBy("_row").agg(F.collect_set("place").alias("again"))


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Documents with their text cut, and (n_sentences, n_removed, removed) added.

    ``removed`` holds the removed sentences' numbers. No row is dropped: a text of which all
    goes becomes empty; a null text stays null. Rows alike in doc_id and text are one document
    and share what is removed; of rows alike in doc_id alone, either may count as the first. A
    null doc_id comes after all others. Other columns stay as they are, but for earlier ones of
    these names, which are replaced.
    """
    added = ["n_sentences", "n_removed", "removed"]
    docs = docs.drop(*added)
    names = docs.columns
    row, own, lengths, bounds, size = (spare_name(docs, n) for n in ("_row", "_own", "_lengths", "_bounds", "_size"))
    rows = docs.withColumn(row, F.xxhash64(F.col("doc_id").cast("bigint"), "text"))
    keys = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(row).alias("_row"), "text")
    held = stage(spans(keys, min_words), "spans")
    known = held.select("_row", "lengths", "inner").dropDuplicates(["_row"]).join(repeated(held), "_row", "left")
    places = F.concat("inner", F.coalesce("again", F.array().cast("array<bigint>")))
    cut = F.size(places) > 0
    # Only texts that lose sentences need to know where these are.
    found = known.select(
        F.col("_row").alias(own), F.size("lengths").alias(size), F.when(cut, F.col("lengths")).alias(lengths), F.when(cut, places).alias(bounds)
    )

    def per_batch(batches):
        for batch in in_slices(batches):
            texts, gone = [], []
            for text, sizes, again in zip(batch["text"].cast(pa.binary()).to_pylist(), batch[lengths].to_pylist(), batch[bounds].to_pylist()):
                drop: set[int] = set()
                for place in again or []:
                    drop.update(range(place >> 32, place & 0xFFFFFFFF))
                if drop:
                    ends = np.cumsum(sizes).tolist()
                    text = b"".join(text[i:j] for k, (i, j) in enumerate(zip([0, *ends], ends)) if k not in drop).strip()
                texts.append(text)
                gone.append(sorted(drop))
            columns = {name: batch[name] for name in names}
            columns["text"] = pa.array(texts, pa.binary()).cast(pa.string())
            columns["n_sentences"] = batch[size].cast(pa.int64())
            columns["n_removed"] = pa.array([len(g) for g in gone], pa.int64())
            columns["removed"] = pa.array(gone, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    kinds = [T.LongType(), T.LongType(), T.ArrayType(T.IntegerType())]
    schema = T.StructType([*docs.schema.fields, *map(T.StructField, added, kinds)])
    source = rows.join(found, rows[row] == found[own]).select(*names, size, lengths, bounds)
    return source.mapInArrow(per_batch, schema)


def query(spark, folder: str) -> DataFrame:
    from hazeline.llm.inputs import table

    return without_repeats(table(spark, folder, "documents").select("doc_id", "text"))
