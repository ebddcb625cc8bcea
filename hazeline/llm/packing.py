"""Packing token sequences with lexical neighbours.

Each task reads its documents once, in shards of about ``SHARD_TOKENS`` tokens. A shard has an
inverted index over token ids with BM25 weights. The longest unused document seeds a window; the
index returns its unused neighbours, best first, which fill the window whole while they fit; if
none fits, the best one is cut and the rest of it seeds the next window. So all windows are full
but the last tokens of a shard, which make sequences of descending powers of two: nothing is
padded. Nothing is shuffled, memory is one shard, and a task that runs again packs alike.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.inputs import in_slices, text_bytes
from hazeline.llm.word_ids import WORD_BPE, chunk_ids

WINDOW, END_ID, SHARD_TOKENS, QUERY_TERMS, NEIGHBOURS, K1, B = 4096, 2, 1 << 20, 32, 64, 1.2, 0.75


class ShardIndex:
    """BM25 over the token ids of a shard's documents."""

    def __init__(self, documents: list[np.ndarray]):
        n = len(documents)
        counted = [np.unique(d, return_counts=True) for d in documents]
        owners = np.repeat(np.arange(n), [len(t) for t, _ in counted])
        terms = np.concatenate([t for t, _ in counted]).astype(np.int64)
        tf = np.concatenate([c for _, c in counted]).astype(np.float64)
        lengths = np.array([len(d) for d in documents], np.float64)
        df = np.bincount(terms)
        self.idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * lengths / lengths.mean())
        weights = self.idf[terms] * tf * (K1 + 1) / (tf + norm[owners])
        order = np.argsort(terms, kind="stable")
        self.docs, self.weights = owners[order], weights[order]
        self.bounds = np.concatenate([[0], np.cumsum(df)])
        self.terms, self.own = [t for t, _ in counted], np.split(weights, np.cumsum([len(t) for t, _ in counted])[:-1])
        self.unused = np.ones(n, bool)

    def neighbours(self, seed: int) -> np.ndarray:
        """Unused documents with a term of the seed's heaviest ones, best first, ties in order."""
        heavy = np.argsort(-self.own[seed], kind="stable")[:QUERY_TERMS]
        scores = np.zeros(len(self.unused))
        for term in self.terms[seed][heavy]:
            part = slice(self.bounds[term], self.bounds[term + 1])
            scores[self.docs[part]] += self.weights[part]
        scores[~self.unused] = 0
        found = np.flatnonzero(scores)
        if len(found) > NEIGHBOURS:
            found = found[np.argsort(-scores[found], kind="stable")[:NEIGHBOURS]]
            return found
        return found[np.argsort(-scores[found], kind="stable")]


def windows(documents: list[np.ndarray], size: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) pieces. All are full but the last few."""
    index = ShardIndex(documents)
    lengths = [len(d) for d in documents]
    by_length = iter(sorted(range(len(documents)), key=lambda i: (-lengths[i], i)))
    done: list[list[tuple[int, int, int]]] = []
    rest: tuple[int, int] | None = None
    now: list[tuple[int, int, int]] = []
    room = size

    def put(doc: int, start: int) -> tuple[int, int] | None:
        """Put what fits; what is left of the document, if anything."""
        nonlocal room
        n = min(room, lengths[doc] - start)
        now.append((doc, start, n))
        room -= n
        return (doc, start + n) if start + n < lengths[doc] else None

    while True:
        if room == 0:
            done.append(now)
            now, room = [], size
        if rest is None:
            seed = next((i for i in by_length if index.unused[i]), None)
            if seed is None:
                break
            index.unused[seed] = False
            rest = (seed, 0)
        seed = rest[0]
        rest = put(*rest)
        if rest is not None or room == 0:
            continue
        first = None
        for doc in index.neighbours(seed).tolist():
            first = doc if first is None else first
            if lengths[doc] <= room:
                index.unused[doc] = False
                put(doc, 0)
                if room == 0:
                    break
        if room and first is not None and index.unused[first]:
            index.unused[first] = False
            rest = (first, 0)
    return done + powers_of_two(now)


def powers_of_two(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Pieces cut into sequences of descending powers of two, one for each bit of their length."""
    left, found = sum(n for _, _, n in pieces), []
    queue = list(reversed(pieces))
    while left:
        room, now = 1 << (left.bit_length() - 1), []
        left -= room
        while room:
            doc, start, n = queue.pop()
            used = min(n, room)
            now.append((doc, start, used))
            if used < n:
                queue.append((doc, start + used, n - used))
            room -= used
        found.append(now)
    return found


def packed(docs: DataFrame, tokenizer: str = WORD_BPE, size: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """A row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    A document is the ids of its whole text and one ``END_ID``; null and empty texts are that id
    alone. Repeated rows are packed each. ``size`` is a power of two. With ``with_ids`` the ids of
    each piece come too, as little-endian unsigned 32-bit integers. A sequence id is the number of
    the task, shifted, plus that of the sequence in it.
    """

    def shards(batches):
        keys, held, tokens = [], [], 0
        coder = chunk_ids(tokenizer)
        for batch in in_slices(batches):
            for key, text in zip(batch["doc_id"].to_pylist(), batch["_text"].to_pylist()):
                ids = np.append(coder.encode(text), np.uint16(END_ID))
                keys.append(key)
                held.append(ids)
                tokens += len(ids)
                if tokens >= SHARD_TOKENS:
                    yield keys, held
                    keys, held, tokens = [], [], 0
        if held:
            yield keys, held

    def per_task(batches):
        number = TaskContext.get().partitionId() << 32
        for keys, held in shards(batches):
            rows = []
            for pieces in windows(held, size):
                offset = 0
                for doc, start, n in pieces:
                    ids = held[doc][start : start + n].astype("<u4").tobytes()
                    row = (keys[doc], start, n, crc32(ids), len(held[doc]), number, offset)
                    rows.append(row + (ids,) if with_ids else row)
                    offset += n
                number += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], [name for name, _ in fields]
            )

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    fields = [(name, "bigint") for name in names] + [("ids", "binary")] * with_ids
    kinds = [pa.int64()] * len(names) + [pa.binary()] * with_ids
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("_text"))
    return source.mapInArrow(per_task, ", ".join(f"{n} {t}" for n, t in fields))


def query(spark, folder: str) -> DataFrame:
    from hazeline.llm.inputs import table

    return packed(table(spark, folder, "documents"))
