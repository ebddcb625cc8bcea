"""Periodic runs of words by longest common extensions over suffix trees.

A run is a stretch of words with smallest period q that no neighbouring word extends, here of
at least ``MIN_LENGTH`` words and ``MIN_POWER`` periods. Every run has a root that is a Lyndon
word under the order of the words or under its reverse, and is the longest one that begins at
its place. So each place gives two candidate roots; a candidate is extended to the right by the
longest common extension of its two ends, and to the left by that of the reversed text.

Extensions take constant time: Ukkonen's algorithm builds the trees of text and reversal, an
Euler tour visits the leaves, and the depth of the lowest common ancestor of two leaves is the
least depth that the tour has between them, read from a table of powers of two. Of the tour only
the least depth between neighbouring leaves is kept. Next smaller suffixes give the Lyndon roots.

Before that, a text falls apart where no run can be: any three consecutive words of a run with
four periods come three times in it, so stretches of places whose three words come less often
inside the stretch are left out, again and again. That loses nothing and leaves little of prose.

Each text is a row of its own and one task holds one text at a time; a text of n words takes
about n log n steps and, in stretches that repeat, some hundred bytes a word.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.inputs import in_slices, table, text_bytes

MIN_LENGTH, MIN_POWER, GRAM = 6, 4, 3


def suffix_tree(symbols: list[int], size: int) -> tuple[list[int], list[int], dict[int, int]]:
    """(start, stop, child) of the suffix tree by Ukkonen's algorithm; node 0 is the root.

    The last symbol must occur once. Node v hangs on the edge ``symbols[start[v]:stop[v]]``;
    ``child[u * size + symbol]`` is the node below u on the edge that begins with the symbol.
    """
    n = len(symbols)
    start, stop, link, child = [0], [0], [0], {}
    node = edge = along = pending = 0
    for i, symbol in enumerate(symbols):
        unlinked, pending = 0, pending + 1
        while pending:
            if not along:
                edge = i
            key = node * size + symbols[edge]
            below = child.get(key)
            if below is None:
                child[key] = len(start)
                start.append(i)
                stop.append(n)
                link.append(0)
                link[unlinked], unlinked = node if unlinked else 0, 0
            else:
                first = start[below]
                width = min(stop[below], i + 1) - first
                if along >= width:
                    node, edge, along = below, edge + width, along - width
                    continue
                if symbols[first + along] == symbol:
                    along += 1
                    if unlinked:
                        link[unlinked] = node
                    break
                fork = len(start)
                child[key], child[fork * size + symbol], child[fork * size + symbols[first + along]] = fork, fork + 1, below
                start += [first, i]
                stop += [first + along, n]
                link += [0, 0]
                start[below] = first + along
                if unlinked:
                    link[unlinked] = fork
                unlinked = fork
            pending -= 1
            if node:
                node = link[node]
            elif along:
                along, edge = along - 1, i - pending + 1
    return start, stop, child


def leaf_tour(n: int, start: list[int], stop: list[int], below: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of the tour, and the least depth between each and the one before."""
    order, least = [], []
    lowest, stack = 0, [(0, 0)]
    while stack:
        node, depth = stack.pop()
        if lowest is None:
            lowest = depth
        if node and stop[node] == n and not below[node]:
            order.append(start[node] - depth)
            least.append(lowest)
            lowest = None
        else:
            depth += stop[node] - start[node]
            stack += [(v, depth) for v in below[node]]
    return np.array(order, np.int64), np.array(least, np.int64)


class Extensions:
    """Longest common extensions of a text's suffixes, and the ranks of these.

    ``ranks`` are under the order of the symbols and, if asked for, under its reverse; a suffix
    that begins another one comes before it in both.
    """

    def __init__(self, symbols: np.ndarray, both: bool):
        n, size = len(symbols) + 1, int(symbols.max()) + 2
        start, stop, child = suffix_tree([*(symbols + 1).tolist(), 0], size)
        keys = np.fromiter(child.keys(), np.int64, len(child))
        nodes = np.fromiter(child.values(), np.int64, len(child))
        parents, first = keys // size, keys % size
        self.ranks = []
        for reverse in (False, True)[: 1 + both]:
            # The stack of the tour takes the last first.
            ordered = np.lexsort((-np.where(first == 0, 0, size - first) if reverse else -first, parents))
            below: list[list[int]] = [[] for _ in start]
            for parent, node in zip(parents[ordered].tolist(), nodes[ordered].tolist()):
                below[parent].append(node)
            order, least = leaf_tour(n, start, stop, below)
            rank = np.empty(n, np.int64)
            rank[order] = np.arange(n)
            self.ranks.append(rank)
            if not reverse:
                self.table = [least.astype(np.int32)]
        width = 1
        while 2 * width <= n:
            last = self.table[-1]
            self.table.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols the suffixes at i and j, two different places, have in common."""
        a, b = self.ranks[0][i], self.ranks[0][j]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        power = np.frexp(high - low + 1)[1] - 1
        found = np.empty(len(low), np.int64)
        for k in np.unique(power):
            at = power == k
            found[at] = np.minimum(self.table[k][low[at]], self.table[k][high[at] - (1 << int(k)) + 1])
        return found


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For each place but the last the next one of smaller rank; the last has the smallest."""
    values, stack, found = rank.tolist(), [], np.empty(len(rank), np.int64)
    for i, value in enumerate(values):
        while stack and values[stack[-1]] > value:
            found[stack.pop()] = i
        stack.append(i)
    return found[:-1]


def runs_of_stretch(symbols: np.ndarray, min_length: int, min_power: int) -> np.ndarray:
    """Rows (start, length, period) of the runs, each once, in order."""
    n = len(symbols)
    onward, back = Extensions(symbols, True), Extensions(symbols[::-1].copy(), False)
    found = []
    for rank in onward.ranks:
        i = np.arange(n)
        j = next_smaller(rank)
        period = j - i
        right = onward(i, j)
        left = back(n - i, n - j)
        start, length = i - left, left + period + right
        keep = length >= np.maximum(min_length, min_power * period)
        found.append(np.stack([start[keep], length[keep], period[keep]], axis=1))
    return np.unique(np.concatenate(found), axis=0)


def stretches(symbols: np.ndarray, min_length: int, min_power: int) -> list[tuple[int, int]]:
    """(start, end) of the stretches outside of which no run can be."""
    least = min((max(min_length, min_power * q) - GRAM + 1) // q for q in range(1, 2 * GRAM + 1))
    short = min_length - GRAM + 1
    if len(symbols) < min_length:
        return []
    if least < 2 or short < 1:
        return [(0, len(symbols))]
    grams = symbols.astype(np.int64)
    for k in range(1, GRAM):
        following = symbols[k:].astype(np.int64)
        grams = np.unique(grams[: len(following)] * (int(symbols.max()) + 1) + following, return_inverse=True)[1]
    places, stretch, before = np.arange(len(grams)), np.zeros(len(grams), np.int64), -1
    while len(places) != before and len(places):
        before = len(places)
        _, inverse, counts = np.unique(stretch * len(symbols) + grams[places], return_inverse=True, return_counts=True)
        places = places[counts[inverse] >= least]
        stretch = np.cumsum(np.diff(places, prepend=-2) > 1) - 1
        if len(places):
            long = np.bincount(stretch)[stretch] >= short
            places, stretch = places[long], stretch[long]
    if not len(places):
        return []
    cuts = np.flatnonzero(np.diff(places) > 1)
    return list(zip(places[np.r_[0, cuts + 1]].tolist(), (places[np.r_[cuts, len(places) - 1]] + GRAM).tolist()))


def runs(words: list[bytes], min_length: int = MIN_LENGTH, min_power: int = MIN_POWER) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the words, by start, then period."""
    numbers: dict[bytes, int] = {}
    symbols = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    found = []
    for start, end in stretches(symbols, min_length, min_power):
        part = np.unique(symbols[start:end], return_inverse=True)[1]
        found += [(start + s, n, q) for s, n, q in runs_of_stretch(part, min_length, min_power).tolist()]
    return sorted(found, key=lambda run: (run[0], run[2]))


def kept_words(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: those that no run has after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def main_run(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of most periods, by exact fractions; ties go to the first, then the shortest period."""
    best = None
    for run in found:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def periodic_runs(docs: DataFrame, edit=None, min_length: int = MIN_LENGTH, min_power: int = MIN_POWER) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of each row of documents.

    ``runs`` has a struct (start, length, period) per run, by start, then period; ``collapsed``
    is the words outside of runs and in their first periods, joined by a space. ``edit`` may
    change a row's words first: a function of doc_id and words. Null, empty and blank texts have
    no words and no runs; a row per row, repeated rows and null ids included.
    """

    def per_batch(batches):
        for batch in in_slices(batches):
            rows = []
            for key, text in zip(batch["doc_id"].to_pylist(), batch["_text"].to_pylist()):
                words = text.split() if edit is None else edit(key, text.split())
                found = runs(words, min_length, min_power)
                left = words
                if found:
                    kept = kept_words(len(words), found)
                    left = [w for w, stays in zip(words, kept.tolist()) if stays]
                rows.append((len(words), [dict(zip(("start", "length", "period"), r)) for r in found], b" ".join(left)))
            run = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
            columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(run))]
            collapsed = pa.array([r[2] for r in rows], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns, collapsed], ["doc_id", "n_words", "runs", "collapsed"])

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("_text"))
    run = "struct<start: bigint, length: bigint, period: bigint>"
    return source.mapInArrow(per_batch, f"doc_id bigint, n_words bigint, runs array<{run}>, collapsed string")


def repeating_tail(key: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents, by a hash of their id, have a tail that repeats; none without id."""
    if key is None or not words:
        return words
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    at = g % n
    period = 1 + (n - at) // (3 + g % 8)
    return words[:at] + [words[at + i % period] for i in range(n - at)]


def query(spark, folder: str) -> DataFrame:
    found = periodic_runs(table(spark, folder, "documents"), repeating_tail)
    # More periods first, compared as whole numbers: length * period of the other.
    more = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, b: F.when(more(b, a), b).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    top = found.withColumn("best", best)
    return top.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
