"""Graded quality: ordinal cumulative-link regression on hashed text.

P(grade >= k) = logistic(w.x - theta_k), with one weight vector for all grades and thresholds in
order. The features are hashed into one vector of ``BUCKETS`` places: words, shapes of words and
of neighbouring words, and coarse marks of the text as a whole. The model is fitted on a sample
of at most about ``SAMPLE`` rated rows of folds 1 to 4; scoring is one pass over the documents.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm.inputs import fold_of, in_slices, text_bytes, texts_of
from hazeline.plans.staging import stage

SAMPLE, BUCKETS, ROUNDS, RIDGE, KEEP_TAIL = 8192, 1 << 15, 150, 1e-3, 0.5
WORD_WEIGHT, SHAPE_WEIGHT, MARK_WEIGHT = 0.3, 1.0, 0.5
SHAPES = bytes(
    97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256)
)
RUNS = re.compile(rb"(.)\1+", re.S)


WORD, SHAPE, PAIR, MARK, BIAS = map(crc32, (b"word", b"shape", b"pair", b"mark", b"bias"))


def _add(found: dict[int, float], counts: Counter[bytes], seed: int, weight: float) -> None:
    """Add square roots of counts, hashed, as a vector of length ``weight``."""
    if not counts:
        return
    scale = weight / sum(counts.values()) ** 0.5
    have = found.get
    for value, n in counts.items():
        place = crc32(value, seed) % BUCKETS
        found[place] = have(place, 0.0) + scale * n**0.5


def marks(words: list[bytes], low: list[bytes], text: bytes) -> list[bytes]:
    """Coarse numbers of the whole text, in tenths or powers of two."""
    n = len(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    same = sum(map(bytes.__eq__, words, words[1:]))
    pairs = set(zip(low, low[1:], low[2:]))
    shares = {
        b"same": same / max(1, n - 1),
        b"triples": len(pairs) / max(1, n - 2) if n > 2 else 1.0,
        b"lines": len(set(lines)) / max(1, len(lines)),
        b"upper": sum(map(bytes.isupper, words)) / max(1, n),
        b"letters": sum(map(bytes.isalpha, words)) / max(1, n),
    }
    sizes = {b"words": n.bit_length(), b"length": (len(text) // max(1, n)).bit_length()}
    return [k + b"%d" % int(10 * v) for k, v in shares.items()] + [k + b"%d" % v for k, v in sizes.items()]


def hashed(text: bytes) -> dict[int, float]:
    """The feature vector of a text, by bucket. Texts without words have marks alone."""
    words, low = text.split(), text.lower().split()
    shapes = RUNS.sub(rb"\1", text.translate(SHAPES)).split()
    found: dict[int, float] = {BIAS % BUCKETS: 1.0}
    _add(found, Counter(low), WORD, WORD_WEIGHT)
    _add(found, Counter(shapes), SHAPE, SHAPE_WEIGHT)
    _add(found, Counter(map(b" ".join, zip(shapes, shapes[1:]))), PAIR, SHAPE_WEIGHT)
    for mark in marks(words, low, text):
        place = crc32(mark, MARK) % BUCKETS
        found[place] = found.get(place, 0.0) + MARK_WEIGHT
    return found


@dataclass
class OrdinalModel:
    """Shared weights and thresholds in ascending order, one less than there are grades."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: list[int] = field(default_factory=list)

    def tails(self, vector: dict[int, float]) -> np.ndarray:
        """P(grade >= k) for each grade but the lowest."""
        places = np.fromiter(vector.keys(), np.int64, len(vector))
        values = np.fromiter(vector.values(), np.float64, len(vector))
        margin = float(self.weights[places] @ values)
        return 1 / (1 + np.exp(-np.clip(margin - self.thresholds, -30, 30)))

    def expected(self, tails: np.ndarray) -> float:
        return float(self.grades[0] + np.diff(self.grades) @ tails)


def fit_ordinal(
    places: np.ndarray, values: np.ndarray, rows: np.ndarray, grade: np.ndarray, grades: list[int],
    rounds: int = ROUNDS, ridge: float = RIDGE,
) -> OrdinalModel:
    """Maximum likelihood of the cumulative-link model by Adam on sparse rows.

    Thresholds are the first one plus exponentials of steps, so that they keep their order.
    """
    n, k = len(grade), len(grades)
    level = np.searchsorted(grades, grade)
    above = np.array([(level >= j).mean() for j in range(1, k)])
    start = -np.log(above / (1 - above))
    steps = np.log(np.maximum(np.diff(start), 1e-2))
    params = np.concatenate([np.zeros(BUCKETS), start[:1], steps])
    first, second = np.zeros_like(params), np.zeros_like(params)
    upper = lambda t: np.concatenate([t, [np.inf]])
    lower = lambda t: np.concatenate([[-np.inf], t])
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for step in range(1, rounds + 1):
        w, tail = params[:BUCKETS], params[BUCKETS:]
        theta = tail[0] + np.concatenate([[0.0], np.cumsum(np.exp(tail[1:]))])
        margin = np.bincount(rows, weights=values * w[places], minlength=n)
        high, low = sigmoid(margin - lower(theta)[level]), sigmoid(margin - upper(theta)[level])
        mass = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / mass, low * (1 - low) / mass
        slope = -(d_high - d_low) / n
        by_theta = np.zeros(k + 1)
        np.add.at(by_theta, level, d_high / n)
        np.add.at(by_theta, level + 1, -d_low / n)
        inner = by_theta[1:k]
        later = np.cumsum(inner[::-1])[::-1]
        gradient = np.concatenate(
            [np.bincount(places, weights=values * slope[rows], minlength=BUCKETS) + ridge * w / 2, [inner.sum()], later[1:] * np.exp(tail[1:])]
        )
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        rate = 0.2 * (1 - step / (rounds + 1))
        params = params - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    tail = params[BUCKETS:]
    theta = tail[0] + np.concatenate([[0.0], np.cumsum(np.exp(tail[1:]))])
    return OrdinalModel(params[:BUCKETS], theta, [int(g) for g in grades])


def ratings(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of the given labels: 0 for poor, 1 for good but toxic, 2 for good.

    Rows without a quality don't count; an unknown toxicity counts as none. Of several rows of
    a document the lowest grade counts.
    """
    clean = F.when(F.coalesce("toxic", F.lit(0)) > 0, 1).otherwise(2)
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    grade = F.when(F.col("quality") <= 0, 0).otherwise(clean)
    return known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min(grade).alias("grade"))


def fit(docs: DataFrame, rated: DataFrame, most: int = SAMPLE) -> OrdinalModel:
    """Fit on at most about ``most`` rated rows of folds 1 to 4, taken by a hash of doc_id.

    ``rated`` has (doc_id, grade), each doc_id once, grades any whole numbers. With fewer than
    two grades the tail probability is one half for every text, so all documents are selected.
    """
    known = stage(rated.where(fold_of(F.col("doc_id")) != 0).select(F.col("doc_id").alias("_id"), "grade"), "rated")
    share = min(1.0, most / max(1, known.count()))
    sample = known.where((F.xxhash64("_id") / F.lit(2.0**64) + 0.5) <= share)

    def per_batch(batches):
        for batch in in_slices(batches):
            vectors = [hashed(t) for t in batch["_text"].to_pylist()]
            places = [np.fromiter(v.keys(), "<i4", len(v)).tobytes() for v in vectors]
            values = [np.fromiter(v.values(), "<f4", len(v)).tobytes() for v in vectors]
            yield pa.RecordBatch.from_arrays(
                [batch["grade"], pa.array(places, pa.binary()), pa.array(values, pa.binary())], ["grade", "places", "values"]
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("_text"))
    joined = rows.join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    vectors = joined.select(F.col("grade").cast("int").alias("grade"), "_text").mapInArrow(
        per_batch, "grade int, places binary, values binary"
    )
    found = vectors.collect()
    grades = sorted({r.grade for r in found})
    if len(grades) < 2:
        return OrdinalModel(np.zeros(BUCKETS), np.zeros(1), [0, 1])
    places = [np.frombuffer(r.places, "<i4") for r in found]
    values = np.concatenate([np.frombuffer(r["values"], "<f4") for r in found])
    owners = np.repeat(np.arange(len(found)), [len(p) for p in places])
    return fit_ordinal(np.concatenate(places), values, owners, np.array([r.grade for r in found]), grades)


def score(docs: DataFrame, model: OrdinalModel, keep_tail: float = KEEP_TAIL) -> DataFrame:
    """(doc_id, expected_grade, tails, selected) of every row.

    ``tails`` has P(grade >= k) for each grade but the lowest; a row is selected if the first of
    them is at least ``keep_tail``. Null texts count as empty. Rows that repeat stay.
    """

    def per_batch(batches):
        for batch in in_slices(batches):
            tails = [model.tails(hashed(t)) for t in batch["_text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([model.expected(t) for t in tails], pa.float64()),
                    pa.array([t.tolist() for t in tails], pa.list_(pa.float64())),
                    pa.array([bool(t[0] >= keep_tail) for t in tails], pa.bool_()),
                ],
                ["doc_id", "expected_grade", "tails", "selected"],
            )

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("_text"))
    return source.mapInArrow(per_batch, "doc_id bigint, expected_grade double, tails array<double>, selected boolean")


def selected_documents(docs: DataFrame, labels: DataFrame, keep_tail: float = KEEP_TAIL) -> DataFrame:
    """Documents that are selected, with all their columns."""
    model = fit(docs, ratings(labels))

    def per_batch(batches):
        for batch in in_slices(batches):
            keep = [bool(model.tails(hashed(t))[0] >= keep_tail) for t in texts_of(batch)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(per_batch, docs.schema)


def tail_of(grade: int) -> Column:
    """The probability of at least this grade, counted from the lowest as 0."""
    return F.try_element_at("tails", F.lit(grade))


def query(spark, folder: str) -> DataFrame:
    from hazeline.llm.inputs import table

    docs = table(spark, folder, "documents")
    scored = score(docs, fit(docs, ratings(table(spark, folder, "labels"))))
    return scored.select(
        "doc_id", "expected_grade", tail_of(1).alias("p_grade_1"), tail_of(2).alias("p_grade_2"),
        F.col("selected").alias("kept"),
    )
