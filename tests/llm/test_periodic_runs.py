import hashlib
import random

import pytest

from hazeline.llm import periodic_runs
from tests.llm.conftest import words


def brute(sequence, min_length=periodic_runs.MIN_LENGTH, min_power=periodic_runs.MIN_POWER):
    """Every maximal stretch of every period, kept if no smaller period holds in it."""
    found, n = [], len(sequence)
    for q in range(1, n // 2 + 1):
        equal = [sequence[i] == sequence[i + q] for i in range(n - q)] + [False]
        start = 0
        for i, same in enumerate(equal):
            if not same:
                length, part = i - start + q, sequence[start : i + q]
                shorter = lambda p: all(a == b for a, b in zip(part, part[p:]))
                if length >= max(min_length, min_power * q) and not any(map(shorter, range(1, q))):
                    found.append((start, length, q))
                start = i + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


@pytest.mark.parametrize("limits", [(6, 4), (2, 2), (5, 3)])
def test_runs_equal_brute_force(limits):
    rng, total = random.Random(1), 0
    for _ in range(1200):
        n, size = rng.randrange(60), rng.choice([1, 2, 3, 4, 9])
        sequence = [b"%d" % rng.randrange(size) for _ in range(n)]
        if n and rng.random() < 0.5:
            at, period = rng.randrange(n), rng.randrange(1, max(2, n // 3))
            sequence = sequence[:at] + [sequence[at + i % period] for i in range(n - at)]
        found = periodic_runs.runs(sequence, *limits)
        assert found == brute(sequence, *limits)
        total += len(found)
    assert total > 400


def test_stretches_lose_no_run():
    rng = random.Random(2)
    for _ in range(50):
        sequence = []
        while len(sequence) < 600:
            period = [b"%d" % rng.randrange(40) for _ in range(rng.randrange(1, 9))]
            sequence += period * rng.randrange(1, 7) + [b"%d" % rng.randrange(40) for _ in range(rng.randrange(30))]
        assert periodic_runs.runs(sequence) == brute(sequence)


def test_extensions_equal_a_count():
    import numpy as np

    rng = np.random.default_rng(3)
    for size in (1, 2, 5):
        symbols = rng.integers(0, size, 40)
        common = periodic_runs.Extensions(symbols, False)
        i, j = np.triu_indices(41, 1)
        expected = [next((k for k in range(41) if b + k >= 40 or symbols[a + k] != symbols[b + k]), 0) for a, b in zip(i, j)]
        assert common(i, j).tolist() == expected


def reference_row(key, text):
    tokens = periodic_runs.repeating_tail(key, (text or "").encode().split())
    found = brute(tokens)
    covered = {k for s, n, q in found for k in range(s + q, s + n)}
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    digest = lambda b: hashlib.sha256(b).hexdigest()
    return (key, len(found), *best, milli, digest(lines.encode()), digest(b" ".join(t for k, t in enumerate(tokens) if k not in covered)))


def test_query_equals_brute_force(spark, documents):
    short = {r.doc_id: r.text for r in documents.collect() if len(r.text or "") < 4000}
    found = {r.doc_id: tuple(r) for r in periodic_runs.query(spark, "/root/testdata/sf0.001").collect()}
    assert len(found) == documents.count() and len(short) > 100
    assert {k: found[k] for k in short} == {k: reference_row(k, t) for k, t in short.items()}
    assert any(r[1] for r in found.values())


def test_awkward_rows(awkward):
    found = periodic_runs.periodic_runs(awkward, periodic_runs.repeating_tail)
    rows = found.collect()
    assert len(rows) == 11 and found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[i].n_words == 0 and by_id[i].runs == [] and by_id[i].collapsed == "" for i in (1, 2, 3))
    assert by_id[None].collapsed == words(3, 50) and by_id[4].n_words == 40_000 and by_id[9].n_words == 1


def test_long_repeating_text(spark):
    text = " ".join(["a b c"] * 20_000 + ["x"] * 10_000)
    (row,) = periodic_runs.periodic_runs(spark.createDataFrame([(7, text)], "doc_id long, text string")).collect()
    assert [tuple(r) for r in row.runs] == [(0, 60_000, 3), (60_000, 10_000, 1)] and row.collapsed == "a b c x"


def test_empty_table(no_documents):
    assert periodic_runs.periodic_runs(no_documents).collect() == []
