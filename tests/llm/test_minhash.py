import hashlib
import itertools

import numpy as np

from hazeline.llm import minhash
from tests.llm.conftest import words


def shingle_set(text):
    parts = (text or "").split()
    return {" ".join(parts[i : i + 5]) for i in range(len(parts) - 4)} or ({" ".join(parts)} if parts else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_minima_equal_a_plain_loop():
    hashes = minhash.shingles(words(1, 700).encode())
    expected = [min((int(h) * int(a) + int(b)) % 2**64 for h in hashes) for a, b in zip(minhash.FACTORS, minhash.SHIFTS)]
    assert minhash.minima(hashes).tolist() == expected


def test_likeness_estimates_jaccard():
    base, errors = words(2, 400).split(), []
    for changed in range(0, 80, 4):
        other = base.copy()
        for k in range(changed):
            other[5 * k] = f"new{k}"
        a, b = " ".join(base), " ".join(other)
        errors.append(minhash.likeness(minhash.of_text(a), minhash.of_text(b)) - jaccard(shingle_set(a), shingle_set(b)))
    assert max(map(abs, errors)) < 0.16 and abs(np.mean(errors)) < 0.05


def brute_next(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    found = {}
    for (key, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        own, after, other = map(minhash.of_text, (text, changed, following))
        found[key] = (len(text), hashlib.sha256(changed.encode()).hexdigest(), own.tobytes().hex(), after.tobytes().hex(), (own == after).mean(), (own == other).mean())
    return found


def test_query_equals_brute_force(spark, documents):
    expected = brute_next([(r.doc_id, r.text) for r in documents.collect()])
    found = minhash.query(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in found} == expected
    assert len(found) == len(expected)


def test_every_document_in_a_part_of_its_own(spark):
    rows = [(i, words(i, 30 + i) + "é") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r.doc_id: r.edited_sha256 for r in minhash.next_documents(docs).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == {k: v[1] for k, v in brute_next(rows).items()}


def brute_groups(texts, similarity=0.8):
    sets, first = {i: shingle_set(t) for i, t in texts.items()}, {i: i for i in texts}
    for a, b in itertools.combinations(sorted(texts), 2):
        if first[a] != first[b] and jaccard(sets[a], sets[b]) >= similarity:
            p, q = sorted((first[a], first[b]))
            first |= {i: p for i in first if first[i] == q}
    return first


def test_near_copies_equal_brute_force(spark):
    texts = {}
    for k in range(40):
        parts = words(k, 150).split()
        for copy in range(4):
            for place in range(copy):
                parts[20 + 35 * place + 11 * copy] = f"edit{k}x{copy}x{place}"
            texts[4 * k + copy] = " ".join(parts)
    expected = brute_groups(texts)
    assert 40 <= len(set(expected.values())) < 160
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.component_id for r in minhash.near_copies(docs).collect()} == expected


def test_awkward_rows(awkward):
    found = minhash.next_documents(awkward).collect()
    assert len(found) == 11
    by_id = {r.doc_id: r for r in found}
    empty = minhash.of_text("").tobytes().hex()
    assert all(by_id[i].fingerprint == empty for i in (1, 2, 3)) and [by_id[i].n_chars for i in (1, 2, 3)] == [0, 0, 4]
    assert len({r.fingerprint for r in found if r.doc_id in (5, 6)}) == 1
    classes = sorted((r.doc_id or 0, r.component_id or 0) for r in minhash.near_copies(awkward).collect())
    assert classes == [(0, 0), (1, 1), (2, 1), (3, 1), (4, 4), (5, 5), (5, 5), (6, 5), (7, 7), (8, 8), (9, 9)]


def test_empty_table(no_documents):
    assert minhash.next_documents(no_documents).collect() == []
    assert minhash.near_copies(no_documents).collect() == []
