import itertools

import numpy as np
import pytest
import xxhash

from hazeline.llm import golay, simhash
from tests.llm.conftest import words


def brute_fingerprint(text):
    parts = (text or "").encode().lower().split()
    shingles = [b" ".join(parts[i : i + 3]) for i in range(len(parts) - 2)] or ([b" ".join(parts)] if parts else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    return {i: find(i) for i in prints}


def test_words_two_bits_apart_share_a_codeword():
    words_ = np.random.default_rng(1).integers(0, 1 << 23, 300)
    own, n = golay.codeword_indices(words_)
    assert set(n) <= {1, 6}
    for i, j in itertools.combinations_with_replacement(range(23), 2):
        other, m = golay.codeword_indices(words_ ^ (1 << i) ^ (1 << j if i != j else 0))
        for a, k, b, l in zip(own, n, other, m):
            assert set(a[:k]) & set(b[:l])


def test_every_word_is_within_three_bits_of_one_codeword():
    patterns, n = golay.error_table()
    assert (n > 0).all() and max(int(p).bit_count() for p in patterns[:, 0]) == 3


@pytest.mark.parametrize("paired", [0, simhash.PAIRED])
def test_components_equal_brute_force(spark, paired):
    texts = {i: words(i // 4, 80) + " end" * (i % 4 == 1) + f" tail{i % 4}" * (i % 4 > 1) for i in range(60)}
    texts |= {100 + i: words(99, 400).replace("w7x", f"w{i}y", 1) for i in range(40)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    expected = brute_components(prints)
    assert len(set(expected.values())) < len(texts)
    found = {r.doc_id: r for r in simhash.near_duplicates(docs, paired=paired).collect()}
    assert {i: r.fp & (1 << 64) - 1 for i, r in found.items()} == prints
    assert {i: r.component_id for i, r in found.items()} == expected


def test_chains_and_flipped_bits_meet(spark):
    rng = np.random.default_rng(3)
    prints, now = {}, int(rng.integers(0, 1 << 63))
    for i in range(300):
        prints[i] = now
        now ^= 1 << int(rng.integers(0, 64)) ^ (1 << int(rng.integers(0, 64)) if i % 2 else 0)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in set(prints.values())]
    links = simhash.fingerprint_links(spark.createDataFrame(signed, "fp long"), paired=8)
    from hazeline.llm.components import connected_components

    roots = {r.node: r.root for r in connected_components(links).collect()}
    mine = brute_components({fp: fp & (1 << 64) - 1 for (fp,) in signed})
    assert {i: roots.get(i, i) for i in mine} == mine


def test_awkward_rows(awkward):
    found = simhash.near_duplicates(awkward).collect()
    assert len(found) == 11
    by_id = {r.doc_id: r for r in found}
    assert {by_id[i].fp for i in (1, 2, 3)} == {0} and {by_id[i].component_id for i in (1, 2, 3)} == {1}
    assert [r.component_id for r in found if r.doc_id in (5, 6)] == [5, 5, 5]
    kept = simhash.keep_first(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 4, 5, 5, 7, 8, 9]


def test_stage_keeps_the_first_of_each_component(spark):
    texts = {i: words(i // 4, 80) + " end" * (i % 4 == 1) + f" tail{i % 4}" * (i % 4 > 1) for i in range(60)}
    first = brute_components({i: brute_fingerprint(t) for i, t in texts.items()})
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert sorted(r.doc_id for r in simhash.keep_first(docs).collect()) == sorted(set(first.values()))


def test_empty_table(no_documents):
    assert simhash.near_duplicates(no_documents).collect() == []
    assert simhash.keep_first(no_documents).collect() == []


def test_plan_has_no_all_pairs_join(documents):
    plan = simhash.near_duplicates(documents)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
