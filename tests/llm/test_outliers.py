import re
from collections import defaultdict

import numpy as np
import pytest

from hazeline.llm import outliers
from tests.llm.conftest import words


def brute_counts(text):
    text = text or ""
    found = re.findall("[^\x20\x09-\x0d]+", text)
    at = defaultdict(list)
    for i in range(len(found) - 7):
        at[tuple(found[i : i + 8])].append(i)
    inside = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(8)}
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    return (
        len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside),
    )


def test_base_statistics_equal_brute_force(spark, documents):
    phrase = words(7, 8)
    extra = [
        (10_001, f"{phrase} {phrase} a b {phrase}"), (10_002, "a a a a a a a a a a"), (10_003, f"{phrase}\n{phrase}\n\n \nx\nx"),
        (10_004, " ".join(f"q{i % 9}" for i in range(40))), (10_005, "a b #|<\u000b é"), (10_006, words(8, 7)), (10_007, words(8, 8)),
    ]
    rows = spark.createDataFrame([(i, t, "en", "s") for i, t in extra], "doc_id long, text string, lang string, source string")
    docs = documents.select("doc_id", "text", "lang", "source").union(rows)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in outliers.base_statistics(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)


FLOORS = np.diag(np.array(outliers.FLOORS) ** 2)


def numpy_whitening(near, scale):
    middle = near.mean(axis=0)
    spread = (near.T @ near / len(near) - np.outer(middle, middle)) * scale + FLOORS
    return np.linalg.slogdet(spread)[1], middle, np.linalg.inv(np.linalg.cholesky(spread))


def numpy_step(x, middle, white):
    bins = np.floor(outliers.BINS_PER_DOUBLING * np.log2((((x - middle) @ white.T) ** 2).sum(axis=1) + outliers.LEAST))
    return numpy_whitening(x[bins <= np.sort(bins)[(len(x) + 6) // 2 - 1]], outliers.HALF_SCALE)


def numpy_estimate(x):
    q = np.quantile(x, np.arange(21) / 20, axis=0, method="inverted_cdf")
    at = np.array([min(range(11), key=lambda k: (q[k + 10, i] - q[k, i], q[k + 5, i])) for i in range(5)])
    halves = q[at + 5, range(5)], q[at + 10, range(5)] - q[at, range(5)]
    starts = [(m, np.diag(1 / np.sqrt((w / 1.349) ** 2 + np.diag(FLOORS)))) for m, w in ((q[10], q[15] - q[5]), halves)]
    starts.append(numpy_whitening(x, 1.0)[1:])
    tried = []
    for middle, white in starts:
        for _ in range(outliers.TRIED):
            det, middle, white = numpy_step(x, middle, white)
        tried.append((det, middle, white))
    _, middle, white = min(tried, key=lambda t: t[0])
    for _ in range(outliers.STEPS):
        _, middle, white = numpy_step(x, middle, white)
    return numpy_whitening(x[(((x - middle) @ white.T) ** 2).sum(axis=1) <= outliers.NEAR], outliers.NEAR_SCALE)[1:]


def test_estimates_equal_numpy(spark):
    rng = np.random.default_rng(5)
    groups = {"a": rng.normal(0, 1, (400, 5)) @ rng.normal(0, 0.5, (5, 5)), "b": rng.normal(3, 0.2, (120, 5)), "c": rng.normal(0, 1, (301, 5))}
    groups["a"][:60] += 40
    groups["c"][:130] = groups["c"][:130] * 0.5 + 9
    rows = [(g, i % outliers.SALTS, *map(float, x)) for g, xs in groups.items() for i, x in enumerate(xs)]
    vectors = spark.createDataFrame(rows, "g string, salt int, " + ", ".join(f"x{i} double" for i in range(5)))
    found = outliers.robust_estimates(vectors).collect()
    assert {r.g for r in found} == set(groups)
    for r in found:
        middle, white = numpy_estimate(groups[r.g])
        np.testing.assert_allclose([r[f"m{i}"] for i in range(5)], middle, rtol=1e-6, atol=1e-8)
        np.testing.assert_allclose([r[f"w{i}_{j}"] for i, j in outliers.PAIRS], [white[i, j] for i, j in outliers.PAIRS], rtol=1e-6, atol=1e-8)


@pytest.mark.parametrize("copied", [False, True])
def test_two_fifths_of_junk_go(spark, copied):
    clean = [(i, words(i, 60 + i % 50), "en", "s") for i in range(240)]
    spoilt = lambda i: " ".join(w + "###" for w in words(i, 60 + i % 50).split())
    junk = [(1000 + i, spoilt(0 if copied else i), "en", "s") for i in range(160)]
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string")
    assert {r.doc_id for r in outliers.quality_verdicts(docs).collect() if r.kept} == set(range(240))


def test_junk_goes_and_clean_texts_stay(spark):
    clean = [(i, words(i, 60 + i % 50), "en", "s") for i in range(120)]
    junk = [(500 + i, " ".join(w + "###" for w in words(i, 60).split()), "en", "s") for i in range(12)]
    alone = [(900, "### " * 9 + words(3, 30), "xx", "rare")]
    docs = spark.createDataFrame(clean + junk + alone, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in outliers.quality_verdicts(docs).collect() if r.kept}
    assert kept == {i for i, *_ in clean} | {900}


def test_awkward_rows(awkward):
    found = outliers.quality_verdicts(awkward).collect()
    assert len(found) == 11
    by_id = {r.doc_id: r for r in found}
    assert all(not by_id[i].kept and by_id[i].base_failed and by_id[i].n_words == 0 for i in (1, 2, 3))
    assert by_id[4].kept and by_id[4].n_words == 40_000 and by_id[9].word_chars == 100_000


def test_empty_table(no_documents):
    assert outliers.quality_verdicts(no_documents).collect() == []


def test_plan_is_native(documents):
    plan = outliers.quality_verdicts(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
    whole = outliers.base_statistics(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", whole)
