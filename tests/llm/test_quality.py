import numpy as np
import pytest
from pyspark.sql import functions as F

from hazeline.llm import quality
from hazeline.llm.inputs import fold_of
from tests.llm.conftest import words


def test_fit_recovers_ordered_grades():
    rng = np.random.default_rng(1)
    n, grades = 900, [0, 2, 5]
    score = rng.normal(0, 2, n)
    grade = np.array(grades)[np.digitize(score + rng.logistic(0, 0.3, n), [-1, 1.5])]
    rows = np.repeat(np.arange(n), 2)
    places, values = np.tile([3, 7], n), np.column_stack([score, np.ones(n)]).reshape(-1)
    model = quality.fit_ordinal(places, values, rows, grade, grades, rounds=400, ridge=0.0)
    assert list(model.thresholds) == sorted(model.thresholds) and model.weights[3] > 1
    tails = np.array([model.tails({3: s, 7: 1.0}) for s in score])
    assert (np.diff(tails, axis=1) <= 0).all()
    guess = np.array(grades)[(tails >= 0.5).sum(axis=1)]
    assert (guess == grade).mean() > 0.85
    expected = np.array([model.expected(t) for t in tails])
    assert np.corrcoef(expected, grade)[0, 1] > 0.9 and 0 <= expected.min() and expected.max() <= 5


def test_gradient_is_that_of_the_likelihood():
    """After many rounds without ridge no small step of any parameter helps."""
    rng = np.random.default_rng(2)
    n = 200
    x = rng.normal(0, 1, n)
    grade = np.digitize(x + rng.logistic(0, 1, n), [-1, 1])
    model = quality.fit_ordinal(np.full(n, 5), x, np.arange(n), grade, [0, 1, 2], rounds=3000, ridge=0.0)

    def loss(w, a, b):
        tail = lambda t: 1 / (1 + np.exp(t - w * x))
        p = np.select([grade == 0, grade == 1], [1 - tail(a), tail(a) - tail(b)], tail(b))
        return -np.log(p).mean()

    at = [model.weights[5], *model.thresholds]
    best = loss(*at)
    for i in range(3):
        for step in (-0.05, 0.05):
            assert loss(*[v + step * (i == j) for j, v in enumerate(at)]) > best - 1e-6


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = quality.score(docs, quality.fit(docs, quality.ratings(labels)))
    held = scored.join(labels, "doc_id").where(fold_of(F.col("doc_id")) == 0)
    rows = held.select("selected", "quality", "expected_grade").collect()
    assert sum(r.selected == (r.quality == 1) for r in rows) / len(rows) > 0.95
    assert all(r.selected for r in rows if r.quality == 1)


def test_ratings(spark):
    labels = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (4, 1, None), (5, None, 1), (None, 1, 0), (6, 1, 0), (6, 0, 0)]
    found = quality.ratings(spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert sorted(map(tuple, found)) == [(1, 2), (2, 1), (3, 0), (4, 2), (6, 0)]


@pytest.fixture
def rated(spark):
    good = [(i, words(i, 60), "en", "s", 0) for i in range(60)]
    poor = [(100 + i, " ".join(w + "!!" for w in words(i, 60).upper().split()), "en", "s", 0) for i in range(40)]
    docs = spark.createDataFrame(good + poor, "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame([(r[0], int(r[0] < 100), 0) for r in good + poor], "doc_id long, quality int, toxic int")


def test_selection_keeps_good_documents_whole(rated, awkward):
    docs, labels = rated
    kept = quality.selected_documents(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(60))
    model = quality.fit(docs, quality.ratings(labels))
    found = quality.score(awkward, model).collect()
    assert len(found) == 11 and all(0 <= r.expected_grade <= 2 and len(r.tails) == 1 for r in found)


def test_awkward_rows_and_few_labels(awkward, no_labels):
    kept = quality.selected_documents(awkward, no_labels)
    assert kept.columns == awkward.columns and kept.count() == 11


def test_empty_table(no_documents, no_labels):
    assert quality.selected_documents(no_documents, no_labels).collect() == []
    assert quality.score(no_documents, quality.fit(no_documents, quality.ratings(no_labels))).collect() == []
