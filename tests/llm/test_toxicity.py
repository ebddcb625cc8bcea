import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazeline.llm import toxicity
from tests.llm.conftest import words

BAD = ["idiot", "moron", "stupid", "loser", "trash"]


@pytest.fixture(scope="module")
def learned(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        text, toxic = words(i, 60).split(), int(i % 4 == 0)
        if toxic:
            for w in rng.sample(BAD, 3):
                text.insert(rng.randrange(len(text)), w)
        rows.append((i, "the story of " + " ".join(text), "en", "s", 0))
        labels.append((i, 1, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return docs, labels, toxicity.fit(docs, labels)


def test_trigrams_equal_brute_force(spark):
    texts = ["Abc ab", "", None, "é1 z", "x" * 3]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    found = {r.code: r.n for r in toxicity.letter_trigrams(rows).collect()}
    expected = Counter()
    for text in texts:
        codes = [toxicity.CODES[b] for b in ((text or "").lower().encode() + b"  ")]
        expected.update(int((a * 28 + b) * 28 + c) for a, b, c in zip(codes, codes[1:], codes[2:]))
    assert found == dict(expected)


def brute_cost(channel, token, text):
    """The cheapest way to get a text from a token, over all ways."""
    ways = {("", 0.0)}
    for at in range(len(token)):
        ways = {(t + c, cost + k) for t, cost in ways for c, k in channel.options(token, at) if text.startswith(t + c)}
    return min((cost for t, cost in ways if t == text), default=None)


def test_decoding_equals_brute_force(learned):
    channel = learned[2].channel
    for token in ("1d10t", "m0r0n", "l0ser!", "tra$h", "1l1"):
        candidates = {""}
        for at in range(len(token)):
            candidates = {t + c for t in candidates for c, _ in channel.options(token, at)}

        def total(text):
            change = brute_cost(channel, token, text)
            a = b = toxicity.EDGE
            for c in text:
                a, b = b, ord(c) - 96
            letters = channel.spelling(text) + channel.cost[(a * 28 + b) * 28] - np.log(1 - toxicity.LEXICON_SHARE)
            word = channel.words.get(text, np.inf) - np.log(toxicity.LEXICON_SHARE)
            return change + min(letters, word)

        assert total(channel.restore(token)) == pytest.approx(min(map(total, candidates)))


@pytest.mark.parametrize(
    "disguised, plain",
    [("1d10t", "idiot"), ("i d i o t", "idiot"), ("m-o-r-o-n", "moron"), ("stuuuupid", "stupid"), ("$tup1d", "stupid"), ("L0SER", "loser"), ("tr*sh", "trash"), ("TTTRRRAAASSSHHH", "trash")],
)
def test_disguised_words_are_restored_and_scored(learned, disguised, plain):
    model = learned[2]
    text = f"{words(7, 30)} {disguised}, {words(8, 30)} m0r0n 1di0t".encode()
    assert plain in {w for _, w in model.channel.restorations(text)}
    spelled = text.replace(disguised.encode(), plain.encode()).replace(b"m0r0n 1di0t", b"moron idiot")
    assert model.score(text) == pytest.approx(model.score(spelled), abs=1e-9) and model.score(text) >= 0.5
    assert model.score(text.replace(disguised.encode(), b"fine").replace(b"m0r0n 1di0t", b"good day")) < 0.1


@pytest.mark.parametrize("letters", [4, 20, 50, 5000])
def test_drawn_out_words_of_any_length(learned, letters):
    model = learned[2]
    text = f"{words(7, 30)} st{'u' * letters}pid l{'0' * letters}ser {words(8, 30)}".encode()
    assert {"stupid", "loser"} <= {w for _, w in model.channel.restorations(text)}
    assert model.score(text) >= 0.5


@pytest.mark.parametrize("gap", " .-_")
def test_several_words_set_apart(learned, gap):
    model, plain = learned[2], "the story of the stupid idiot the moron of the loser trash"
    (found,) = model.channel.restorations(gap.join(plain.replace(" ", "")).encode())
    assert found[1] == plain
    assert model.score(gap.join("thestoryofthestupididiot").encode()) == pytest.approx(model.score(b"the story of the stupid idiot"))


def test_long_tokens_take_linear_time_and_end(learned):
    channel = learned[2].channel
    for token in ("ab4" * 20_000, "a b " * 20_000, "1" * 100_000 + "a", "*e" * 3_000):
        assert len(channel.found_in(token.encode())) == 1


def test_a_narrow_beam_and_short_lag_still_end_words(learned, monkeypatch):
    monkeypatch.setattr(toxicity, "BEAM", 40)
    monkeypatch.setattr(toxicity, "LAG", 13)
    channel = toxicity.Channel(learned[2].channel.letters, learned[2].channel.words)
    assert channel.restore("s t u p i d", True) == "stupid" and channel.restore("$tup1d") == "stupid"


def test_lexicon_equals_brute_force(spark, monkeypatch):
    texts = ["Abc abc, of it! it it", "it st*pid of soooo it", None, "", "it é of of of", "abc abc x"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    expected = {"abc": 4, "of": 5, "it": 5}
    assert {r.word: r.n for r in toxicity.word_counts(rows).collect()} == expected
    assert toxicity.lexicon(rows) == {"of": 5, "it": 5} and toxicity.lexicon(rows, 0.5) == {}
    monkeypatch.setattr(toxicity, "HELD_WORDS", 1)
    assert {r.word: r.n for r in toxicity.word_counts(rows).collect()} == expected


def test_clean_texts_are_left_alone(learned):
    model = learned[2]
    for text in ("", "the story of a b c d", "call 555-1234 at 10am", "thing### and&&& more!!", "mail me at a1@b2.example.com", "x " * 5000):
        assert model.score(text.encode()) < 0.5


def test_held_out_rows_are_never_learnt_from(learned):
    docs, labels, _ = learned
    flipped = labels.withColumn("toxic", F.when(toxicity.fold_of(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.fit(docs, flipped)
    assert again.weights == learned[2].weights and again.bias == learned[2].bias


def test_scores_agree_with_labels(learned):
    docs, labels, model = learned
    rows = toxicity.score(docs, model).join(labels, "doc_id").collect()
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) > 0.98
    from zlib import crc32

    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    kept = toxicity.clean_documents(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if not r.predicted}


def test_awkward_rows(awkward, learned, no_labels):
    found = toxicity.score(awkward, learned[2]).collect()
    assert len(found) == 11 and all(0 <= r.score <= 1 and r.predicted == 0 for r in found)
    kept = toxicity.clean_documents(awkward, no_labels)
    assert kept.columns == awkward.columns and kept.count() == 11


def test_odd_labels(awkward, spark):
    labels = spark.createDataFrame([(4, 1, 1), (4, 1, 0), (None, 1, 1), (5, None, None), (77, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.score(awkward, toxicity.fit(awkward, labels)).count() == 11


def test_empty_table(no_documents, no_labels):
    assert toxicity.score(no_documents, toxicity.fit(no_documents, no_labels)).collect() == []
