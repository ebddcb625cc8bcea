import random

import pytest

from hazeline.llm import sentence_spans as spans
from tests.llm.conftest import words


def test_sentences_join_to_the_text():
    for text in ("", "a b. c d! e\nf g.h\n\n", words(1, 100), "\n\n \n", "é. ü? \t\nZ.", " lead. x", "a.\r\nb. " + words(2, 60) + "\nq"):
        parts = spans.sentences(text.encode())
        assert b"".join(parts).decode() == text and all(len(p.split()) <= spans.MAX_WORDS for p in parts)
    assert spans.sentences(b"a b. c! d\ne") == [b"a b. ", b"c! ", b"d\n", b"e"]


def test_span_ends_equal_brute_force():
    rng = random.Random(2)
    for _ in range(500):
        counts = [rng.choice([0, 1, 3, 5, 9, 20, 25]) for _ in range(rng.randrange(12))]
        enough = lambda c: sum(c) >= 16 and sum(x > 0 for x in c) >= 2
        expected = [next((j for j in range(i + 1, len(counts) + 1) if counts[i] and enough(counts[i:j])), 0) for i in range(len(counts))]
        assert spans.span_ends(counts, 16) == expected


def brute(texts):
    """Removed sentences by doc_id, by the rule's words, in one pass in order."""
    first, held = {}, {}
    for i in sorted(texts):
        tokens = [tuple(p.split()) for p in spans.sentences(texts[i].encode())]
        enough = lambda a, b: sum(map(len, tokens[a:b])) >= spans.MIN_WORDS and sum(map(bool, tokens[a:b])) >= 2
        n, held[i] = len(tokens), []
        for k in range(n):
            if tokens[k]:
                held[i] += [next(((k, j) for j in range(k + 1, n + 1) if enough(k, j)), None)]
                held[i] += [next(((j, k + 1) for j in range(k, -1, -1) if enough(j, k + 1)), None)]
        held[i] = {b: sum(tokens[b[0] : b[1]], ()) for b in held[i] if b}
        for bounds, run in sorted(held[i].items()):
            first.setdefault(run, (i, bounds[0]))
    return {
        i: sorted({k for b, run in found.items() if first[run] != (i, b[0]) for k in range(*b)}) for i, found in held.items()
    }


def test_given_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    expected = brute({r.doc_id: r.text or "" for r in docs.collect()})
    found = {r.doc_id: list(r.removed) for r in spans.without_repeats(docs).collect()}
    assert found == expected and any(expected.values())


PASSAGE = " ".join(words(k, 12).capitalize() + "." for k in range(50, 56))


@pytest.mark.parametrize("glue", [" ", "\n"])
def test_passage_goes_but_for_its_first_place(spark, glue):
    rows = [(i, f"{words(i, 30)}.{glue}{PASSAGE}{glue}{words(100 + i, 30)}.") for i in range(30)] + [(99, words(99, 200))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.text for r in spans.without_repeats(docs).collect()}
    assert found[0] == rows[0][1] and found[99] == rows[-1][1]
    for i in range(1, 30):
        assert PASSAGE[:60] not in found[i] and words(i, 30) in found[i] and words(100 + i, 30) in found[i]


def test_long_text_without_marks_is_cut_too(spark):
    same = words(5, 300)
    rows = [(1, same), (2, same), (3, f" {same}\n")]
    found = {r.doc_id: r.text for r in spans.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: same, 2: "", 3: ""}
    assert all(len(p.split()) <= spans.PIECE_WORDS for p in spans.sentences(same.encode()))


def test_unmarked_passage_goes_at_any_offset(spark):
    same = words(7, 60)
    rows = [(i, f"{words(100 + i, n)} {same} {words(200 + i, 15)}") for i, n in enumerate((3, 10, 17, 24, 31))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text.split() for r in spans.without_repeats(docs).collect()}
    assert " ".join(found[0]) == rows[0][1]
    for i in range(1, 5):
        before, after = rows[i][1].split(same)
        assert found[i][: len(before.split())] == before.split() and found[i][-15:] == after.split()
        assert len(found[i]) - len(before.split()) - 15 <= 2 * spans.PIECE_WORDS


def test_short_sentences_at_the_end_of_a_passage_go(spark):
    same = f"{words(8, 12)}. {words(9, 12)}. Three more words. So be it."
    rows = [(i, f"{words(100 + i, 20)}. {same} {words(200 + i, 20)}.") for i in range(3)]
    found = {r.doc_id: r.text for r in spans.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {0: rows[0][1]} | {i: f"{words(100 + i, 20)}. {words(200 + i, 20)}." for i in (1, 2)}


def test_awkward_rows(awkward):
    found = spans.without_repeats(awkward)
    assert found.columns == awkward.columns + ["n_sentences", "n_removed", "removed"]
    rows = found.collect()
    assert len(rows) == 11
    texts = {r.doc_id: r.text for r in rows}
    assert texts[1] is None and texts[2] == "" and texts[3] == " \t\n " and texts[8] == "é. ü! ñ?\nß"
    assert [r.text for r in rows if r.doc_id == 5] == [words(2, 50)] * 2 and texts[6] == ""
    again = spans.without_repeats(found)
    assert again.columns == found.columns


def test_empty_table(no_documents):
    assert spans.without_repeats(no_documents).collect() == []
