import random

from hazeline.llm import licences

TEMPLATES = [t.encode().split() for _, t in licences.TEMPLATES]


def test_matching_statistics_equal_brute_force():
    machine, rng = licences.automaton(), random.Random(1)
    runs = {tuple(t[i:j]) for t in TEMPLATES for i in range(len(t)) for j in range(i + 1, min(i + 40, len(t)) + 1)}
    for _ in range(200):
        doc = []
        for _ in range(4):
            template = rng.choice(TEMPLATES)
            start = rng.randrange(len(template))
            doc += template[start : start + rng.randrange(1, 9)]
        longest = [max((n for n in range(1, i + 2) if tuple(doc[i + 1 - n : i + 1]) in runs), default=0) for i in range(len(doc))]
        expected = [(i + 1 - n, n) for i, n in enumerate(longest) if i + 1 == len(doc) or longest[i + 1] != n + 1]
        found = list(machine.runs([machine.words[w] for w in doc], 0, 1))
        assert [f[:2] for f in found] == expected
        for start, n, ends in found:
            assert ends == {
                (k, j) for k, t in enumerate(TEMPLATES) for j in range(n - 1, len(t)) if t[j - n + 1 : j + 1] == doc[start : start + n]
            }


def test_unknown_words_break_a_run():
    machine = licences.automaton()
    first = TEMPLATES[0][:4]
    assert [r[:2] for r in machine.runs([machine.words[w] for w in first[:2]] + [0] + [machine.words[w] for w in first[2:]], 0, 1)] == [(0, 2), (3, 2)]


def test_changed_notice_is_still_found():
    notice = licences.TEMPLATES[0][1].split()
    changed = notice[:20] + ["really"] + notice[20:50] + notice[52:]
    found = licences.scan(" ".join(["x", "y", *changed, "z"]).encode())
    assert found["labels"] == "mit" and found["base_labels"] == "" and 0.9 < found["score"] < 1
    assert found["spans"][0]["first"] == 2 and found["spans"][0]["stop"] == 2 + len(changed)


def test_half_a_notice_is_not_enough():
    notice = licences.TEMPLATES[0][1].split()
    found = licences.scan(" ".join(notice[:40]).encode())
    assert found["labels"] == "" and 0.4 < found["score"] < 0.6


def brute_places(text):
    import re

    found = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if c.isascii() else c for c in text))
    places = [(i, label) for phrase, label in licences.PHRASES.items() for i in range(len(found)) if found[i : i + len(phrase.split())] == phrase.split()]
    return len(found), sorted(places)


def test_phrases_equal_brute_force(spark, documents):
    extra = [
        (9001, "MIT License mit-license MIT\nlicense, mit mit license"), (9002, "GNU General Public License; apache_license Apachelicense"),
        (9003, "mit éa license apache9 license"), (9004, "general public general public license public license"),
    ]
    docs = documents.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    hits = 0
    for r in licences.licence_scan(docs).collect():
        n, places = brute_places(texts[r.doc_id])
        starts = [i for i, _ in places]
        assert (r.n_words, r.n_base) == (n, len(places))
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
        hits += bool(places)
    assert hits >= 4


def test_awkward_rows(awkward):
    found = licences.licence_scan(awkward).collect()
    assert len(found) == 11
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].n_words == 0 and by_id[i].score == 0 and by_id[i].first_word is None for i in (1, 2, 3))


def test_very_long_repetition(spark):
    text = " ".join(licences.TEMPLATES[4][1] for _ in range(2000))
    (row,) = licences.licence_scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert row.n_base == 2000 and "gpl" in row.labels and row.score == 1


def test_empty_table(no_documents):
    assert licences.licence_scan(no_documents).collect() == []
