from collections import defaultdict
from zlib import crc32

import numpy as np
from tokenizers import Tokenizer

from hazeline.llm import packing, word_ids
from tests.llm.conftest import words

ODD = [
    "", "  ", "İstanbul ǅ x", "it's we'll 'stuff don't", "a.b, c.. d.,", "<|endoftext|> hi <|startoftext|>",
    "é x́ ́y", "naïve—dash 12 3a b4", "\x1c\x1dq\x85z\xa0w", "ÀÉ ß× a÷b ÿ. ÿ..", "Ωσς ΑΣ.", "．，", "word." * 3,
]


def coder():
    found = Tokenizer.from_file(word_ids.WORD_BPE)
    found.encode_special_tokens = True
    return found


def test_chunk_ids_equal_those_of_whole_texts(documents):
    texts = ODD + [r.text or "" for r in documents.select("text").limit(60).collect()]
    whole = coder().encode_batch(texts, add_special_tokens=False)
    for most in (10, 100_000):
        mine = word_ids.ChunkIds(word_ids.WORD_BPE, most)
        for text, expected in zip(texts * 2, whole * 2):
            assert mine.encode(text.encode()).tolist() == expected.ids


def test_windows_are_full_or_powers_of_two():
    rng = np.random.default_rng(2)
    docs = [rng.integers(3, 900, n).astype("<u2") for n in [*rng.integers(1, 3000, 80), 20_000, 4096, 1]]
    found = packing.windows(docs)
    lengths = [sum(n for _, _, n in w) for w in found]
    assert all(n == 4096 or n & (n - 1) == 0 for n in lengths) and sum(n < 4096 for n in lengths) <= 12
    pieces = defaultdict(list)
    for w in found:
        for doc, start, n in w:
            pieces[doc].append((start, n))
    for i, d in enumerate(docs):
        at = 0
        for start, n in sorted(pieces[i]):
            assert start == at and n > 0
            at += n
        assert at == len(d)


def test_neighbours_are_ranked_by_bm25():
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 50, rng.integers(20, 60)) for _ in range(30)]
    index = packing.ShardIndex(docs)
    index.unused[:5] = False
    mean, df = np.mean([len(d) for d in docs]), [sum(t in d for d in docs) for t in range(50)]

    def weight(d, t):
        tf = (docs[d] == t).sum()
        idf = np.log(1 + (30 - df[t] + 0.5) / (df[t] + 0.5))
        return idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(docs[d]) / mean))

    query = sorted(set(docs[0].tolist()), key=lambda t: (-weight(0, t), t))[: packing.QUERY_TERMS]
    scores = {d: sum(weight(d, t) for t in query) for d in range(5, 30)}
    found = index.neighbours(0).tolist()
    assert set(found) == {d for d, s in scores.items() if s > 0}
    assert all(scores[a] >= scores[b] - 1e-9 for a, b in zip(found, found[1:]))


def test_like_documents_share_a_window():
    rng = np.random.default_rng(4)
    docs = [rng.integers(1000 * (i % 4), 1000 * (i % 4) + 300, 1024) for i in range(16)]
    assert all(len({d % 4 for d, _, _ in w}) == 1 for w in packing.windows(docs))


def packed_whole(rows, texts):
    """Checks the contract of rows and returns the number of pieces of each document."""
    tokens = {i: [*e.ids, 2] for i, e in zip(texts, coder().encode_batch([t or "" for t in texts.values()], add_special_tokens=False))}
    by_sequence, count = defaultdict(list), defaultdict(int)
    for r in rows:
        own = np.array(tokens[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert r.doc_tokens == len(tokens[r.doc_id]) and r.ids_crc32 == crc32(own) and r.length > 0
        by_sequence[r.sequence_id].append(r)
        count[r.doc_id] += r.length
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 4096 or at & (at - 1) == 0
    return {i: n / len(tokens[i]) for i, n in count.items()}


def test_given_documents(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert set(packed_whole(packing.packed(documents.repartition(3)).collect(), texts).values()) == {1.0}


def test_awkward_rows(awkward):
    texts = {r.doc_id: r.text for r in awkward.collect()}
    found = packing.packed(awkward, with_ids=True).collect()
    shares = packed_whole(found, texts)
    assert shares == {i: 1.0 + (i == 5) for i in texts}
    assert all(len(r.ids) == 4 * r.length for r in found)


def test_empty_table(no_documents):
    assert packing.packed(no_documents).collect() == []


def test_a_sequence_fills_up_across_documents(spark):
    docs = spark.createDataFrame([(i, words(i, 700)) for i in range(40)], "doc_id long, text string").coalesce(1)
    found = packing.packed(docs).collect()
    assert max(r.offset + r.length for r in found) == 4096 and len({r.sequence_id for r in found}) < 40
