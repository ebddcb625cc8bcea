import hashlib

import numpy as np
import public_tokenizers
import pytest

from hazeline.llm import byte_bpe
from tests.llm.conftest import words

CODER = byte_bpe.encoding(byte_bpe.RANKS, public_tokenizers.PATTERN)
TEXTS = [
    "", " ", "  a  b   ", "\n\n x\n", "a'ssx 's t y'll we've", "x" * 3000, "é ü　漢字 🙂🙂 ́ a", words(1, 500), "a b   c", "<|endoftext|>",
]


@pytest.mark.parametrize("size", [1, 5, 64, 1 << 16])
def test_cut_texts_have_the_ids_of_whole_ones(size):
    for text in TEXTS:
        ids = byte_bpe.encode(text, CODER, size)
        assert ids.tolist() == CODER.encode_ordinary(text)
        assert "".join(byte_bpe.pieces(text, size)) == text
        assert byte_bpe.decode(ids, CODER) == text.encode()


def test_partial_characters_decode_to_raw_bytes():
    ids = byte_bpe.encode("🙂", CODER)
    assert b"".join(byte_bpe.decode(ids[i : i + 1], CODER) for i in range(len(ids))) == "🙂".encode()


def test_given_documents(documents):
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    for r in byte_bpe.query(documents.sparkSession, "/root/testdata/sf0.001").collect():
        ids = np.array(CODER.encode_ordinary(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_awkward_rows(awkward):
    texts = sorted((r.doc_id or 0, r.text or "") for r in awkward.collect())
    found = byte_bpe.with_bytes(byte_bpe.with_ids(awkward)).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded).decode()) for r in found) == texts


def test_empty_table(no_documents):
    assert byte_bpe.with_bytes(byte_bpe.with_ids(no_documents)).collect() == []
