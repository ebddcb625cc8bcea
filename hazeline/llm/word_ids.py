"""Token ids of whole texts, looked up chunk by chunk.

The tokenizer drops white space and never joins across it, so the ids of a text are those of its
chunks between ASCII white space, one after another. Known chunks come from a cache of two
bounded generations; the tokenizers library encodes the others, many plain words in one call.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
CACHED, TOGETHER = 250_000, 1000
#: Letters a to z and à to ÿ in UTF-8.
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf])+")
#: A single mark that ends a word; it has ids of its own, so the word needs no second entry.
MARKED = re.compile(rb"[.,](?=[ \n])(?<=[a-z].)")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


class ChunkIds:
    """Ids of lower-case chunks as little-endian unsigned 16-bit integers."""

    def __init__(self, path: str, most: int = CACHED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_file(path)
        self.coder.encode_special_tokens = True
        vocabulary = self.coder.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.most, self.known, self.older = most, {}, {}

    def encode(self, text: bytes) -> np.ndarray:
        """Ids of a whole text in UTF-8."""
        chunks = MARKED.sub(rb" \g<0>", text.translate(LOWER)).split()
        found = list(map(self.known.get, chunks))
        if None in found:
            own = self._learn({c for c, ids in zip(chunks, found) if ids is None})
            found = [own[c] if ids is None else ids for c, ids in zip(chunks, found)]
        return np.frombuffer(b"".join(found), "<u2")

    def _learn(self, chunks: set[bytes]) -> dict[bytes, bytes]:
        own = {c: ids for c in chunks if (ids := self.older.get(c)) is not None}
        fresh = sorted(chunks - own.keys())
        plain = [c for c in fresh if PLAIN.fullmatch(c)]
        for at in range(0, len(plain), TOGETHER):
            own |= self._together(plain[at : at + TOGETHER])
        if len(plain) < len(fresh):
            other = [c for c in fresh if c not in own]
            coded = self.coder.encode_batch_fast([c.decode() for c in other], add_special_tokens=False)
            own |= {c: np.array(e.ids, "<u2").tobytes() for c, e in zip(other, coded)}
        self.known |= own
        if len(self.known) > self.most:
            self.older, self.known = self.known, {}
        return own

    def _together(self, chunks: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Plain words and their ids by one call; each of them ends in an end token."""
        coded = self.coder.encode_batch_fast([b" ".join(chunks).decode()], add_special_tokens=False)[0]
        ids = np.array(coded.ids, "<u2")
        stops = (2 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        return zip(chunks, map(ids.tobytes().__getitem__, map(slice, [0, *stops], stops)))


@cache
def chunk_ids(path: str) -> ChunkIds:
    return ChunkIds(path)
