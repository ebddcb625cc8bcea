"""Byte-level BPE ids by the tiktoken library, and back to bytes.

The rank file is local to every host; its path is a parameter. A long text is cut where the
pattern starts a new match whatever follows: before white space that comes after something
else. So the library never holds more than about ``PIECE_CHARS`` at once, unless a text has a
longer run without white space. Ids are those of the whole text.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.inputs import in_slices

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE_CHARS = 1 << 16
BOUNDARY = re.compile(r"(?<=\S)(?=\s)")


@cache
def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    with open(ranks, "rb") as lines:
        pairs = (line.split() for line in lines)
        table = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Parts of a text, cut at the first safe boundary after ``size`` characters each."""
    start = 0
    while len(text) - start > size:
        cut = BOUNDARY.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode(text: str, coder: tiktoken.Encoding, size: int = PIECE_CHARS) -> np.ndarray:
    """Ids of a whole text as little-endian unsigned 32-bit integers."""
    parts = [np.array(coder.encode_ordinary(p), "<u4") for p in pieces(text, size)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def decode(ids: np.ndarray, coder: tiktoken.Encoding) -> bytes:
    """The raw bytes of ids, also where they are no whole characters."""
    return coder.decode_bytes(ids.tolist())


def with_ids(docs: DataFrame, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(doc_id, ids): ids as little-endian unsigned 32-bit integers in a binary column.

    A null text counts as empty and gives no ids. Rows that repeat stay.
    """

    def per_batch(batches):
        coder = encoding(ranks, pattern)
        for batch in in_slices(batches):
            ids = [encode(t or "", coder).tobytes() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        per_batch, "doc_id bigint, ids binary"
    )


def with_bytes(encoded: DataFrame, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``with_ids`` rows with the decoded bytes beside them, as (doc_id, ids, decoded)."""

    def per_batch(batches):
        coder = encoding(ranks, pattern)
        for batch in in_slices(batches):
            texts = [decode(np.frombuffer(b, "<u4"), coder) for b in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["ids"], pa.array(texts, pa.binary())], ["doc_id", "ids", "decoded"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(per_batch, "doc_id bigint, ids binary, decoded binary")


def query(spark, folder: str) -> DataFrame:
    from hazeline.llm.inputs import table

    both = with_bytes(with_ids(table(spark, folder, "documents")))
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
