"""Tables and column choices that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_bytes(name: str = "text") -> Column:
    """Whole text as UTF-8 bytes; null is empty."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def fold_of(key: Column) -> Column:
    """Fold 0 to 4 of a row, from the CRC-32 of its id as text; null counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """Whole texts of an Arrow batch as UTF-8 bytes; null is empty."""
    return [t or b"" for t in batch[name].cast(pa.binary()).to_pylist()]


def spare_name(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def in_slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of a few, so that a task holds few texts as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
