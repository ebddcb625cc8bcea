"""Staged tables: a result that several others read is written once, then read back.

The table lies in the shared folder named by ``spark.checkpoint.dir``. It cuts lineage, so
a lost executor costs no second pass over the measurements, and its true size is known to
Catalyst when it picks a join strategy.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


@cache
def _own_folder(application: str) -> str:
    """A temporary folder of a local session for which none is set."""
    return tempfile.mkdtemp(prefix="hazeline-")


def staging_root(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir``, else the folder set on the context.

    Outside local mode one of them is required, and it must not name a local disk by ``file:``.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    local = context.master.split("[")[0] == "local"
    if root is None:
        if not local:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        return _own_folder(context.applicationId)
    # The executors of local-cluster are processes of this host.
    if root.startswith("file:") and not context.master.startswith("local"):
        raise RuntimeError(f"{root} is on a local disk, which executors of other hosts don't share")
    return root


def staging_folder(spark: SparkSession) -> str:
    """This application's own folder below the shared one."""
    return f"{staging_root(spark)}/hazeline-{spark.sparkContext.applicationId}"


#: Folders of tables staged inside ``staged_tables``, innermost last.
_open: list[list[str]] = []


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a table and read it back. This runs a job at once."""
    spark = df.sparkSession
    path = f"{staging_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _open:
        _open[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged_tables(spark: SparkSession) -> Iterator[None]:
    """Drops what was staged inside once all went well; after an error the tables stay, as the
    error may point to one of them."""
    _open.append([])
    try:
        yield
    except BaseException:
        _open.pop()
        raise
    for path in _open.pop():
        drop_folder(spark, path)


def drop_folder(spark: SparkSession, folder: str) -> bool:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def drop_staged(spark: SparkSession) -> bool:
    """Delete all tables this application staged; frames that read them end with them."""
    return drop_folder(spark, staging_folder(spark))


def global_row_number(
    df: DataFrame, order: list[Column], name: str, within: str | None = None
) -> DataFrame:
    """Row numbers over the whole table in the given order, without one task seeing it all.

    Rows are range-partitioned by the order and numbered inside each part; a part starts
    after the row count of the parts before it. The order must end in a unique key. With
    ``within``, a column the order begins with, the numbers start anew for each of its values;
    rows meet by part and value, so a value that most rows have stays in many tasks.
    """
    part, keys = "_part", ["_part"] + [within] * (within is not None)
    ranged = stage(
        df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "numbered"
    )
    ordered = (Window.partitionBy(within) if within else Window).orderBy(part)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy(*keys)
        .agg(F.count("*").alias("_rows"))
        .select(
            *[F.col(k).alias(f"_at_{k}") for k in keys],
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
        )
    )
    # Staged, so that the join knows how small it is before any row moves.
    starts = stage(starts, "starts")
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    numbered = ranged.withColumn("_inside", inside)
    matches = [numbered[k].eqNullSafe(starts[f"_at_{k}"]) for k in keys]
    return (
        numbered.join(starts, matches)
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop(part, "_inside", "_start", *[f"_at_{k}" for k in keys])
    )
