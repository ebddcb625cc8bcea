"""Landing files in a table once, however often they are landed.

Rows lie in a partition per period and file; a list beside them has a row per landed file with
its number of rows and a checksum. Landing a file again that is in the list as it was changes
nothing; a file with other rows replaces its own partition, by dynamic partition overwrite. Rows
are written before the list, so after a landing that died the next one writes the same again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.operators.prepare import keep_keys
from hazeline.plans.staging import stage

KEYS = ["period", "file"]


def landed_files(spark: SparkSession, folder: str) -> DataFrame | None:
    """(period, file, rows, checksum) of every landed file as it is now; None without any."""
    try:
        seen = spark.read.parquet(f"{folder}/files")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    latest = seen.groupBy(*KEYS).agg(F.max(F.struct("number", "rows", "checksum")).alias("_last"))
    return latest.select(*KEYS, "_last.rows", "_last.checksum", "_last.number")


def land(rows: DataFrame, folder: str) -> DataFrame:
    """Land rows with text columns ``period`` and ``file``; returns the files that were new or changed.

    A call holds whole files. The checksum adds up row hashes, so it doesn't depend on the order
    of rows. No file's rows meet in one task: each task writes its part of a file's partition.
    """
    spark = rows.sparkSession
    row = F.xxhash64(*[c for c in rows.columns if c not in KEYS]).cast("decimal(38,0)")
    marks = rows.groupBy(*KEYS).agg(F.count("*").alias("rows"), F.sum(row).alias("checksum"))
    marks = stage(marks, "marks")
    before = landed_files(spark, folder)
    number = 0
    if before is not None:
        before = stage(before, "landed")
        number = before.agg(F.max("number")).first()[0] or 0
        marks = stage(marks.join(before.select(*KEYS, "rows", "checksum"), [*KEYS, "rows", "checksum"], "left_anti"), "marks")
    if not marks.isEmpty():
        writer = keep_keys(rows, marks, KEYS).write.partitionBy(*KEYS).mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").parquet(f"{folder}/rows")
        marks.withColumn("number", F.lit(number + 1)).write.mode("append").parquet(f"{folder}/files")
    return marks


def landed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """All landed rows; periods and files are text, and pruned by their folders."""
    found = spark.read.parquet(f"{folder}/rows").schema
    # A period is no date: its type is declared, not guessed from the folders' names.
    as_text = T.StructType([T.StructField(f.name, T.StringType() if f.name in KEYS else f.dataType) for f in found])
    return spark.read.schema(as_text).parquet(f"{folder}/rows")
