"""The corpus pipeline: stages over documents, each written as Parquet and read by the next.

Every stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the
last return the columns of documents; the last returns the pieces of packed sequences.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.llm import packing, quality, sentence_spans, simhash, toxicity
from hazeline.plans.staging import staging_folder


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose grade is likelier above the lowest than not."""
    return quality.selected_documents(docs, _labels(spark, sf_dir))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below one half."""
    return toxicity.clean_documents(docs, _labels(spark, sf_dir))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id."""
    return simhash.keep_first(docs)


def drop_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the sentences of spans that occurred before; no document goes."""
    cut = sentence_spans.without_repeats(docs).withColumn("n_chars", F.length("text").cast("bigint"))
    return cut.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.packed(docs)


STAGES = [
    ("quality classifier", select_quality),
    ("toxicity", drop_toxic),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", drop_repeated_spans),
    ("packing", pack),
]

#: Trained models, XXH64 fingerprints and tokenizers are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{staging_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
