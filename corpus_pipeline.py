"""Cleans a corpus for training: each stage reads what the one before it wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm import contamination, neardup, quality, secrets, sentencepiece
from barline.llm.common import checkpoint_folder, documents


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.accepted(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the document with the smallest doc_id stays."""
    return neardup.deduplicated(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return contamination.clean(docs, contamination.benchmark(spark, sf_dir), without_id=True)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind in brackets; n_chars follows the text."""
    out = secrets.redact(docs, secrets.fit(docs))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, and whether decoding them restores it."""
    rows = sentencepiece.encode(docs, sentencepiece.vocabulary())
    return rows.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "exact")


STAGES = [
    ("quality_classifier", good_quality),
    ("minhash_near_dedup", one_of_each_group),
    ("benchmark_decontamination", decontaminated),
    ("secret_scan", without_secrets),
    ("sentencepiece", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the documents table; each result is written as Parquet and read again."""
    rows = documents(spark, sf_dir)
    folder = f"{checkpoint_folder(spark)}/{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}_{name}"
        stage(spark, rows, sf_dir).write.parquet(path)
        rows = spark.read.parquet(path)
    return rows
