"""Helpers that several operators use."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet").select(*columns or ("*",))


def remainder(doc_id: Column | str, by: int) -> Column:
    """crc32 of an id as text, modulo `by`; null for a null id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % by


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named by the cluster; one below the warehouse where none is named, unless executors could not see it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        if folder.startswith(("file:", "/")) and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set, and the warehouse lies on this machine only")
    return folder.rstrip("/")


def kept(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder and read again, so that no later step repeats their work."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About `rows` rows at most, by a hash of `key`; all rows where there are no more.

    The same keys are taken wherever the table has the same number of rows.
    """
    n = df.count()
    if n <= rows:
        return df
    share = max(1, int(rows / n * (1 << 30)))
    return df.where(F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("sample")), F.lit(1 << 30)) < share)


def by_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return run
