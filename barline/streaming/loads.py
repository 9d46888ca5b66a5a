"""Incremental load of a landing folder into the candle table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from barline.sources.candles import append_candles
from barline.sources.klines import file_lines, parse_lines, to_candles, unzip, with_path_keys

COUNTS = "batch bigint, rows bigint, keys bigint, written bigint"
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """A query's folder below the cluster's shared checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("spark.checkpoint.dir is not set; pass checkpoint=")
    return f"{base.rstrip('/')}/{name}"


def stream_load(
    spark: SparkSession,
    source: str,
    root: str,
    checkpoint: str | None = None,
    strict: bool = True,
    keys: Callable[[DataFrame], DataFrame] | None = None,
    zipped: bool = False,
    max_files: int | None = None,
    max_bytes: str | None = None,
    archive: str | None = None,
    counts: str | None = None,
) -> StreamingQuery:
    """Loads the files that are new since the last run, each candle once, and stops.

    Files are plain CSV, or with `zipped` archives of it. The file source remembers files it has
    read. A backlog is loaded in batches of at most `max_files` files or `max_bytes` (such as "10g"), the oldest files first;
    without a limit it is one batch. Files that are done with move below `archive`, if given. A batch that is run again
    after a failure adds nothing twice, since stored keys are ignored. With strict=False, damaged lines and rows with a
    missing or invalid column are left out instead of failing the batch. `keys` may rewrite the symbol and
    interval that were taken from the folder names. Each batch leaves a row with its number, rows, keys and written rows
    below `counts`, if given; a batch that is run again replaces its row.
    """
    if max_files is not None and max_bytes is not None:
        raise ValueError("give either max_files or max_bytes")
    limits = {"maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes}
    if archive is not None:
        limits |= {"cleanSource": "archive", "sourceArchiveDir": archive}
    files = spark.readStream.option("recursiveFileLookup", "true").options(**{k: v for k, v in limits.items() if v is not None})
    if zipped:
        rows = files.option("pathGlobFilter", "*.zip").format("binaryFile").schema(BINARY_FILE).load(source)
    else:
        rows = file_lines(files.option("pathGlobFilter", "*.csv").text(source))

    def load(batch: DataFrame, number: int) -> None:
        raw = with_path_keys(parse_lines(unzip(batch) if zipped else batch, strict))
        done = append_candles(to_candles(keys(raw) if keys else raw, keep=("path",)), root, ["path"], strict)
        if counts is not None:
            row = batch.sparkSession.createDataFrame([(number, *done.values())], COUNTS)
            row.coalesce(1).write.mode("overwrite").parquet(f"{counts.rstrip('/')}/run={number}")

    return (
        rows.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint or checkpoint_location(spark, "candle_load"))
        .trigger(availableNow=True)
        .start()
    )


def read_counts(spark: SparkSession, counts: str) -> DataFrame:
    """A row for each batch that has been loaded."""
    return spark.read.schema(COUNTS).parquet(f"{counts.rstrip('/')}/*")
