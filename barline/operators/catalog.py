"""What the candle table holds: intervals, coverage, symbols."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.functions.time import epoch_seconds
from barline.operators.series import with_assets
from barline.schemas import SERIES, check_interval, check_symbol


def symbols_intervals(df: DataFrame) -> DataFrame:
    """Every symbol with the sorted array of its intervals (binary order: 15m, 1M, 1d)."""
    return df.groupBy("symbol").agg(F.array_sort(F.collect_set("interval")).alias("intervals"))


def intervals_of(df: DataFrame, symbol: str) -> DataFrame:
    rows = df.where(F.col("symbol") == check_symbol(symbol))
    return rows.select("interval").distinct().orderBy("interval")


def coverage(df: DataFrame, symbols=None, interval: str | None = None, offset=0) -> DataFrame:
    """First time, last time and number of bars per series, with the symbol's two assets."""
    if symbols is not None:
        df = df.where(F.col("symbol").isin([check_symbol(s) for s in symbols]))
    if interval is not None:
        df = df.where(F.col("interval") == check_interval(interval))
    spans = df.groupBy(*SERIES).agg(
        F.min("open_time").alias("first_open"),
        F.max("open_time").alias("last_open"),
        F.count(F.lit(1)).alias("count"),
    )
    return with_assets(spans).select(
        *SERIES,
        "base_asset",
        "quote_asset",
        epoch_seconds("first_open", offset).alias("first_time"),
        epoch_seconds("last_open", offset).alias("last_time"),
        "count",
    )


def stored_coverage(stored: DataFrame, symbols=None, interval: str | None = None, offset=0) -> DataFrame:
    """The same from `candles.stored_series`, which reads no bars; both filters reach its partitions.

    Its rows also serve the other functions here, which need no more than a symbol and an interval.
    """
    if symbols is not None:
        stored = stored.where(F.col("symbol").isin([check_symbol(s) for s in symbols]))
    if interval is not None:
        stored = stored.where(F.col("interval") == check_interval(interval))
    times = [F.expr(f"{c} - {int(offset)}L as {c}") for c in ("first_time", "last_time")]
    return with_assets(stored).select(*SERIES, "base_asset", "quote_asset", *times, "count")


def distinct_symbols(df: DataFrame) -> DataFrame:
    return df.agg(F.count_distinct("symbol").alias("symbols"))
