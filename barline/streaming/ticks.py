"""Ticks to candles, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.functions.time import EPOCH, ORIGIN, bar_bounds, epoch_seconds, event_order, instant_micros, ntz_literal
from barline.schemas import CANDLE, INTERVAL_SECONDS, check_interval


def _bar_columns(order: str) -> list[Column]:
    return [
        F.expr(c)
        for c in (
            f"min_by(value, {order}) as open",
            "max(value) as high",
            "min(value) as low",
            f"max_by(value, {order}) as close",
            "sum(value) as volume",
            "count(1) as number_of_trades",
        )
    ]


def full_rows(bars: DataFrame) -> DataFrame:
    """Candle rows of bars with their `start` and `next`, in Unix seconds; a tick counts as half a taker's buy."""
    given = {
        "open_time": f"timestampadd(SECOND, start, {EPOCH})",
        "close_time": f"timestampadd(MILLISECOND, (next - start) * 1000 - 1, timestampadd(SECOND, start, {EPOCH}))",
        "quote_asset_volume": "volume",
        "taker_buy_base_volume": "volume / 2",
        "taker_buy_quote_volume": "volume / 2",
    }
    return bars.selectExpr(*[f"cast({given.get(f.name, f.name)} as {f.dataType.simpleString()}) as {f.name}" for f in CANDLE.fields])


def candles_from_ticks(ticks: DataFrame, intervals: list[str]) -> DataFrame:
    """Candles of (symbol, ts, seq, value) ticks at one or more intervals, calendar weeks and months included.

    Ticks become one row per interval ahead of a single aggregation, which combines before its
    shuffle, so a busy symbol costs no more than its number of bars per task.
    """
    bounds = {check_interval(i): bar_bounds(i, "epoch") for i in intervals}
    bars = ", ".join(f"named_struct('interval', '{i}', 'start', {b}, 'next', {n})" for i, (b, n) in bounds.items())
    rows = ticks.select("symbol", "seq", "value", instant_micros(ticks, "ts").alias("micros"))
    rows = rows.select("symbol", "value", F.expr("floor(micros / 1000000) as epoch"), event_order("micros", "seq").alias("order"))
    rows = rows.selectExpr("symbol", "value", "order", f"inline(array({bars}))")
    return full_rows(rows.groupBy("symbol", "interval", "start", "next").agg(*_bar_columns("order")))


def stream_candles(ticks: DataFrame, interval: str = "1h", watermark: str = "1 hour") -> DataFrame:
    """Streaming candles of (symbol, ts, seq, value) ticks; a bar is final once the watermark passes it.

    Ticks seen twice within the watermark count once. `ts` may be zone-less, which means UTC. Ticks
    behind the watermark vanish, and a calendar month has no fixed length: `bars.stream_parts` has months
    and returns late ticks. When a bounded run has ended, `open_candles` gives the bars that were not closed yet.
    """
    if check_interval(interval) == "1M":
        raise ValueError("a window has a fixed length; stream_parts has months")
    rows = (
        ticks.withColumn("micros", instant_micros(ticks, "ts"))
        .withColumn("ts", F.timestamp_micros("micros"))
        .withWatermark("ts", watermark)
        .dropDuplicatesWithinWatermark(["symbol", "seq"])
        .withColumn("order", event_order("micros", "seq"))
    )
    width = f"{INTERVAL_SECONDS[interval]} seconds"
    window = F.window("ts", width, width, f"{ORIGIN.get(interval, 0)} seconds")
    bars = rows.groupBy("symbol", window).agg(*_bar_columns("order"))
    start, end = (F.unix_seconds(f"window.{side}") for side in ("start", "end"))
    return full_rows(bars.withColumns({"start": start, "next": end, "interval": F.lit(interval)}))


def open_candles(ticks: DataFrame, closed: DataFrame, intervals: str | list[str] = "1h") -> DataFrame:
    """Bars that a bounded stream over `ticks` left open: those past the last bar of their interval that it closed.

    The watermark is one for all symbols, so every bar up to the latest closed one is closed.
    """
    intervals = [intervals] if isinstance(intervals, str) else list(intervals)
    last = closed.groupBy("interval").agg(F.max(epoch_seconds("open_time")).alias("last"))
    last = {r["interval"]: r["last"] for r in last.where(F.col("interval").isin(intervals)).collect()}
    if len(last) == len(intervals):
        epoch = F.floor(instant_micros(ticks, "ts") / 1000000)
        later = " or ".join(f"{bar_bounds(i, '_epoch')[0]} > {last[i]}" for i in intervals)
        ticks = ticks.withColumn("_epoch", epoch).where(later).drop("_epoch")
    bars = candles_from_ticks(ticks.dropDuplicates(["symbol", "seq"]), intervals)
    for i, second in last.items():
        bars = bars.where((F.col("interval") != i) | (F.col("open_time") > ntz_literal(second)))
    return bars
