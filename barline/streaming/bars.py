"""Streamed bars of any intervals, calendar months included, with the ticks that came too late.

Ticks are keyed by symbol and slot, so a busy symbol is spread over `slots` keys. Each key keeps the bars that
are open as one small array in its state, and a timer at the end of the earliest of them; when the
watermark passes a timer, the bars behind it leave as parts, one a slot. A month's timer stands at
the end of that calendar month. `candles_from_parts` puts the parts of a bar together.

Spark discards rows behind the watermark where the operator still sees the column it was taken from.
Here that column ends before the operator, which gets every tick and sorts out by itself those whose
bar has closed: they leave at once as parts of the kind "late", each a bar of one tick. So nothing is lost without a
trace, and adding the late parts gives the bars as if all ticks had come in time.

Defined cases: a tick without a symbol, time, sequence or value is left out; a sequence seen again for a
symbol before the watermark is `delay` past it counts once, the earliest copy of a batch first; times are UTC.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from barline.functions.time import ORIGIN, event_order, instant_micros, ntz_from_micros, ntz_from_seconds
from barline.schemas import INTERVAL_SECONDS, INTERVALS, check_interval
from barline.streaming.ticks import full_rows

SLOTS = 16
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

PART = (
    "kind string, symbol string, interval string, start bigint, next bigint, open_micros bigint, open_seq bigint, open double, "
    "high double, low double, close_micros bigint, close_seq bigint, close double, volume double, number_of_trades bigint"
)
BAR = np.dtype(
    [("interval", "i8"), ("start", "i8"), ("next", "i8"), ("open_micros", "i8"), ("open_seq", "i8"), ("open", "f8"), ("high", "f8")]
    + [("low", "f8"), ("close_micros", "i8"), ("close_seq", "i8"), ("close", "f8"), ("volume", "f8"), ("number_of_trades", "i8")]
)
SEEN = np.dtype([("seq", "i8"), ("micros", "i8")])


def bounds(interval: str, seconds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unix seconds of the start of the bars that hold some moments, and of the next bars' start."""
    if interval == "1M":
        month = seconds.astype("datetime64[s]").astype("datetime64[M]")
        return tuple(m.astype("datetime64[s]").astype(np.int64) for m in (month, month + 1))
    width = INTERVAL_SECONDS[interval]
    start = seconds - (seconds - ORIGIN.get(interval, 0)) % width
    return start, start + width


def single_bars(intervals: list[str], micros: np.ndarray, seq: np.ndarray, value: np.ndarray) -> np.ndarray:
    """A bar of one tick for every tick and interval; `interval` is its place in the list."""
    out = np.empty((len(intervals), len(micros)), BAR)
    out["open_micros"] = out["close_micros"] = micros
    out["open_seq"] = out["close_seq"] = seq
    for c in ("open", "high", "low", "close", "volume"):
        out[c] = value
    out["number_of_trades"] = 1
    seconds = micros // 1_000_000
    for k, interval in enumerate(intervals):
        out["interval"][k] = k
        out["start"][k], out["next"][k] = bounds(interval, seconds)
    return out.reshape(-1)


def merged(bars: np.ndarray) -> np.ndarray:
    """One bar for each interval and start."""
    if len(bars) < 2:
        return bars
    first = bars[np.lexsort((bars["open_seq"], bars["open_micros"], bars["start"], bars["interval"]))]
    last = bars[np.lexsort((bars["close_seq"], bars["close_micros"], bars["start"], bars["interval"]))]
    new = (first["interval"][1:] != first["interval"][:-1]) | (first["start"][1:] != first["start"][:-1])
    cut = np.flatnonzero(np.concatenate([[True], new]))
    out, ends = first[cut].copy(), np.append(cut[1:], len(bars)) - 1
    for c in ("close_micros", "close_seq", "close"):
        out[c] = last[c][ends]
    for c, put in (("high", np.maximum), ("low", np.minimum), ("volume", np.add), ("number_of_trades", np.add)):
        out[c] = put.reduceat(first[c], cut)
    return out


class OpenBars(StatefulProcessor):
    """The open bars and the sequences seen lately of one symbol and slot."""

    def __init__(self, intervals: list[str], delay_ms: int):
        self.intervals, self.delay_ms = intervals, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open, self.seen = handle.getValueState("open", "bars binary"), handle.getValueState("seen", "ids binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        bars, seen = self._read(self.open, BAR), self._read(self.seen, SEEN)
        for ticks in rows:
            micros, seq, value = (ticks[c].to_numpy() for c in ("micros", "seq", "value"))
            order = np.argsort(micros, kind="stable")
            fresh = order[np.sort(np.unique(seq[order], return_index=True)[1])]
            fresh = fresh[~np.isin(seq[fresh], seen["seq"])]
            known = np.empty(len(fresh), SEEN)
            known["seq"], known["micros"] = seq[fresh], micros[fresh]
            seen = np.concatenate([seen, known])
            new = single_bars(self.intervals, micros[fresh], seq[fresh], value[fresh])
            late = new["next"] * 1000 <= watermark
            if late.any():
                yield self._frame("late", key, new[late])
            bars = merged(np.concatenate([bars, new[~late]]))
        self._write(self.seen, seen[seen["micros"] // 1000 + self.delay_ms > watermark])
        self._keep(bars)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        bars = self._read(self.open, BAR)
        closed = bars["next"] * 1000 <= timerValues.getCurrentWatermarkInMs()
        if closed.any():
            yield self._frame("bar", key, bars[closed])
            self._keep(bars[~closed])

    def close(self) -> None:
        pass

    def _keep(self, bars: np.ndarray) -> None:
        self._write(self.open, bars)
        if len(bars):
            self.handle.registerTimer(int(bars["next"].min()) * 1000)

    @staticmethod
    def _read(state, dtype: np.dtype) -> np.ndarray:
        value = state.get()
        return np.frombuffer(value[0], dtype) if value else np.empty(0, dtype)

    @staticmethod
    def _write(state, values: np.ndarray) -> None:
        if len(values):
            state.update((values.tobytes(),))
        else:
            state.clear()

    def _frame(self, kind: str, key, bars: np.ndarray) -> pd.DataFrame:
        names = np.array(self.intervals, object)[bars["interval"]]
        lead = {"kind": kind, "symbol": key[0], "interval": names}
        return pd.DataFrame(lead | {c: bars[c].copy() for c in BAR.names[1:]})


def stream_parts(ticks: DataFrame, intervals: list[str] = INTERVALS, delay_seconds: int = 3600, slots: int = SLOTS) -> DataFrame:
    """Parts of closed bars, and late ticks, of a stream of (symbol, ts, seq, value) ticks.

    Needs a state store with timers, which `start_parts` sees to.
    """
    for interval in intervals:
        check_interval(interval)
    rows = ticks.select("symbol", F.col("seq").cast("bigint").alias("seq"), F.col("value").cast("double").alias("value"), instant_micros(ticks, "ts").alias("micros"))
    rows = rows.dropna().withColumn("ts", F.timestamp_micros("micros")).withWatermark("ts", f"{delay_seconds} seconds")
    slot = F.pmod(F.xxhash64("seq"), F.lit(slots)).cast("int").alias("slot")
    keyed = rows.select("symbol", slot, "seq", "value", "micros").groupBy("symbol", "slot")
    return keyed.transformWithStateInPandas(OpenBars(list(intervals), delay_seconds * 1000), PART, "append", "EventTime")


@contextmanager
def _timed_state(spark: SparkSession):
    """The session's state store has timers while a query starts, which keeps the settings it has started with."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def start_parts(ticks: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """Writes the parts of all ticks that are there now below `path`, and stops; a later run goes on from there."""
    with _timed_state(ticks.sparkSession):
        parts = stream_parts(ticks, **options).writeStream.format("parquet").option("path", path)
        return parts.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PART).parquet(path)


def candles_from_parts(parts: DataFrame, with_late: bool = False) -> DataFrame:
    """Candle rows of the closed bars, with or without the ticks that came after they had closed."""
    rows = parts if with_late else parts.where("kind = 'bar'")
    opened, closed = event_order("open_micros", "open_seq"), event_order("close_micros", "close_seq")
    bars = rows.groupBy("symbol", "interval", "start", "next").agg(
        F.min_by("open", opened).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", closed).alias("close"),
        F.sum("volume").alias("volume"),
        F.sum("number_of_trades").alias("number_of_trades"),
    )
    return full_rows(bars)


def late_ticks(parts: DataFrame) -> DataFrame:
    """(symbol, interval, open_time, ts, seq, value) of the ticks that came after their bar had closed."""
    late = parts.where("kind = 'late'")
    times = ntz_from_seconds("start").alias("open_time"), ntz_from_micros("open_micros").alias("ts")
    return late.select("symbol", "interval", *times, F.col("open_seq").alias("seq"), F.col("open").alias("value"))
