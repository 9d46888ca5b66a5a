"""Moving averages and trading signals over many series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barline.functions.time import epoch_seconds
from barline.operators.chunks import CHUNK_BARS, bar_counts, first_n, over_chunks, with_chunk
from barline.operators.frames import along, with_moving_means, with_top_before
from barline.schemas import DEFAULT_LENGTH, SERIES, check_length, check_limit

# The look of the two markers.
BUY_MARK = {"position": "belowBar", "color": "#0f8b8d", "shape": "arrowUp", "text": "Long"}
EXIT_MARK = {"position": "aboveBar", "color": "#c2410c", "shape": "arrowDown", "text": "Exit"}

# Default parameters of the two strategies.
FAST_LENGTH = 20
SLOW_LENGTH = 50
BREAKOUT_LOOKBACK = 30
ATR_LENGTH = 14


def sma(
    df: DataFrame, length: int = DEFAULT_LENGTH, limit: int | None = None, chunk_bars: int = CHUNK_BARS
) -> DataFrame:
    """Simple moving average of the close, from the first bar with a full window on.

    With `limit`, only the earliest bars of every series are taken.
    """
    check_length(length)
    bars = df.select(*SERIES, "open_time", "close")
    if check_limit(limit) is not None:
        bars = first_n(bars, limit, chunk_bars=chunk_bars)

    def steps(bars, w):
        return with_moving_means(bars, {"value": ("close", length)})

    full = over_chunks(bars, length - 1, steps, chunk_bars=chunk_bars).where(F.col("value").isNotNull())
    return full.select(*SERIES, epoch_seconds("open_time").alias("time"), "value")


def signals_thirds(df: DataFrame, limit: int | None = None, chunk_bars: int = CHUNK_BARS) -> DataFrame:
    """Placeholder markers of every series with at least two bars: Long after a third, Exit after two.

    The places follow from the series' length alone, so only the chunks that hold them are read
    a second time. With `limit`, the length counts the earliest bars only.
    """
    rows = with_chunk(df.select(*SERIES, "open_time"), chunk_bars)
    n = F.col("before") + F.col("here") + F.col("after")
    n = n if check_limit(limit) is None else F.least(n, F.lit(limit).cast("bigint"))
    buy = F.floor(n / 3).cast("bigint")
    exit_ = F.least(F.greatest(buy + 1, F.floor(n * 2 / 3).cast("bigint")), n - 1)
    places = bar_counts(rows).where(n >= 2)
    places = places.select(*SERIES, "chunk", "here", "before", buy.alias("buy_at"), exit_.alias("exit_at"))
    inside = [F.col(c).between(F.col("before"), F.col("before") + F.col("here") - 1) for c in ("buy_at", "exit_at")]
    places = places.where(inside[0] | inside[1]).drop("here")

    w = W.partitionBy(*SERIES, "chunk").orderBy("open_time")
    rows = rows.join(places, [*SERIES, "chunk"])
    rows = rows.withColumn("place", F.col("before") + F.row_number().over(w) - 1)
    is_buy, is_exit = F.col("place") == F.col("buy_at"), F.col("place") == F.col("exit_at")
    marks = rows.where(is_buy | is_exit)
    return marks.select(
        *SERIES,
        epoch_seconds("open_time").alias("time"),
        *[F.when(is_buy, BUY_MARK[k]).otherwise(EXIT_MARK[k]).alias(k) for k in BUY_MARK],
    )


def signal_listing(markers: DataFrame) -> DataFrame:
    """Side, text and day of every marker."""
    return markers.select(
        *SERIES,
        F.when(F.col("shape") == "arrowUp", "Buy").otherwise("Sell").alias("side"),
        F.coalesce("text", F.lit("Signal")).alias("text"),
        F.date_format(F.date_from_unix_date(F.floor(F.col("time") / 86400).cast("int")), "yyyy-MM-dd").alias("day"),
    )


def ma_cross_bars(df: DataFrame, fast=FAST_LENGTH, slow=SLOW_LENGTH, chunk_bars: int = CHUNK_BARS) -> DataFrame:
    """Every bar with its two averages, the close before it and its signal (buy, exit or NULL).

    A buy is a bar whose fast average is above the slow one after not being above it on the
    bar before; an exit is the reverse. All four averages must be full. (block, place) is a bar's place in
    its chunk, in the order in which the rows lie.
    """
    check_length(fast)
    check_length(slow)

    def steps(bars, w):
        bars = with_moving_means(bars, {"fast": ("close", fast), "slow": ("close", slow)})
        w = along()
        bars = bars.withColumns(
            {"f0": F.lag("fast").over(w), "s0": F.lag("slow").over(w), "previous": F.lag("close").over(w)}
        )
        buy = (F.col("fast") > F.col("slow")) & (F.col("f0") <= F.col("s0"))
        exit_ = (F.col("fast") < F.col("slow")) & (F.col("f0") >= F.col("s0"))
        return bars.withColumn("signal", F.when(buy, "buy").when(exit_, "exit")).drop("f0", "s0").withColumn("place", F.col("pos"))

    bars = df.select(*SERIES, "open_time", "close")
    return over_chunks(bars, max(fast, slow), steps, chunk_bars=chunk_bars)


def ma_cross(df: DataFrame, fast=FAST_LENGTH, slow=SLOW_LENGTH, chunk_bars: int = CHUNK_BARS) -> DataFrame:
    bars = ma_cross_bars(df, fast, slow, chunk_bars).where(F.col("signal").isNotNull())
    return bars.select(*SERIES, epoch_seconds("open_time").alias("time"), "signal", "close")


def breakout(
    df: DataFrame, lookback=BREAKOUT_LOOKBACK, atr_length=ATR_LENGTH, chunk_bars: int = CHUNK_BARS
) -> DataFrame:
    """Bars that close above the highest high of the `lookback` bars before them, by a rise of
    more than the average true range of the last `atr_length` bars."""
    check_length(lookback)
    check_length(atr_length)

    def steps(bars, w):
        bars = bars.withColumn("previous", F.lag("close").over(w))
        span = F.greatest(
            F.col("high") - F.col("low"),
            F.abs(F.col("high") - F.col("previous")),
            F.abs(F.col("low") - F.col("previous")),
        )
        bars = bars.withColumn("true_range", F.when(F.col("previous").isNotNull(), span))
        bars = with_top_before(bars, "top", "high", lookback)
        bars = with_moving_means(bars, {"mean_range": ("true_range", atr_length)})
        full = (F.col("pos") > lookback) & (F.col("pos") > atr_length)
        return bars.withColumn("atr", F.when(full, F.col("mean_range"))).drop("mean_range")

    bars = df.select(*SERIES, "open_time", "high", "low", "close")
    bars = over_chunks(bars, max(lookback, atr_length), steps, chunk_bars=chunk_bars)
    hit = (F.col("close") > F.col("top")) & (F.col("close") - F.col("previous") > F.col("atr"))
    return bars.where(hit).select(*SERIES, epoch_seconds("open_time").alias("time"), "close", "top", "atr")
