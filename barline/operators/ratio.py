"""Ratio candles: one series divided by another, bar by bar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.functions.time import epoch_seconds
from barline.operators.series import one_series, ordered, time_range
from barline.schemas import check_interval, check_legs, check_range

PAIR = ["base_symbol", "quote_symbol", "interval"]
SLOTS = 32


def ratio_columns() -> list[Column]:
    """Ratio open, high, low, close and the two closes from the columns of both legs.

    High and low come from the ratio's own open and close: the legs' extremes need not fall
    on the same moment, so wicks made of them would be fiction.
    """
    open_ = F.col("base_open") / F.col("quote_open")
    close = F.col("base_close") / F.col("quote_close")
    return [
        open_.alias("open"),
        F.greatest(open_, close).alias("high"),
        F.least(open_, close).alias("low"),
        close.alias("close"),
        F.col("base_close"),
        F.col("quote_close"),
    ]


def _leg(df: DataFrame, side: str) -> DataFrame:
    return df.select(
        F.col("symbol").alias(f"{side}_symbol"),
        "interval",
        "open_time",
        F.col("open").alias(f"{side}_open"),
        F.col("close").alias(f"{side}_close"),
    )


def _quote_leg(df: DataFrame) -> DataFrame:
    # Division by zero is an error in ANSI mode, so bars with a zero go first.
    return _leg(df, "quote").where((F.col("quote_open") != 0) & (F.col("quote_close") != 0))


def ratio(
    df: DataFrame,
    base: str,
    quote: str,
    interval: str,
    from_=None,
    to=None,
    limit: int | None = None,
    order: str = "asc",
    offset=0,
) -> DataFrame:
    """Ratio candles of one pair, all of them unless a limit is given; bars found on one leg only are left out."""
    check_range(from_, to)
    base, quote = check_legs(base, quote)
    rows = time_range(df.where(F.col("interval") == check_interval(interval)), from_, to, offset)
    b = _leg(one_series(rows, base, interval), "base")
    q = _quote_leg(one_series(rows, quote, interval))
    pairs = b.join(q, ["interval", "open_time"]).select("open_time", *ratio_columns())
    return ordered(pairs, order, limit).select(
        epoch_seconds("open_time", offset).alias("time"), "open", "high", "low", "close", "base_close", "quote_close"
    )


def ratios(df: DataFrame, pairs: DataFrame, from_=None, to=None, placed: bool = False) -> DataFrame:
    """Ratio candles of every (base_symbol, quote_symbol) row of `pairs`, at every interval.

    The bars of the symbols in use are shuffled once, by interval and time; not at all with `placed`, which says that
    `df` is a table bucketed so (`candles.save_bucketed`). The quotes of a moment lie in SLOTS short lists by a hash of
    their symbol, pairs are attached to the base bars after that shuffle, and both sides meet on the
    partitioning they already have: what is shuffled grows with the bars and not with the pairs, and no task
    holds more of a symbol than its share of the times. A bar that occurs twice counts twice, as in `ratio`. (A pair
    list above Spark's size limit for broadcasts is matched by a shuffle of its own.)
    """
    check_range(from_, to)
    wanted = pairs.select("base_symbol", "quote_symbol").distinct().where("base_symbol <> quote_symbol")
    symbols = wanted.select(F.explode(F.array("base_symbol", "quote_symbol")).alias("symbol")).distinct()
    bars = time_range(df.select("symbol", "interval", "open_time", "open", "close"), from_, to)
    bars = bars.join(symbols, "symbol", "left_semi")
    if not placed:
        bars = bars.repartition("interval", "open_time")
    quotes = _quote_leg(bars).groupBy("interval", "open_time")
    quotes = quotes.agg(F.collect_list(F.struct("quote_symbol", "quote_open", "quote_close", _slot("quote_symbol").alias("slot"))).alias("all"))
    quotes = quotes.select("interval", "open_time", F.expr(f"transform(sequence(0, {SLOTS - 1}), s -> filter(all, q -> q.slot = s)) as quotes"))
    base = _leg(bars, "base").join(wanted.withColumnRenamed("quote_symbol", "other").withColumn("slot", _slot("other")), "base_symbol")
    both = base.join(quotes, ["interval", "open_time"])
    both = both.select("base_symbol", "interval", "open_time", "base_open", "base_close", F.expr("inline(filter(quotes[slot], q -> q.quote_symbol = other))"))
    return both.select(*PAIR, "open_time", *ratio_columns())


def _slot(symbol: str) -> Column:
    return F.expr(f"cast(pmod(xxhash64({symbol}), {SLOTS}) as int)")


def ratio_change(ratio_bars: DataFrame) -> DataFrame:
    """Change of every pair over the bars given, from the first open to the last close, in percent."""
    ends = ratio_bars.groupBy(*PAIR).agg(
        F.min_by("open", "open_time").alias("first_open"),
        F.max_by("close", "open_time").alias("last_close"),
        F.count(F.lit(1)).alias("bars"),
    )
    change = F.try_divide(F.col("last_close") - F.col("first_open"), F.col("first_open")) * 100
    return ends.withColumn("change_pct", change)


def ratio_lookback(df: DataFrame, base: str, quote: str, interval: str, days: int | None, as_of: int) -> DataFrame:
    """Ratio candles of one pair in the last `days` days before `as_of` (Unix seconds); None: all before it."""
    return ratio(df, base, quote, interval, None if days is None else as_of - days * 86400, as_of)
