"""Slices of candle series: ranges, limits, latest bars, served columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.functions.text import split_symbol
from barline.functions.time import epoch_seconds, ntz_literal
from barline.operators.chunks import CHUNK_BARS, first_n
from barline.schemas import (
    ORDERS,
    SERIES,
    SERVED,
    check_choice,
    check_interval,
    check_limit,
    check_range,
    check_symbol,
)


def one_series(df: DataFrame, symbol: str, interval: str) -> DataFrame:
    return df.where(
        (F.col("symbol") == check_symbol(symbol)) & (F.col("interval") == check_interval(interval))
    )


def time_range(df: DataFrame, from_=None, to=None, offset=0, column="open_time") -> DataFrame:
    """Bars with from_ <= time < to, in Unix seconds, each bound optional.

    The bounds become timestamps, not the column a number, so the filter reaches the scan.
    """
    if from_ is not None:
        df = df.where(F.col(column) >= ntz_literal(from_ + offset))
    if to is not None:
        df = df.where(F.col(column) < ntz_literal(to + offset))
    return df


def served_candle(df: DataFrame, offset=0) -> DataFrame:
    """The ten served columns, time in Unix seconds."""
    values = [F.col(c).cast("bigint" if c == "number_of_trades" else "double") for c in SERVED[1:]]
    return df.select(epoch_seconds("open_time", offset).alias("time"), *values)


def select_fields(df: DataFrame, fields: str | None) -> DataFrame:
    """Subset of the served columns by a comma list, in declared order."""
    wanted = [f.strip() for f in fields.split(",")] if fields else []
    unknown = [f for f in wanted if f not in SERVED]
    if unknown:
        raise ValueError(f"unknown candle fields: {', '.join(unknown)}")
    return df.select(*[c for c in SERVED if not wanted or c in wanted])


def ordered(df: DataFrame, order: str, limit: int | None = None, column="open_time") -> DataFrame:
    check_choice("order", order, ORDERS)
    rows = df.orderBy(F.asc(column) if order == "asc" else F.desc(column))
    return rows if check_limit(limit) is None else rows.limit(limit)


def series(
    df: DataFrame,
    symbol: str,
    interval: str,
    from_=None,
    to=None,
    limit: int | None = None,
    order: str = "asc",
    fields: str | None = None,
    offset=0,
) -> DataFrame:
    """Served candles of one series in a time range, in order; all of them unless a limit is given."""
    check_range(from_, to)
    rows = time_range(one_series(df, symbol, interval), from_, to, offset)
    return select_fields(served_candle(ordered(rows, order, limit), offset), fields)


def multi_series(df: DataFrame, symbols: list[str], interval: str, from_=None, to=None) -> DataFrame:
    """Bars of several symbols at one interval in a time range."""
    check_range(from_, to)
    names = [check_symbol(s) for s in symbols]
    rows = df.where(F.col("symbol").isin(names) & (F.col("interval") == check_interval(interval)))
    return time_range(rows, from_, to)


def page_after(
    df: DataFrame, symbol: str, interval: str, limit: int, after: int | None = None, order="asc"
) -> DataFrame:
    """The next page of `limit` bars of one series: those past the last time of the page before."""
    check_choice("order", order, ORDERS)
    rows = one_series(df, symbol, interval)
    if after is not None:
        last = ntz_literal(after)
        rows = rows.where(F.col("open_time") > last if order == "asc" else F.col("open_time") < last)
    return served_candle(ordered(rows, order, limit))


def lookback(
    df: DataFrame, days: int | None, as_of: int, limit: int | None = None, chunk_bars: int = CHUNK_BARS
) -> DataFrame:
    """Every series' bars in the last `days` days before `as_of` (Unix seconds); None: all before it.

    With `limit`, the earliest bars of the range are kept per series.
    """
    rows = time_range(df, None if days is None else as_of - days * 86400, as_of)
    return rows if check_limit(limit) is None else first_n(rows, limit, chunk_bars=chunk_bars)


def series_exists(df: DataFrame, symbol: str, interval: str) -> DataFrame:
    """One row if the series has a bar, none otherwise."""
    return one_series(df, symbol, interval).select(*SERIES).limit(1)


def existing_series(requested: DataFrame, df: DataFrame) -> DataFrame:
    """Requested (symbol, interval) rows with a flag that says whether the series has a bar."""
    known = df.select(*SERIES).distinct().withColumn("found", F.lit(True))
    return requested.join(known, SERIES, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def latest(df: DataFrame) -> DataFrame:
    """The latest bar of every series."""
    rest = [c for c in df.columns if c not in SERIES]
    return df.groupBy(*SERIES).agg(*[F.max_by(c, "open_time").alias(c) for c in rest])


def direction(df: DataFrame) -> DataFrame:
    """Adds `direction`: up if the bar closed at or above its open, else down."""
    return df.withColumn("direction", F.when(F.col("close") >= F.col("open"), "up").otherwise("down"))


def change_pct() -> Column:
    """Change of a bar from open to close in percent; NULL if the open is 0."""
    return F.try_divide(F.col("close") - F.col("open"), F.col("open")) * 100


def session_change(df: DataFrame) -> DataFrame:
    """Change from open to close of every series' latest bar in percent; NULL if the open is 0."""
    return latest(df.select(*SERIES, "open_time", "open", "close")).withColumn("change_pct", change_pct())


def with_assets(df: DataFrame) -> DataFrame:
    base, quote = split_symbol("symbol")
    return df.withColumns({"base_asset": base, "quote_asset": quote})
