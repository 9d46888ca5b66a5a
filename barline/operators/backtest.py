"""Returns, equity curves, risk figures and trades of many series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barline.functions.time import epoch_seconds
from barline.operators.chunks import CHUNK_BARS, first_n, last_n, with_carried, with_chunk
from barline.operators.frames import BLOCK
from barline.operators.indicators import FAST_LENGTH, SLOW_LENGTH, ma_cross_bars
from barline.schemas import EQUITY_START, INTERVAL_SECONDS, SERIES, YEAR_SECONDS, check_limit


def total_return(df: DataFrame, limit: int | None = None, chunk_bars: int = CHUNK_BARS) -> DataFrame:
    """Return from the first to the last close in percent, for every series of at least two bars.

    With `limit`, over the earliest bars of every series. NULL if the first close is 0.
    """
    bars = df.select(*SERIES, "open_time", "close")
    if check_limit(limit) is not None:
        bars = first_n(bars, limit, chunk_bars=chunk_bars)
    ends = bars.groupBy(*SERIES).agg(
        F.min_by("close", "open_time").alias("first_close"),
        F.max_by("close", "open_time").alias("last_close"),
        F.count(F.lit(1)).alias("bars"),
    )
    change = F.try_divide(F.col("last_close") - F.col("first_close"), F.col("first_close")) * 100
    return (
        ends.where(F.col("bars") >= 2)
        .withColumn("total_return_pct", change)
        .withColumn("win_rate_pct", F.when(change >= 0, 100.0).when(change < 0, 0.0))
        .withColumn("trade_count", F.lit(1))
    )


def equity(
    df: DataFrame, last: int | None = None, start: float = EQUITY_START, chunk_bars: int = CHUNK_BARS
) -> DataFrame:
    """Value of `start` invested over every series, or over its latest `last` bars.

    The product of close-to-close changes telescopes: the value stays at `start` up to the
    first close that is not 0, follows the close from there, and is 0 for good after a close
    of 0. The first close that counts and the latest zero are carried from chunk to chunk.
    """
    bars = df.select(*SERIES, "open_time", "close")
    if check_limit(last) is not None:
        bars = last_n(bars, last, chunk_bars=chunk_bars)
    so_far = W.partitionBy(*SERIES, "chunk").orderBy("open_time").rowsBetween(W.unboundedPreceding, W.currentRow)
    counts_at = F.when(F.col("close") != 0, F.col("open_time"))
    zero_at = F.when(F.col("close") == 0, F.col("open_time"))
    bars = with_chunk(bars, chunk_bars).withColumns(
        {
            "begin_here": F.first(F.when(F.col("close") != 0, F.col("close")), ignorenulls=True).over(so_far),
            "begin_at_here": F.min(counts_at).over(so_far),
            "zero_here": F.max(zero_at).over(so_far),
        }
    )
    bars = with_carried(
        bars,
        SERIES,
        "chunk",
        {"first_close": F.min_by("close", counts_at), "first_at": F.min(counts_at), "last_zero": F.max(zero_at)},
        lambda past, _: {
            "begin_before": F.first("first_close", ignorenulls=True).over(past),
            "begin_at_before": F.min("first_at").over(past),
            "zero_before": F.max("last_zero").over(past),
        },
    )
    begin = F.coalesce("begin_before", "begin_here")
    lost = F.greatest("zero_before", "zero_here") > F.coalesce("begin_at_before", "begin_at_here")
    value = F.when(begin.isNull(), F.lit(start)).when(lost, 0.0).otherwise(F.lit(start) * F.col("close") / begin)
    return bars.select(*SERIES, "open_time", value.cast("double").alias("value"))


def equity_points(curve: DataFrame) -> DataFrame:
    return curve.select(*SERIES, epoch_seconds("open_time").alias("time"), "value")


def bars_a_year() -> Column:
    """How many bars of a series' interval a year has."""
    each = {i: 12.0 if i == "1M" else YEAR_SECONDS / n for i, n in INTERVAL_SECONDS.items()}
    pairs = [F.lit(x) for kv in each.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), F.col("interval"))


def risk(curve: DataFrame, periods: int | None = None, chunk_bars: int = CHUNK_BARS) -> DataFrame:
    """Deepest fall from a peak in percent, and the yearly Sharpe ratio of the bar returns, per series.

    `curve` has the series key, open_time and value. `periods` is the number of bars a year; by
    default that of the series' interval.
    """
    w = W.partitionBy(*SERIES, "chunk").orderBy("open_time")
    rows = with_chunk(curve.select(*SERIES, "open_time", "value"), chunk_bars)
    rows = rows.withColumns(
        {
            "top": F.max("value").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)),
            "previous": F.lag("value").over(w),
        }
    )
    rows = with_carried(
        rows,
        SERIES,
        "chunk",
        {"chunk_top": F.max("value"), "chunk_end": F.max_by("value", "open_time")},
        lambda past, _: {
            "top_before": F.max("chunk_top").over(past),
            "end_before": F.last("chunk_end").over(past),
        },
    )
    peak = F.greatest("top_before", "top")
    previous = F.coalesce("previous", "end_before")
    rows = rows.select(
        *SERIES,
        (F.try_divide(F.col("value"), peak) - 1).alias("fall"),
        (F.try_divide(F.col("value"), previous) - 1).alias("gain"),
    )
    figures = rows.groupBy(*SERIES).agg(
        F.min("fall").alias("fall"),
        F.avg("gain").alias("mean"),
        F.stddev_samp("gain").alias("spread"),
        F.count(F.lit(1)).alias("bars"),
    )
    return figures.select(
        *SERIES,
        "bars",
        (F.col("fall") * 100).alias("max_drawdown_pct"),
        (F.try_divide(F.col("mean"), F.col("spread")) * F.sqrt(F.lit(periods) if periods else bars_a_year())).alias("sharpe"),
    )


def _held_chunks(df, fast, slow, chunk_bars) -> tuple[DataFrame, dict]:
    """Bars of the moving-average strategy by chunk, and what to carry between the chunks.

    `now` and `before` say whether the strategy holds the series at the end of a bar and of the
    bar before it. They are NULL ahead of the chunk's first signal, where the last signal of
    the chunks before decides; `last_signal` is the part of a summary that tells.
    """

    def held(end):
        signal = F.last("signal", ignorenulls=True).over(_chunk().rowsBetween(W.unboundedPreceding, end))
        return signal == "buy"

    bars = ma_cross_bars(df, fast, slow, chunk_bars).withColumns({"now": held(W.currentRow), "before": held(-1)})
    signal_at = F.when(F.col("signal").isNotNull(), F.col("open_time"))
    return bars, {"last_signal": F.max_by("signal", signal_at)}


def _chunk(backward=False):
    """A chunk's bars in the order in which the averages have left them."""
    return W.partitionBy(*SERIES, "chunk").orderBy(*[F.desc(c) if backward else F.asc(c) for c in (BLOCK, "place")])


def _held_at_start(past, _):
    last = F.last("last_signal", ignorenulls=True).over(past)
    return {"start": F.coalesce(last == "buy", F.lit(False))}


def _kept_share(fee_bps, slippage_bps) -> float:
    """What an entry or exit leaves of the value."""
    return 1 - (fee_bps + slippage_bps) / 1e4


def _factor(start: bool, keep: float) -> Column:
    """What a bar multiplies the value by, if the chunk starts held or not."""
    now, before = F.coalesce("now", F.lit(start)), F.coalesce("before", F.lit(start))
    change = F.when(before, F.try_divide(F.col("close"), F.col("previous")))
    return F.coalesce(change, F.lit(1.0)) * F.when(now != before, F.lit(keep)).otherwise(F.lit(1.0))


def net_equity(
    df: DataFrame,
    fast=FAST_LENGTH,
    slow=SLOW_LENGTH,
    capital: float = EQUITY_START,
    fee_bps: float = 0.0,
    slippage_bps: float = 0.0,
    chunk_bars: int = CHUNK_BARS,
) -> DataFrame:
    """Equity of the moving-average strategy after costs, and whether a bar is held at its end.

    A bar held from the bar before multiplies the value by its close-to-close change, and every
    entry or exit multiplies it by 1 - (fee + slippage) / 10000. A chunk's growth is known for
    both states it can start in, so one pass carries the state and the growth together.
    """
    keep = _kept_share(fee_bps, slippage_bps)

    def chosen(if_held, if_out):
        return F.when(F.col("start"), F.col(if_held)).otherwise(F.col(if_out))

    so_far = _chunk().rowsBetween(W.unboundedPreceding, W.currentRow)
    bars, last_signal = _held_chunks(df, fast, slow, chunk_bars)
    bars = bars.withColumns({"if_held": _factor(True, keep), "if_out": _factor(False, keep)})
    bars = bars.withColumns({f"so_far_{c}": F.product(c).over(so_far) for c in ("if_held", "if_out")})
    bars = with_carried(
        bars,
        SERIES,
        "chunk",
        last_signal | {f"chunk_{c}": F.product(c) for c in ("if_held", "if_out")},
        _held_at_start,
        lambda past, _: {"growth": F.product(chosen("chunk_if_held", "chunk_if_out")).over(past)},
    )
    value = F.lit(capital) * F.coalesce("growth", F.lit(1.0)) * chosen("so_far_if_held", "so_far_if_out")
    held = F.coalesce("now", "start").cast("int")
    return bars.select(*SERIES, "open_time", value.alias("value"), held.alias("held"))


def trades(
    df: DataFrame, fast=FAST_LENGTH, slow=SLOW_LENGTH, quantity: float = 1.0, chunk_bars: int = CHUNK_BARS
) -> DataFrame:
    """Entries of the moving-average strategy with the exit that follows, open trades with NULL.

    An entry's exit is the next exit signal: in its own chunk, or the first one of the chunks
    after it. Both are looked up from the end backwards, one step per signal.
    """
    is_exit = F.col("signal") == "exit"
    exit_ = F.when(is_exit, F.struct("open_time", "close"))
    later = _chunk(backward=True).rowsBetween(W.unboundedPreceding, W.currentRow - 1)
    bars, last_signal = _held_chunks(df, fast, slow, chunk_bars)
    signals = bars.where(F.col("signal").isNotNull()).select(
        *SERIES, "chunk", "open_time", "close", "signal", "before", F.last(exit_, ignorenulls=True).over(later).alias("done")
    )
    signals = with_carried(
        signals,
        SERIES,
        "chunk",
        last_signal | {"first_exit": F.min(exit_)},
        _held_at_start,
        lambda _, later: {"exit_after": F.last("first_exit", ignorenulls=True).over(later)},
    )
    entries = signals.where((F.col("signal") == "buy") & ~F.coalesce("before", "start"))
    entries = entries.withColumn("done", F.coalesce("done", "exit_after"))
    return entries.select(
        *SERIES,
        F.lit("buy").alias("side"),
        F.lit(quantity).alias("quantity"),
        epoch_seconds("open_time").alias("entry_time"),
        F.col("close").alias("entry_price"),
        epoch_seconds("done.open_time").alias("exit_time"),
        F.col("done.close").alias("exit_price"),
        (F.lit(quantity) * (F.col("done.close") - F.col("close"))).alias("pnl"),
    )


def _chunk_figures(df, fast, slow, keep, chunk_bars) -> DataFrame:
    """One row per (series, chunk) with all that `metrics` needs of it, for both states it may start in.

    Values are relative to the value the chunk starts with. Ahead of the chunk's first signal the state is
    that of the start; so the first signal opens a trade only from outside and the first exit may close a trade
    of an earlier chunk, while all later entries and exits are the same for both.
    """
    bars, last_signal = _held_chunks(df, fast, slow, chunk_bars)
    so_far = _chunk().rowsBetween(W.unboundedPreceding, W.currentRow)
    for s, start in (("in", True), ("out", False)):
        bars = bars.withColumn(f"factor_{s}", _factor(start, keep))
        bars = bars.withColumn(f"value_{s}", F.product(f"factor_{s}").over(so_far))
        bars = bars.withColumns({f"top_{s}": F.max(f"value_{s}").over(so_far), f"value_before_{s}": F.lag(f"value_{s}").over(_chunk())})
    buy, exit_ = F.col("signal") == "buy", F.col("signal") == "exit"
    entry = buy & ~F.col("before")
    bars = bars.withColumns(
        {
            "entry_price": F.last(F.when(entry, F.col("close")), ignorenulls=True).over(so_far),
            "exits": F.count(F.when(exit_, 1)).over(so_far),
        }
    )
    opens = F.col("signal").isNotNull() & F.col("before").isNull()
    closing = exit_ & F.col("before") & (F.col("exits") > 1)
    figures = last_signal | {
        "n": F.count(F.lit(1)),
        "first_signal": F.max(F.when(opens, F.col("signal"))),
        "first_price": F.max(F.when(opens, F.col("close"))),
        "first_exit": F.max(F.when(exit_ & (F.col("exits") == 1), F.col("close"))),
        "entries": F.count_if(entry),
        "last_entry": F.max_by("close", F.when(entry, F.col("open_time"))),
        "closings": F.count_if(closing),
        "wins": F.count_if(closing & (F.col("close") > F.col("entry_price"))),
    }
    for s in ("in", "out"):
        factor, value, before = F.col(f"factor_{s}"), F.col(f"value_{s}"), F.col(f"value_before_{s}")
        gain = F.when(F.col("previous").isNotNull() & (F.coalesce(before, F.lit(1.0)) != 0), factor - 1)
        figures |= {
            f"growth_{s}": F.product(factor),
            f"top_{s}": F.max(value),
            f"low_{s}": F.min(value),
            f"fall_{s}": F.min(F.try_divide(value, F.col(f"top_{s}"))),
            f"gains_{s}": F.count(gain),
            f"mean_{s}": F.avg(gain),
            f"squares_{s}": F.var_pop(gain) * F.count(gain),
        }
    return bars.groupBy(*SERIES, "chunk").agg(*[c.alias(name) for name, c in figures.items()])


def metrics(
    df: DataFrame,
    fast=FAST_LENGTH,
    slow=SLOW_LENGTH,
    capital: float = EQUITY_START,
    fee_bps: float = 0.0,
    slippage_bps: float = 0.0,
    chunk_bars: int = CHUNK_BARS,
) -> DataFrame:
    """One row per series: the moving-average strategy's return, risk and trades over all its bars.

    The bars are read once: each chunk becomes one row, and these rows are folded. Of a fall, a chunk
    knows the deepest from a peak of its own and its lowest value, which meets the highest peak before it; gains
    are merged by their counts, means and squared deviations. The win rate counts closed trades only and is NULL
    without one; the Sharpe ratio is NULL while the value never changes.
    """
    rows = _chunk_figures(df, fast, slow, _kept_share(fee_bps, slippage_bps), chunk_bars)
    series = W.partitionBy(*SERIES)
    past = series.orderBy("chunk").rowsBetween(W.unboundedPreceding, W.currentRow - 1)
    rows = rows.withColumns(_held_at_start(past, None))
    for c in ("growth", "top", "low", "fall", "gains", "mean", "squares"):
        rows = rows.withColumn(c, F.when(F.col("start"), F.col(f"{c}_in")).otherwise(F.col(f"{c}_out")))
    opened = (F.col("first_signal") == "buy") & ~F.col("start")
    opened = F.coalesce(opened, F.lit(False))
    own_entry = F.coalesce("last_entry", F.when(opened, F.col("first_price")))
    rows = rows.withColumns(
        {
            "before": F.coalesce(F.product("growth").over(past), F.lit(1.0)),
            "carried": F.last(own_entry, ignorenulls=True).over(past),
            "opened": opened,
        }
    )
    rows = rows.withColumn("peak", F.max(F.col("before") * F.col("top")).over(past))
    dead = F.col("before") == 0
    low = F.try_divide(F.col("before") * F.col("low"), F.col("peak"))
    closes = F.col("first_exit").isNotNull() & ((F.col("first_signal") == "buy") | F.col("start"))
    price = F.when(F.col("opened"), F.col("first_price")).otherwise(F.col("carried"))
    rows = rows.withColumns(
        {
            "fall": F.least(low, F.when(~dead, F.col("fall"))),
            "gains": F.when(dead, 0).otherwise(F.col("gains")),
            "closes": closes.cast("bigint"),
            "wins_first": (closes & (F.col("first_exit") > price)).cast("bigint"),
        }
    )
    # A chunk without gains has no mean.
    rows = rows.withColumns({c: F.when(F.col("gains") > 0, F.col(c)).otherwise(0.0) for c in ("mean", "squares")})
    all_gains = F.sum("gains").over(series)
    rows = rows.withColumn("overall", F.try_divide(F.sum(F.col("gains") * F.col("mean")).over(series), all_gains))
    off = F.col("mean") - F.col("overall")
    found = rows.groupBy(*SERIES).agg(
        F.sum("n").alias("bars"),
        (F.lit(capital) * F.product("growth")).alias("final_value"),
        F.min("fall").alias("fall"),
        F.sum("gains").alias("gains"),
        F.max("overall").alias("mean"),
        F.sum(F.col("squares") + F.col("gains") * off * off).alias("squares"),
        F.sum(F.col("entries") + F.col("opened").cast("bigint")).alias("trade_count"),
        F.sum(F.col("closings") + F.coalesce("closes", F.lit(0))).alias("closed_count"),
        F.sum(F.col("wins") + F.coalesce("wins_first", F.lit(0))).alias("won"),
    )
    spread = F.sqrt(F.try_divide(F.col("squares"), F.col("gains") - 1))
    return found.select(
        *SERIES,
        "bars",
        "final_value",
        ((F.col("final_value") / capital - 1) * 100).alias("total_return_pct"),
        ((F.col("fall") - 1) * 100).alias("max_drawdown_pct"),
        (F.try_divide(F.col("mean"), spread) * F.sqrt(bars_a_year())).alias("sharpe"),
        (F.try_divide(F.col("won"), F.col("closed_count")) * 100).alias("win_rate_pct"),
        "trade_count",
        "closed_count",
    )
