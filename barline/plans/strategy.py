"""Queries on indicators, signals and backtests."""

from __future__ import annotations

from pyspark.sql import functions as F

from barline.functions.time import epoch_seconds
from barline.operators import backtest, indicators
from barline.operators.chunks import first_n, last_n
from barline.plans import query
from barline.plans.adapters import candles, candles_sql
from barline.plans.market import TIME_SQL, ZERO_SQL, r6, zeroed

K = 'partition by symbol, "interval" order by open_time'

def sma_sql(source, length):
    return f"""select symbol, "interval", {TIME_SQL} as time, round(value, 6) as value
from (select symbol, "interval", open_time,
        avg(close) over ({K} rows between {length - 1} preceding and current row) as value,
        count(*) over ({K} rows between {length - 1} preceding and current row) as n
      from {source})
where n = {length}"""


@query(f"""with {candles_sql("15m", "1h")} {sma_sql("candles", 20)}""")
def sma(spark, folder):
    """Moving average of 20 bars."""
    rows = indicators.sma(candles(spark, folder, "15m", "1h"))
    return rows.select("symbol", "interval", "time", *r6("value"))


@query(f"""with {candles_sql("15m", "1h")} {sma_sql("candles", 50)}""")
def sma_full_series(spark, folder):
    """Moving average of 50 bars."""
    rows = indicators.sma(candles(spark, folder, "15m", "1h"), length=50)
    return rows.select("symbol", "interval", "time", *r6("value"))


THIRDS_SQL = f"""placed as (
  select symbol, "interval", open_time, row_number() over ({K}) - 1 as i,
         count(*) over (partition by symbol, "interval") as n from candles),
marks as (
  select *, i = n // 3 as is_buy from placed
  where n >= 2 and (i = n // 3 or i = least(greatest(n // 3 + 1, n * 2 // 3), n - 1)))"""


@query(f"""with {candles_sql("15m", "1h", "1d")}, {THIRDS_SQL}
select symbol, "interval", {TIME_SQL} as time,
  case when is_buy then 'belowBar' else 'aboveBar' end as position,
  case when is_buy then '#0f8b8d' else '#c2410c' end as color,
  case when is_buy then 'arrowUp' else 'arrowDown' end as shape,
  case when is_buy then 'Long' else 'Exit' end as text from marks""")
def signals_thirds(spark, folder):
    """Placeholder markers at a third and at two thirds of every series."""
    return indicators.signals_thirds(candles(spark, folder, "15m", "1h", "1d"))


@query(f"""with {candles_sql("15m", "1h", "1d")}, {THIRDS_SQL}
select symbol, "interval", case when is_buy then 'Buy' else 'Sell' end as side,
  case when is_buy then 'Long' else 'Exit' end as text, strftime(open_time, '%Y-%m-%d') as day from marks""")
def signal_listing(spark, folder):
    return indicators.signal_listing(indicators.signals_thirds(candles(spark, folder, "15m", "1h", "1d")))


CROSS_SQL = f"""averages as (
  select symbol, "interval", open_time, close, row_number() over ({K}) as pos, lag(close) over ({K}) as previous,
    avg(close) over ({K} rows between 19 preceding and current row) as fast,
    avg(close) over ({K} rows between 49 preceding and current row) as slow
  from candles),
lagged as (select *, lag(fast) over ({K}) as f0, lag(slow) over ({K}) as s0 from averages),
crossed as (
  select *, case when pos > 50 and fast > slow and f0 <= s0 then 'buy'
                 when pos > 50 and fast < slow and f0 >= s0 then 'exit' end as signal
  from lagged)"""


@query(f"""with {candles_sql("15m", "1h")}, {CROSS_SQL}
select symbol, "interval", {TIME_SQL} as time, signal, close from crossed where signal is not null""")
def ma_cross(spark, folder):
    """Crossings of the 20-bar and the 50-bar average."""
    return indicators.ma_cross(candles(spark, folder, "15m", "1h"))


@query(f"""with {candles_sql("15m", "1h")},
ranges as (
  select *, lag(close) over ({K}) as previous, row_number() over ({K}) as pos,
    max(high) over ({K} rows between 30 preceding and 1 preceding) as top from candles),
spans as (
  select *, case when previous is not null
    then greatest(high - low, abs(high - previous), abs(low - previous)) end as tr from ranges),
rated as (select *, avg(tr) over ({K} rows between 13 preceding and current row) as atr from spans)
select symbol, "interval", {TIME_SQL} as time, close, top, round(atr, 6) as atr from rated
where pos > 30 and close > top and close - previous > atr""")
def breakout(spark, folder):
    """Closes above the high of 30 bars by more than the average true range."""
    rows = indicators.breakout(candles(spark, folder, "15m", "1h"))
    return rows.select("symbol", "interval", "time", "close", "top", *r6("atr"))


@query(f"""with {candles_sql("15m", "1h", "1d")},
ends as (
  select symbol, "interval", arg_min(close, open_time) as a, arg_max(close, open_time) as z, count(*) as n
  from candles group by 1, 2)
select symbol, "interval", a as first_close, z as last_close, cast(n as bigint) as bars,
  round((z - a) / nullif(a, 0) * 100, 6) as total_return_pct,
  case when (z - a) / nullif(a, 0) >= 0 then 100.0::double when (z - a) / nullif(a, 0) < 0 then 0.0::double end as win_rate_pct,
  cast(1 as bigint) as trade_count
from ends where n >= 2""")
def total_return(spark, folder):
    """Return of every series from its first to its last close."""
    rows = backtest.total_return(candles(spark, folder, "15m", "1h", "1d"))
    return rows.select(
        "symbol", "interval", "first_close", "last_close", "bars", *r6("total_return_pct"), "win_rate_pct",
        F.col("trade_count").cast("bigint").alias("trade_count"),
    )


def curve_sql(source):
    return f"""steps as (select *, lag(close) over ({K}) as previous from {source}),
curve as (
  select symbol, "interval", open_time,
    10000 * product(case when coalesce(previous, 0) <> 0 then close / previous else 1 end) over (
      {K} rows between unbounded preceding and current row) as value
  from steps)"""


EQUITY_SQL = f"""{curve_sql("candles")}
select symbol, "interval", {TIME_SQL} as time, round(value, 4) as value from curve"""


def _curve(c, **options):
    rows = backtest.equity_points(backtest.equity(c, **options))
    return rows.select("symbol", "interval", "time", F.round("value", 4).alias("value"))


@query(f"""with {candles_sql("15m", "1h", "1d")}, {EQUITY_SQL}""")
def equity_curve(spark, folder):
    """Equity over every series."""
    return _curve(candles(spark, folder, "15m", "1h", "1d"))


@query(f"""with {candles_sql("15m", "1h", "1d")}, {ZERO_SQL}, {curve_sql("zeroed")}
select symbol, "interval", {TIME_SQL} as time, round(value, 4) as value from curve""")
def equity_with_zeros(spark, folder):
    """Equity over series with closes of 0, in chunks of 300 bars."""
    return _curve(zeroed(candles(spark, folder, "15m", "1h", "1d")), chunk_bars=300)


YEAR_SQL = """(case "interval" when '15m' then 35040 when '1h' then 8760 when '1d' then 365 end)"""
RISK_SQL = f"""gains as (
  select symbol, "interval",
    value / nullif(max(value) over ({K} rows between unbounded preceding and current row), 0) - 1 as fall,
    value / nullif(lag(value) over ({K}), 0) - 1 as gain
  from curve),
risk as (
  select symbol, "interval", cast(count(*) as bigint) as bars, round(min(fall) * 100, 6) as max_drawdown_pct,
    round(avg(gain) / nullif(stddev_samp(gain), 0) * sqrt({YEAR_SQL}), 6) as sharpe
  from gains group by 1, 2)"""


@query(f"""with {candles_sql("1h", "1d")}, {curve_sql("candles")}, {RISK_SQL} select * from risk""")
def drawdown_sharpe(spark, folder):
    """Deepest fall and yearly Sharpe ratio of every equity curve."""
    rows = backtest.risk(backtest.equity(candles(spark, folder, "1h", "1d")))
    return rows.select("symbol", "interval", "bars", *r6("max_drawdown_pct", "sharpe"))


HELD_SQL = f"""forced as (
  select *, coalesce(last_value(signal ignore nulls) over (
      {K} rows between unbounded preceding and current row) = 'buy', false) as held from crossed),
turns as (select *, coalesce(lag(held) over ({K}), false) as held_before from forced)"""


NET_SQL = f"""{CROSS_SQL}, {HELD_SQL},
net as (
  select *, 10000 * product(case when held_before then close / nullif(previous, 0) else 1 end
      * case when held <> held_before then 1 - 15 / 10000.0::double else 1 end) over (
    {K} rows between unbounded preceding and current row) as value
  from turns)"""
NET_ROWS_SQL = f"""{NET_SQL}
select symbol, "interval", {TIME_SQL} as time, cast(held as int) as held, round(value, 4) as value from net"""


def _net(c, **options):
    rows = backtest.net_equity(c, fee_bps=10, slippage_bps=5, **options)
    return rows.select("symbol", "interval", epoch_seconds().alias("time"), "held", F.round("value", 4).alias("value"))


@query(f"""with {candles_sql("15m", "1h")}, {NET_ROWS_SQL}""")
def net_equity(spark, folder):
    """Equity of the moving-average strategy with 10 bps fee and 5 bps slippage."""
    return _net(candles(spark, folder, "15m", "1h"))


PAIRED_SQL = f"""changes as (select * from turns where held <> held_before),
paired as (
  select *, lead(open_time) over ({K}) as done_time, lead(close) over ({K}) as done_close from changes)"""
TRADES_SQL = f"""{CROSS_SQL}, {HELD_SQL}, {PAIRED_SQL}
select symbol, "interval", 'buy' as side, 1.0::double as quantity, {TIME_SQL} as entry_time, close as entry_price,
  cast(epoch_us(done_time) // 1000000 as bigint) as exit_time, done_close as exit_price,
  round(done_close - close, 6) as pnl
from paired where held"""


@query(f"""with {candles_sql("15m", "1h")}, {TRADES_SQL}""")
def trades(spark, folder):
    """Entries of the moving-average strategy paired with their exits."""
    rows = backtest.trades(candles(spark, folder, "15m", "1h"))
    return rows.withColumn("pnl", F.round("pnl", 6))


@query(f"""with {candles_sql("15m", "1h", "1d")}, {NET_SQL}, {PAIRED_SQL},
curve as (select * from net), {RISK_SQL},
final as (
  select symbol, "interval", arg_max(value, open_time) as final_value from curve group by 1, 2),
done as (
  select symbol, "interval", count(*) as trade_count, count(done_time) as closed_count,
    count(*) filter (done_close > close) as won
  from paired where held group by 1, 2)
select symbol, "interval", bars, round(final_value, 4) as final_value, round((final_value / 10000 - 1) * 100, 6) as total_return_pct,
  max_drawdown_pct, sharpe, round(won / nullif(closed_count, 0) * 100, 6) as win_rate_pct,
  cast(coalesce(trade_count, 0) as bigint) as trade_count, cast(coalesce(closed_count, 0) as bigint) as closed_count
from risk join final using (symbol, "interval") left join done using (symbol, "interval")""")
def backtest_metrics(spark, folder):
    """Return, drawdown, Sharpe ratio, win rate and trades of the strategy, from the same bars, per series."""
    rows = backtest.metrics(candles(spark, folder, "15m", "1h", "1d"), fee_bps=10, slippage_bps=5)
    return rows.select(
        "symbol", "interval", "bars", F.round("final_value", 4).alias("final_value"),
        *r6("total_return_pct", "max_drawdown_pct", "sharpe", "win_rate_pct"), "trade_count", "closed_count",
    )


# The same over series that are split into many chunks.
CHUNK = 250


@query(f"""with {candles_sql("15m", "1h")} {sma_sql("candles", 50)}""")
def sma_in_chunks(spark, folder):
    rows = indicators.sma(candles(spark, folder, "15m", "1h"), length=50, chunk_bars=CHUNK)
    return rows.select("symbol", "interval", "time", *r6("value"))


@query(f"""with {candles_sql("15m", "1h")}, {NET_ROWS_SQL}""")
def net_equity_in_chunks(spark, folder):
    return _net(candles(spark, folder, "15m", "1h"), chunk_bars=CHUNK)


@query(f"""with {candles_sql("15m", "1h")}, {TRADES_SQL}""")
def trades_in_chunks(spark, folder):
    rows = backtest.trades(candles(spark, folder, "15m", "1h"), chunk_bars=CHUNK)
    return rows.withColumn("pnl", F.round("pnl", 6))


@query(f"""with {candles_sql("15m", "1h")}
select symbol, "interval", {TIME_SQL} as time, close from (
  select *, row_number() over ({K}) as rn from candles) where rn <= 400""")
def first_bars(spark, folder):
    """The 400 earliest bars of every series."""
    rows = first_n(candles(spark, folder, "15m", "1h"), 400, chunk_bars=CHUNK)
    return rows.select("symbol", "interval", epoch_seconds().alias("time"), "close")


@query(f"""with {candles_sql("15m", "1h")}
select symbol, "interval", {TIME_SQL} as time, close from (
  select *, row_number() over (partition by symbol, "interval" order by open_time desc) as rn from candles) where rn <= 400""")
def last_bars(spark, folder):
    """The 400 latest bars of every series."""
    rows = last_n(candles(spark, folder, "15m", "1h"), 400, chunk_bars=CHUNK)
    return rows.select("symbol", "interval", epoch_seconds().alias("time"), "close")
