"""Queries on candles: slices, catalog, ratios."""

from __future__ import annotations

from pyspark.sql import functions as F

from barline.functions.time import epoch_micros, epoch_seconds
from barline.operators import catalog, series
from barline.operators.ratio import ratio, ratio_change, ratio_lookback as lookback_of_ratio, ratios
from barline.plans import query
from barline.plans.adapters import RATIO_SQL, candles, candles_sql, pairs
from barline.schemas import INTERVALS

JAN_5, JAN_20, JAN_28 = 1704412800, 1705708800, 1706400000
PRICES = ["open", "high", "low", "close"]
TIME_SQL = "cast(epoch_us(open_time) // 1000000 as bigint)"


def r6(*columns):
    return [F.round(c, 6).alias(c) for c in columns]


def full(c, *more):
    volumes = ["volume", "quote_asset_volume", "taker_buy_base_volume", "taker_buy_quote_volume"]
    return c.select(
        "symbol", "interval", epoch_seconds().alias("time"), *PRICES, *r6(*volumes), "number_of_trades", *more
    )


FULL_SQL = f"""symbol, "interval", {TIME_SQL} as time, open, high, low, close,
  round(volume, 6) as volume, round(volume, 6) as quote_asset_volume, round(volume / 2, 6) as taker_buy_base_volume,
  round(volume / 2, 6) as taker_buy_quote_volume, number_of_trades"""


@query(f"""with {candles_sql(*INTERVALS)}
select {FULL_SQL}, cast(epoch_us(close_time) // 1000 as bigint) as close_ms from candles""")
def candles_from_events(spark, folder):
    """Candles at every interval, calendar weeks and months included, from one pass over the ticks."""
    c = candles(spark, folder, *INTERVALS)
    close_ms = F.floor(epoch_micros("close_time") / 1000).cast("bigint").alias("close_ms")
    return full(c, close_ms)


@query(f"""with {candles_sql("1h")}
select {TIME_SQL} as time, open, high, low, close, round(volume, 6) as volume,
  round(volume, 6) as quote_asset_volume, number_of_trades, round(volume / 2, 6) as taker_buy_base_volume,
  round(volume / 2, 6) as taker_buy_quote_volume
from candles where symbol = 'CLICK' and open_time >= timestamp '2024-01-05' and open_time < timestamp '2024-01-20'""")
def candle_slice(spark, folder):
    """One series, half-open range."""
    rows = series.series(candles(spark, folder, "1h"), "click", "1h", JAN_5, JAN_20)
    volumes = [c for c in rows.columns if "volume" in c]
    return rows.withColumns({c: F.round(c, 6) for c in volumes})


@query(f"""with {candles_sql("1h")}
select {TIME_SQL} as time, open, close, case when close >= open then 'up' else 'down' end as direction
from candles where symbol = 'VIEW'""")
def candle_fields(spark, folder):
    """A subset of the served columns, newest first, with the up/down flag."""
    rows = series.series(candles(spark, folder, "1h"), "VIEW", "1h", order="desc", fields="close, time,open")
    return series.direction(rows)


@query(f"""with {candles_sql("15m", "1h", "1d")}
select {FULL_SQL}, round((close - open) / nullif(open, 0) * 100, 6) as change_pct
from candles c
where open_time = (select max(d.open_time) from candles d where d.symbol = c.symbol and d."interval" = c."interval")""")
def latest_candle(spark, folder):
    """The latest bar of every series and its change from open to close."""
    last = series.latest(candles(spark, folder, "15m", "1h", "1d"))
    return full(last, F.round(series.change_pct(), 6).alias("change_pct"))


@query(f"""with {candles_sql("15m", "1h")}
select symbol, "interval", {TIME_SQL} as time, open, high, low, close from candles
where open_time >= timestamp '2024-01-28' - interval 20 day and open_time < timestamp '2024-01-28'""")
def lookback_slice(spark, folder):
    """The last 20 days of every series before a date."""
    rows = series.lookback(candles(spark, folder, "15m", "1h"), 20, JAN_28)
    return rows.select("symbol", "interval", epoch_seconds().alias("time"), *PRICES)


@query(f"""with {candles_sql("15m", "1h")}
select symbol, "interval", {TIME_SQL} as time, open, high, low, close from candles
where open_time < timestamp '2024-01-28'""")
def lookback_all(spark, folder):
    """Everything before a date."""
    rows = series.lookback(candles(spark, folder, "15m", "1h"), None, JAN_28)
    return rows.select("symbol", "interval", epoch_seconds().alias("time"), *PRICES)


@query(f"""with {candles_sql("1h")}
select symbol, "interval", {TIME_SQL} as time, close from candles
where symbol in ('CLICK', 'VIEW') and open_time >= timestamp '2024-01-05' and open_time < timestamp '2024-01-20'""")
def multi_symbol(spark, folder):
    rows = series.multi_series(candles(spark, folder, "1h"), ["click", "view"], "1h", JAN_5, JAN_20)
    return rows.select("symbol", "interval", epoch_seconds().alias("time"), "close")


@query(f"""with {candles_sql("1h")}
select {TIME_SQL} as time, open, high, low, close from candles
where symbol = 'ERROR' and open_time > timestamp '2024-01-05' order by open_time limit 500""")
def keyset_page(spark, folder):
    """The page of one series that follows a given last time."""
    rows = series.page_after(candles(spark, folder, "1h"), "ERROR", "1h", 500, after=JAN_5)
    return rows.select("time", *PRICES)


@query(f"""with {candles_sql("1h", "1d")},
asked as (
  select upper(event_type) as symbol, iv as "interval"
  from (select distinct event_type from events) cross join (values ('1h'), ('1d'), ('4h')) w(iv))
select a.symbol, a."interval",
  exists (select 1 from candles c where c.symbol = a.symbol and c."interval" = a."interval") as found
from asked a""")
def series_exists(spark, folder):
    """Which requested series have a bar."""
    c = candles(spark, folder, "1h", "1d")
    asked = c.select("symbol").distinct()
    asked = asked.withColumn("interval", F.explode(F.array(F.lit("1h"), F.lit("1d"), F.lit("4h"))))
    return series.existing_series(asked, c)


@query(f"""with {candles_sql("15m", "1h", "1d")}
select symbol, string_agg(iv, ',' order by iv) as intervals
from (select distinct symbol, "interval" as iv from candles) group by symbol""")
def symbols_intervals(spark, folder):
    rows = catalog.symbols_intervals(candles(spark, folder, "15m", "1h", "1d"))
    return rows.select("symbol", F.array_join("intervals", ",").alias("intervals"))


@query(f"""with {candles_sql("15m", "1h", "1d")}
select distinct "interval" from candles where symbol = 'SIGNUP'""")
def intervals_of(spark, folder):
    return catalog.intervals_of(candles(spark, folder, "15m", "1h", "1d"), "signup")


@query(f"""with {candles_sql("15m", "1h", "1d")}
select symbol, "interval", symbol as base_asset, '' as quote_asset,
  cast(epoch_us(min(open_time)) // 1000000 as bigint) as first_time,
  cast(epoch_us(max(open_time)) // 1000000 as bigint) as last_time, cast(count(*) as bigint) as "count"
from candles group by 1, 2""")
def symbol_coverage(spark, folder):
    return catalog.coverage(candles(spark, folder, "15m", "1h", "1d"))


@query(f"""with {candles_sql("1h")}
select symbol, "interval", cast(epoch_us(min(open_time)) // 1000000 as bigint) as first_time,
  cast(epoch_us(max(open_time)) // 1000000 as bigint) as last_time, cast(count(*) as bigint) as "count"
from candles where symbol in ('VIEW', 'ERROR') group by 1, 2""")
def coverage_of_list(spark, folder):
    """Coverage of a symbol list at one interval."""
    c = candles(spark, folder, "1h", "1d")
    return catalog.coverage(c, ["view", "error"], "1h").drop("base_asset", "quote_asset")


@query("select cast(count(distinct upper(event_type)) as bigint) as symbols from events")
def distinct_symbols(spark, folder):
    return catalog.distinct_symbols(candles(spark, folder, "1h"))


RATIO_COLUMNS_SQL = """round(open, 6) as open, round(greatest(open, close), 6) as high,
  round(least(open, close), 6) as low, round(close, 6) as close, base_close, quote_close"""


@query(f"""with {candles_sql("1h")}, {RATIO_SQL}
select {TIME_SQL} as time, {RATIO_COLUMNS_SQL}
from ratio where base_symbol = 'CLICK' and quote_symbol = 'ERROR'""")
def ratio_candles(spark, folder):
    """Ratio candles of one pair."""
    rows = ratio(candles(spark, folder, "1h"), "click", "error", "1h")
    return rows.select("time", *r6(*PRICES), "base_close", "quote_close")


@query(f"""with {candles_sql("1h", "1d")}, {RATIO_SQL}
select base_symbol, quote_symbol, "interval", {TIME_SQL} as time, {RATIO_COLUMNS_SQL} from ratio""")
def ratio_many_pairs(spark, folder):
    """Ratio candles of a list of pairs, at two intervals."""
    rows = ratios(candles(spark, folder, "1h", "1d"), pairs(spark, folder))
    return rows.select(
        "base_symbol", "quote_symbol", "interval", epoch_seconds().alias("time"), *r6(*PRICES), "base_close", "quote_close"
    )


@query(f"""with {candles_sql("1h", "1d")}, {RATIO_SQL}
select base_symbol, quote_symbol, "interval", cast(count(*) as bigint) as bars,
  round((arg_max(close, open_time) - arg_min(open, open_time)) / nullif(arg_min(open, open_time), 0) * 100, 6) as change_pct
from ratio group by 1, 2, 3""")
def ratio_change_pct(spark, folder):
    """Change of every pair from its first open to its last close."""
    rows = ratio_change(ratios(candles(spark, folder, "1h", "1d"), pairs(spark, folder)))
    return rows.select("base_symbol", "quote_symbol", "interval", "bars", *r6("change_pct"))


@query(f"""with {candles_sql("1h")}, {RATIO_SQL}
select {TIME_SQL} as time, {RATIO_COLUMNS_SQL}
from ratio where base_symbol = 'CLICK' and quote_symbol = 'PURCHASE'
  and open_time >= timestamp '2024-01-28' - interval 10 day and open_time < timestamp '2024-01-28'""")
def ratio_lookback(spark, folder):
    """Ratio candles of one pair over the last ten days before a date."""
    rows = lookback_of_ratio(candles(spark, folder, "1h"), "click", "purchase", "1h", 10, JAN_28)
    return rows.select("time", *r6(*PRICES), "base_close", "quote_close")


ZERO_SQL = """zeroed as (
  select * replace (case when number_of_trades % 3 = 0 then 0 else open end as open,
                    case when number_of_trades % 5 = 0 then 0 else close end as close) from candles)"""


def zeroed(c):
    """Candles of which some opens and closes are 0."""
    n = F.col("number_of_trades")
    return c.withColumns({"open": F.when(n % 3 == 0, 0.0).otherwise(F.col("open")), "close": F.when(n % 5 == 0, 0.0).otherwise(F.col("close"))})


@query(f"""with {candles_sql("1h", "1d")}, {ZERO_SQL}, {RATIO_SQL.replace("candles b", "zeroed b").replace("candles q", "zeroed q")}
select base_symbol, quote_symbol, "interval", {TIME_SQL} as time, {RATIO_COLUMNS_SQL} from ratio""")
def ratio_with_zeros(spark, folder):
    """Ratio candles of bars of which some have a zero; those of the quote leave no ratio."""
    rows = ratios(zeroed(candles(spark, folder, "1h", "1d")), pairs(spark, folder))
    return rows.select(
        "base_symbol", "quote_symbol", "interval", epoch_seconds().alias("time"), *r6(*PRICES), "base_close", "quote_close"
    )
