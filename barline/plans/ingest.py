"""Queries on loading: times, duplicates, defaults, checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from barline.functions.sql import register_time_function
from barline.functions.time import epoch_micros, epoch_seconds, epoch_to_ntz
from barline.operators.quality import duplicate_keys, quality_report as report, split_valid
from barline.operators.requests import checked
from barline.plans import query
from barline.plans.adapters import candles, candles_sql, table
from barline.plans.market import TIME_SQL
from barline.sources.candles import insert_or_ignore as insert
from barline.sources.metadata import parse_margin_assets, parse_margin_pairs, parse_symbols


def _raw_epochs(spark, folder):
    """Epochs in mixed units: milliseconds, microseconds, and seconds, which are invalid."""
    micros = epoch_micros("ts")
    raw = (
        F.when(F.col("event_id") % 97 == 0, F.floor(micros / 1000000))
        .when(F.col("event_id") % 2 == 0, F.floor(micros / 1000))
        .otherwise(micros)
    )
    return table(spark, folder, "events").select("event_id", raw.cast("bigint").alias("t"))


EPOCH_SQL = """raw as (
  select event_id, case when event_id % 97 = 0 then epoch_us(ts) // 1000000
    when event_id % 2 = 0 then epoch_us(ts) // 1000 else epoch_us(ts) end as t from events)"""


@query(f"""with {EPOCH_SQL}
select event_id, cast(case when t >= 1000000000000000 then t when t >= 1000000000000 then t * 1000 end as bigint) as us
from raw""")
def time_normalise(spark, folder):
    """UTC times of raw epochs in mixed units."""
    rows = _raw_epochs(spark, folder)
    return rows.select("event_id", epoch_micros(epoch_to_ntz("t")).alias("us"))


@query(f"""with {EPOCH_SQL}
select event_id, cast(case when t >= 1000000000000000 then t when t >= 1000000000000 then t * 1000 end as bigint) as us
from raw""")
def sql_time(spark, folder):
    """The same by the SQL function."""
    register_time_function(spark)
    rows = _raw_epochs(spark, folder).select("event_id", F.expr("time_in_second(t)").alias("at"))
    return rows.select("event_id", epoch_micros("at").alias("us"))


@query(f"""with {EPOCH_SQL}
select cast(count(*) filter (t >= 1000000000000) as bigint) as valid,
  cast(count(*) filter (t < 1000000000000) as bigint) as invalid from raw""")
def invalid_epochs(spark, folder):
    """Rows that pass and fail the required-column check when their time comes from raw epochs."""
    times = epoch_to_ntz("t")
    other = {c: F.lit(1.0) for c in ("open", "high", "low", "close", "volume", "quote_asset_volume")}
    other |= {c: F.lit(1.0) for c in ("taker_buy_base_volume", "taker_buy_quote_volume")}
    rows = _raw_epochs(spark, folder).withColumns(
        {"symbol": F.lit("A"), "interval": F.lit("1m"), "open_time": times, "close_time": times,
         "number_of_trades": F.lit(1)} | other
    )
    valid, invalid = split_valid(rows)
    counts = valid.select(F.lit(1).alias("v"), F.lit(0).alias("i")).unionAll(
        invalid.select(F.lit(0).alias("v"), F.lit(1).alias("i"))
    )
    return counts.agg(F.sum("v").alias("valid"), F.sum("i").alias("invalid"))


def _stored_and_new(spark, folder):
    """Stored bars up to mid-month; new ones from before that on, twice, with other volumes."""
    c = candles(spark, folder, "1h")
    day = lambda d: F.expr(f"timestamp_ntz'2024-01-{d} 00:00:00'")
    later = c.where(F.col("open_time") >= day(10))
    new = later.withColumn("volume", F.lit(1.0)).unionByName(later.withColumn("volume", F.lit(2.0)))
    return c.where(F.col("open_time") < day(16)), new


@query(f"""with {candles_sql("1h")}
select symbol, "interval", {TIME_SQL} as time, close, case when open_time < timestamp '2024-01-16' then 0.0::double else 1.0::double end as volume
from candles""")
def insert_or_ignore(spark, folder):
    """The table after a load that overlaps it and repeats itself; stored rows show volume 0 here."""
    stored, new = _stored_and_new(spark, folder)
    stored = stored.withColumn("volume", F.lit(0.0))
    return stored.unionByName(insert(stored, new)).select(
        "symbol", "interval", epoch_seconds().alias("time"), "close", "volume"
    )


@query(f"""with {candles_sql("1h")}
select symbol, "interval", {TIME_SQL} as time, cast(2 as bigint) as rows
from candles where open_time >= timestamp '2024-01-10'""")
def repeated_keys(spark, folder):
    """Keys that a load holds more than once."""
    _, new = _stored_and_new(spark, folder)
    return duplicate_keys(new).select("symbol", "interval", epoch_seconds().alias("time"), "rows")


@query(f"""with {candles_sql("1h", "1d")}
select "interval", cast(count(*) + count(*) filter ("interval" = '1h' and open_time >= timestamp '2024-01-10') as bigint) as rows,
  cast(count(*) filter ("interval" = '1d' and number_of_trades % 2 = 0) as bigint) as with_null,
  cast(count(*) filter ("interval" = '1h' and open_time >= timestamp '2024-01-10') as bigint) as repeated,
  true as known_interval
from candles group by 1""")
def quality_report(spark, folder):
    """Rows, NULLs and repeated keys per interval of a damaged table."""
    c = candles(spark, folder, "1h", "1d")
    odd = (F.col("interval") == "1d") & (F.col("number_of_trades") % 2 == 0)
    damaged = c.withColumn("close", F.when(~odd, F.col("close")))
    again = c.where((F.col("interval") == "1h") & (F.col("open_time") >= F.expr("timestamp_ntz'2024-01-10 00:00:00'")))
    return report(damaged.unionByName(again))


def _flag(key):
    """A JSON member that is absent, null, true or false in turn."""
    k = F.col("event_id") % 4
    return (
        F.when(k == 0, F.lit(""))
        .when(k == 1, F.lit(f',"{key}":null'))
        .when(k == 2, F.lit(f',"{key}":true'))
        .otherwise(F.lit(f',"{key}":false'))
    )


def _documents(spark, folder, body):
    return table(spark, folder, "events").select(body.alias("value"))


@query("""select 'pair' as kind, 'P' || event_id as name, event_id % 4 in (0, 2) as flag from events where event_id % 10 <> 0
union all select 'asset', 'P' || event_id, event_id % 4 = 2 from events where event_id % 10 <> 0
union all select 'symbol', 'p' || event_id, event_id % 4 = 2 or (event_id % 4 = 0 and event_id % 3 = 0) from events""")
def json_defaults(spark, folder):
    """Flags of JSON rows where the member is absent, null, true or false; empty names are skipped."""
    name = F.when(F.col("event_id") % 10 == 0, "").otherwise(F.concat(F.lit("p"), "event_id"))

    def listed(key, flag):
        return _documents(spark, folder, F.concat(F.lit(f'[{{"{key}":"'), name, F.lit('"'), _flag(flag), F.lit("}]")))

    permissions = F.when(F.col("event_id") % 3 == 0, '["SPOT","MARGIN"]').otherwise('["SPOT"]')
    symbols = _documents(
        spark,
        folder,
        F.concat(
            F.lit('{"symbols":[{"symbol":"p'), "event_id", F.lit('","status":"TRADING","permissions":'),
            permissions, _flag("isMarginTradingAllowed"), F.lit("}]}"),
        ),
    )
    kinds = [
        ("pair", parse_margin_pairs(listed("symbol", "isMarginTrade")), "symbol", "is_margin_trade"),
        ("asset", parse_margin_assets(listed("asset", "isBorrowable")), "asset", "is_borrowable"),
        ("symbol", parse_symbols(symbols), "symbol", "is_margin_trading_allowed"),
    ]
    parts = [
        rows.select(F.lit(kind).alias("kind"), F.col(key).alias("name"), F.col(flag).alias("flag"))
        for kind, rows, key, flag in kinds
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query(f"""with asked as (
  select event_id, case when event_id % 7 = 0 then 'no-' || event_id when event_id % 31 = 0 then repeat('x', 21) else event_type end as symbol,
    case when event_id % 5 = 0 then '7m' else '1h' end as iv, user_id as a, case when event_id % 11 = 0 then user_id when event_id % 4 > 0 then user_id + 1 end as z,
    case when event_id % 3 > 0 then event_id % 13 end as n, event_id % 520 as length, case event_id % 17 when 0 then 'up' when 1 then 'asc' else 'desc' end as sort from events)
select event_id, case when event_id % 7 = 0 or event_id % 31 = 0 then 'symbol' when iv = '7m' then 'interval' when a >= z then 'range' when n < 1 then 'limit'
  when length not between 1 and 500 then 'length' when sort = 'up' then 'order' end as problem from asked""")
def request_checks(spark, folder):
    """The first argument of each of many requests that breaks its rule."""
    requests = table(spark, folder, "events").selectExpr(
        "event_id",
        "case when event_id % 7 = 0 then concat('no-', event_id) when event_id % 31 = 0 then repeat('x', 21) else event_type end as symbol",
        "if(event_id % 5 = 0, '7m', '1h') as interval",
        "user_id as from",
        "case when event_id % 11 = 0 then user_id when event_id % 4 > 0 then user_id + 1 end as to",
        "case when event_id % 3 > 0 then event_id % 13 end as limit",
        "event_id % 520 as length",
        "case event_id % 17 when 0 then 'up' when 1 then 'asc' else 'desc' end as order",
    )
    return checked(requests).select("event_id", "problem")
