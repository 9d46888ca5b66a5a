"""Views of the test tables in the shapes the operators take, with the SQL for the same views."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.operators.universe import eligible_keys
from barline.schemas import INTERVAL_SECONDS
from barline.streaming.ticks import candles_from_ticks

GAP_START, GAP_END = "2023-12-15", "2024-03-31"
BASE_URL = "https://archive.example.test"
LANDING = "/landing"


# The columns of the tables in use, stated so that no job has to look them up.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder below the cluster's shared checkpoint folder, or below the warehouse where none is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        if base.startswith(("file:", "/")) and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set, and the warehouse lies on this machine only")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def candles(spark: SparkSession, folder: str, *intervals: str) -> DataFrame:
    """Candles with one symbol per event type."""
    ticks = table(spark, folder, "events").select(
        F.upper("event_type").alias("symbol"), "ts", F.col("event_id").alias("seq"), "value"
    )
    return candles_from_ticks(ticks, list(intervals))


def spans_sql(*intervals: str) -> str:
    """Every event once for each interval, with the bar that holds it."""
    rows = ", ".join(f"('{i}', {INTERVAL_SECONDS[i]}::bigint)" for i in intervals)
    floor = "make_timestamp(epoch_us(ts) // (secs * 1000000) * secs * 1000000)"
    step = "to_microseconds(secs * 1000000)"
    start = f"case iv when '1w' then date_trunc('week', ts)::timestamp when '1M' then date_trunc('month', ts)::timestamp else {floor} end"
    return f"""tick_bars as (
  select *, upper(event_type) as symbol, iv as "interval", {start} as open_time,
         {start} + case iv when '1M' then interval 1 month else {step} end as bar_end
  from events cross join (values {rows}) w(iv, secs))"""


def candles_sql(*intervals: str) -> str:
    return f"""{spans_sql(*intervals)}, candles as (
  select symbol, "interval", open_time, bar_end - interval 1 millisecond as close_time,
         arg_min(value, ts) as open, max(value) as high, min(value) as low, arg_max(value, ts) as close,
         sum(value) as volume, cast(count(*) as bigint) as number_of_trades
  from tick_bars group by 1, 2, 3, 4)"""


def user_days(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of daily bars with one symbol per user, once per event; what gap detection needs."""
    return table(spark, folder, "events").select(
        F.concat(F.lit("U"), F.col("user_id")).alias("symbol"),
        F.lit("1d").alias("interval"),
        F.col("ts").alias("open_time"),
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select(F.concat(F.lit("U"), F.col("user_id")).alias("symbol"))
    return rows.distinct().withColumn("interval", F.lit("1d"))


def user_universe(spark, folder) -> DataFrame:
    """A universe of users, of which those with a purchase are trading."""
    rows = table(spark, folder, "events").groupBy(F.concat(F.lit("U"), F.col("user_id")).alias("symbol"))
    rows = rows.agg(F.max(F.col("event_type") == "purchase").alias("buys"))
    return rows.select(
        "symbol",
        F.when(F.col("buys"), "TRADING").otherwise("BREAK").alias("status"),
        F.lit("U").alias("base_asset"),
        F.lit("USDT").alias("quote_asset"),
        F.array(F.lit("MARKET")).alias("order_types"),
        F.array(F.lit("SPOT")).alias("permissions"),
        F.lit(False).alias("is_margin_trading_allowed"),
        F.lit(0).cast("bigint").alias("position"),
    )


GAPS_SQL = f"""users as (select distinct 'U' || user_id as symbol from events),
calendar as (
  select cast(g as date) as d
  from generate_series(timestamp '{GAP_START}', timestamp '{GAP_END}', interval 1 day) t(g)),
present as (select distinct 'U' || user_id as symbol, cast(ts as date) as d from events),
missing as (
  select u.symbol, c.d from users u cross join calendar c
  where not exists (select 1 from present p where p.symbol = u.symbol and p.d = c.d)),
months as (
  select symbol, cast(date_trunc('month', d) as date) as m, count(*) as n
  from missing group by 1, 2
  having count(*) = day(last_day(cast(date_trunc('month', min(d)) as date))))"""


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    """A pair list from the events: every symbol against the next one by name and the reverse, and against the one after."""
    types = table(spark, folder, "events").select(F.upper("event_type").alias("s"))
    names = types.agg(F.array_sort(F.collect_set("s")).alias("s"))
    place = F.explode(F.sequence(F.lit(1), F.size("s")))
    rows = names.select("s", place.alias("k"))
    near, far = F.try_element_at("s", F.col("k") + 1), F.try_element_at("s", F.col("k") + 2)
    one = F.try_element_at("s", F.col("k"))
    legs = F.explode(F.array(*[F.struct(b.alias("base_symbol"), q.alias("quote_symbol")) for b, q in ((one, near), (near, one), (one, far))]))
    return rows.select(legs.alias("p")).select("p.*").where("base_symbol is not null and quote_symbol is not null")


PAIRS_SQL = """names as (
  select s, row_number() over (order by s) as k from (select distinct upper(event_type) as s from events)),
pairs as (
  select a.s as base_symbol, b.s as quote_symbol from names a join names b on b.k - a.k in (1, 2, -1))"""


RATIO_SQL = PAIRS_SQL + """,
ratio as (
  select b.symbol as base_symbol, q.symbol as quote_symbol, b."interval" as "interval", b.open_time,
         b.open / q.open as open, b.close / q.close as close, b.close as base_close, q.close as quote_close
  from candles b join candles q
    on b.open_time = q.open_time and b."interval" = q."interval" and b.symbol <> q.symbol
  where exists (select 1 from pairs p where p.base_symbol = b.symbol and p.quote_symbol = q.symbol)
    and q.open <> 0 and q.close <> 0)"""


def universe(spark: SparkSession, folder: str) -> DataFrame:
    """A symbol universe with one symbol per part."""
    size = F.col("p_size")

    def one_of(condition, yes, no):
        lists = [F.array(*[F.lit(x) for x in values]) for values in (yes, no)]
        return F.when(condition, lists[0]).otherwise(lists[1])

    return table(spark, folder, "part").select(
        _part_symbol().alias("symbol"),
        F.when(size % 5 == 0, "BREAK").otherwise("TRADING").alias("status"),
        F.upper(F.replace("p_brand", F.lit("#"), F.lit(""))).alias("base_asset"),
        F.col("p_type").alias("quote_asset"),
        one_of(size % 3 == 0, ["LIMIT"], ["LIMIT", "MARKET"]).alias("order_types"),
        one_of(size % 4 == 0, ["SPOT", "MARGIN"], ["SPOT"]).alias("permissions"),
        (size % 7 == 0).alias("is_margin_trading_allowed"),
        F.col("p_partkey").alias("position"),
    )


def _part_symbol():
    return F.concat(F.lit("P"), "p_partkey", "p_type")


def margin_symbols(spark, folder, divisor: int) -> DataFrame:
    """The symbols whose margin flag is set in a list of all pairs."""
    listed = table(spark, folder, "part").select(
        _part_symbol().alias("symbol"), (F.col("p_partkey") % divisor == 0).alias("is_margin_trade")
    )
    return eligible_keys(listed, "symbol", "is_margin_trade")


def borrowable_assets(spark, folder) -> DataFrame:
    """The assets whose flag is set in a list with one row per part and side."""
    parts = table(spark, folder, "part")
    base = parts.select(
        F.upper(F.replace("p_brand", F.lit("#"), F.lit(""))).alias("asset"),
        ((F.col("p_size") % 2 == 1) & (F.col("p_partkey") % 40 == 0)).alias("is_borrowable"),
    )
    quote = parts.select(F.col("p_type").alias("asset"), (F.col("p_type") == "PROMO").alias("is_borrowable"))
    return eligible_keys(base.union(quote), "asset", "is_borrowable")


def requested(spark, folder) -> DataFrame:
    """Every symbol in lower case, and as many names that do not exist."""
    parts = table(spark, folder, "part")
    known = parts.select(F.lower(_part_symbol()).alias("symbol"), F.col("p_partkey").alias("place"))
    unknown = parts.select(F.concat(F.lit("missing"), "p_partkey").alias("symbol"), F.col("p_partkey").alias("place"))
    return known.union(unknown)


UNIVERSE_SQL = """universe as (
  select 'P' || p_partkey || p_type as symbol,
         case when p_size % 5 = 0 then 'BREAK' else 'TRADING' end as status,
         upper(replace(p_brand, '#', '')) as base_asset, p_type as quote_asset,
         p_size % 3 <> 0 as takes_market, p_size % 4 = 0 as margin_permission,
         p_size % 7 = 0 as margin_flag, p_partkey
  from part),
borrowable as (
  select distinct upper(replace(p_brand, '#', '')) as asset from part where p_size % 2 = 1 and p_partkey % 40 = 0
  union select 'PROMO' where exists (select 1 from part where p_type = 'PROMO')),
flagged as (
  select *, margin_flag or margin_permission or p_partkey % 11 = 0 as is_cross, p_partkey % 6 = 0 as is_isolated,
         base_asset in (select asset from borrowable) as base_ok,
         upper(quote_asset) in (select asset from borrowable) as quote_ok
  from universe),
requested as (
  select upper('P' || p_partkey || p_type) as symbol, p_partkey as place from part
  union all select 'MISSING' || p_partkey, p_partkey from part)"""
