"""Queries on gaps, planned files and fetch logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from barline.functions.sql import register_gap_function
from barline.functions.text import url_to_path as landing_path
from barline.functions.time import epoch_seconds
from barline.operators import backfill, gaps, runs, universe
from barline.plans import query
from barline.plans.adapters import (
    BASE_URL,
    GAP_END,
    GAP_START,
    GAPS_SQL,
    LANDING,
    candles,
    candles_sql,
    table,
    user_days,
    user_universe,
    users,
)
from barline.schemas import Backfill, UniverseFilter

DAILY_URL = f"'{BASE_URL}/data/spot/daily/klines/' || symbol || '/1d/' || symbol || '-1d-' || strftime(d, '%Y-%m-%d') || '.zip'"
MONTHLY_URL = f"'{BASE_URL}/data/spot/monthly/klines/' || symbol || '/1d/' || symbol || '-1d-' || strftime(m, '%Y-%m') || '.zip'"


def _day(column="day"):
    return F.date_format(column, "yyyy-MM-dd").alias("day")


@query(f"""with {GAPS_SQL}
select symbol, '1d' as "interval", strftime(d, '%Y-%m-%d') as day from missing""")
def missing_days(spark, folder):
    """Days without a bar, for every user series."""
    rows = gaps.missing_days(user_days(spark, folder), users(spark, folder), GAP_START, GAP_END)
    return rows.select("symbol", "interval", _day())


@query(f"""with {GAPS_SQL}
select symbol, '1d' as "interval", strftime(m, '%Y-%m-%d') as day, cast(n as bigint) as days from months""")
def missing_months(spark, folder):
    """Months without a single bar, for every user series."""
    rows = gaps.missing_months(user_days(spark, folder), users(spark, folder), GAP_START, GAP_END)
    return rows.select("symbol", "interval", _day(), "days")


@query(f"""with {GAPS_SQL}
select 'daily' as freq, symbol, {DAILY_URL} as url from missing
union all select 'monthly', symbol, {MONTHLY_URL} from months""")
def missing_urls(spark, folder):
    """Addresses of the daily and monthly archives that would fill the gaps."""
    days, series = user_days(spark, folder), users(spark, folder)
    planned = [
        gaps.planned_files(days, series, GAP_START, GAP_END, freq, BASE_URL).select(
            F.lit(freq).alias("freq"), "symbol", "url"
        )
        for freq in ("daily", "monthly")
    ]
    return planned[0].unionByName(planned[1])


def _sent(spark, folder):
    """Page addresses, half of them below /data/."""
    url = F.when(
        F.col("page_id") % 2 == 0, F.regexp_replace("url", r"^(https?://[^/]+)/", "$1/data/")
    ).otherwise(F.col("url"))
    return table(spark, folder, "pages").select("page_id", url.alias("url"))


@query(f"""with sent as (
  select page_id, case when page_id % 2 = 0 then regexp_replace(url, '^(https?://[^/]+)/', '\\1/data/') else url end as url
  from pages),
steps as (
  select page_id, regexp_replace(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), '/+', '/', 'g') as path from sent),
cut as (select page_id, regexp_replace(regexp_replace(path, '/$', ''), '^/?(data(/|$))?', '') as path from steps)
select page_id, case when path <> '' then '{LANDING}/' || path end as path from cut""")
def url_to_path(spark, folder):
    """Landing paths of page addresses."""
    return _sent(spark, folder).select("page_id", landing_path("url", LANDING).alias("path"))


LOG_SQL = """log as (
  select user_id % 10 as batch, event_type as e, event_id % 2 = 0 as ok from events),
batches as (
  select batch, cast(count(*) as bigint) as url_count,
    cast(count(*) filter (e = 'click' or (e = 'purchase' and ok)) as bigint) as downloaded,
    cast(count(*) filter (e = 'view') as bigint) as skipped,
    cast(count(*) filter (e = 'signup') as bigint) as missing_remote,
    cast(count(*) filter (e = 'error' or (e = 'purchase' and not ok)) as bigint) as failed
  from log group by 1)"""


def _landed(spark, folder):
    """Planned daily archives, and a listing that holds those of every day before February."""
    series = users(spark, folder)
    planned = gaps.planned_files(user_days(spark, folder), series, GAP_START, GAP_END, "daily", BASE_URL)
    here = gaps.file_keys(gaps.expected_days(series, GAP_START, "2024-01-31"), "daily", BASE_URL)
    return planned, here.select(landing_path("url", LANDING).alias("path"))


@query(f"""with {GAPS_SQL}
select symbol, '{LANDING}' || replace({DAILY_URL}, '{BASE_URL}/data', '') as path
from missing where d >= date '2024-02-01'""")
def planned_not_landed(spark, folder):
    """Planned archives that are not in the landing listing."""
    planned, landed = _landed(spark, folder)
    return gaps.not_landed(planned, landed, LANDING).select("symbol", "path")


@query(f"""with {GAPS_SQL},
batches as (select symbol, (row_number() over (order by symbol) - 1) // 25 as batch from users),
counts as (select symbol, count(*) as n from missing group by 1)
select cast(batch as bigint) as batch, cast(count(*) as bigint) as symbols,
  cast(coalesce(sum(n), 0) as bigint) as url_count
from batches left join counts using (symbol) group by 1""")
def plan_counts(spark, folder):
    """Files planned per batch of 25 symbols."""
    series = users(spark, folder)
    keys = gaps.planned_files(user_days(spark, folder), series, GAP_START, GAP_END, "daily", BASE_URL)
    return runs.plan_counts(keys, universe.with_batch(series.select("symbol")))


MONTHLY_JOB = Backfill(
    "1d", GAP_START, GAP_END, LANDING, freq="monthly", universe=UniverseFilter(quote_asset="usdt", market_orders=True)
)


@query(f"""with {GAPS_SQL},
trading as (select 'U' || user_id as symbol from events group by user_id having bool_or(event_type = 'purchase')),
placed as (select symbol, (row_number() over (order by symbol) - 1) // 25 as batch from trading),
counts as (select symbol, count(*) as n from months group by 1)
select cast(batch as bigint) as batch, cast(count(*) as bigint) as symbols,
  cast(coalesce(sum(n), 0) as bigint) as url_count, 'dry_run' as status
from placed left join counts using (symbol) group by 1""")
def backfill_dry_run(spark, folder):
    """Monthly files per batch that a run over the tradable universe would fetch."""
    symbols = backfill.resolve_symbols(spark, MONTHLY_JOB, user_universe(spark, folder))
    files = backfill.all_files(MONTHLY_JOB, user_days(spark, folder), symbols, BASE_URL)
    return backfill.dry_run(files, symbols)


@query(f"""with {GAPS_SQL}
select 'kept' as mode, symbol, '{LANDING}' || replace({DAILY_URL}, '{BASE_URL}/data', '') as path from missing where d >= date '2024-02-01'
union all select 'forced', symbol, '{LANDING}' || replace({DAILY_URL}, '{BASE_URL}/data', '') from missing""")
def forced_plan(spark, folder):
    """Files of a run over listed users: without those that landed, and forced to fetch them again."""
    _, landed = _landed(spark, folder)
    symbols, days = users(spark, folder).select("symbol"), user_days(spark, folder)
    job = Backfill("1d", GAP_START, GAP_END, LANDING, universe=UniverseFilter())
    rows = gaps.with_landed(backfill.all_files(job, days, symbols, BASE_URL), landed, LANDING)
    modes = F.array_compact(F.array(F.when(~F.col("landed"), "kept"), F.lit("forced")))
    return rows.select(F.explode(modes).alias("mode"), "symbol", "path")


@query(f"""with {GAPS_SQL}, {LOG_SQL},
judged as (select *, case when failed > 0 then 'complete_with_errors' else 'complete' end as status from batches),
loaded as (select user_id % 10 as batch, count(distinct user_id) as n from events where event_type = 'click' group by 1)
select '1d' as "interval", '{GAP_START}' as first_day, 'universe' as source, (select count(*) from users) as symbol_count,
  cast(sum(url_count) as bigint) as url_count, cast(sum(failed) as bigint) as failed, 'complete_with_errors' as status,
  cast(count(*) as bigint) as batches, cast(sum(n) as bigint) as inserted
from judged left join loaded using (batch)""")
def run_record(spark, folder):
    """The record of a run: what was asked, its symbols and totals, and the files that each batch loaded."""
    batches = runs.batch_status(runs.outcome_counts(_log(spark, folder)), continue_on_error=True)
    clicks = table(spark, folder, "events").where("event_type = 'click'").select("user_id").distinct()
    inserted = clicks.select((F.col("user_id") % 10).alias("batch"), F.concat(F.lit("u"), "user_id").alias("path"))
    record = backfill.run_record(MONTHLY_JOB, users(spark, folder), batches, inserted)
    return record.select("interval", "first_day", "source", "symbol_count", "url_count", "failed", "status", "batches", "inserted")


@query(f"""with {LOG_SQL},
loaded as (select user_id % 10 as batch, count(distinct user_id) as n from events where event_type = 'click' group by 1)
select batches.*, case when failed > 0 then 'complete_with_errors' else 'complete' end as status, cast(coalesce(n, 0) as bigint) as inserted
from batches left join loaded using (batch)""")
def run_batches(spark, folder):
    """The batches of that run, each with the number of files it loaded."""
    batches = runs.batch_status(runs.outcome_counts(_log(spark, folder)), continue_on_error=True)
    clicks = table(spark, folder, "events").where("event_type = 'click'").select("user_id").distinct()
    inserted = clicks.select((F.col("user_id") % 10).alias("batch"), F.concat(F.lit("u"), "user_id").alias("path"))
    return backfill.run_batches(batches, inserted)


def _log(spark, folder):
    e = F.col("event_type")
    result = (
        F.when(e == "click", "downloaded")
        .when(e == "view", "skipped")
        .when(e == "signup", "missing_remote")
        .when(e == "error", "failed")
        .otherwise("other")
    )
    return table(spark, folder, "events").select(
        (F.col("user_id") % 10).alias("batch"), result.alias("result"), (F.col("event_id") % 2 == 0).alias("ok")
    )


@query(f"""with {LOG_SQL}
select *, case when failed > 0 then 'complete_with_errors' else 'complete' end as status from batches""")
def fetch_outcomes(spark, folder):
    """Outcome counts and status per batch of a fetch log."""
    return runs.batch_status(runs.outcome_counts(_log(spark, folder)), continue_on_error=True)


@query(f"""with {LOG_SQL}
select cast(sum(url_count) as bigint) as url_count, cast(sum(failed) as bigint) as failed from batches""")
def run_totals(spark, folder):
    return runs.run_totals(runs.outcome_counts(_log(spark, folder)))


def _attempts(spark, folder):
    """Four tries per file, one event each, the last of which is one too many."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    status = F.element_at(F.array(F.lit(200), F.lit(404), F.lit(500), F.lit(503)), (cents % 4 + 1).cast("int"))
    return table(spark, folder, "events").select(
        F.concat(F.lit("u"), F.expr("event_id div 4")).alias("url"),
        (F.col("event_id") % 4 + 1).cast("int").alias("attempt"),
        status.alias("status"),
        F.lit(None).cast("string").alias("error"),
    )


@query("""with tries as (
  select 'u' || event_id // 4 as url, event_id % 4 + 1 as attempt,
    case cast(round(value * 100) as bigint) % 4 when 0 then 200 when 1 then 404 when 2 then 500 else 503 end as status
  from events),
used as (select * from tries where attempt <= 3),
decided as (
  select url, min(attempt) filter (status in (200, 404)) as first_final, max(attempt) as last from used group by 1)
select u.url, cast(u.status as bigint) as status, u.status < 500 as ok,
  case when u.status <> 200 then 'HTTP ' || u.status end as error,
  case u.status when 200 then 'downloaded' when 404 then 'missing_remote' else 'failed' end as result
from used u join decided d on d.url = u.url and u.attempt = coalesce(d.first_final, d.last)""")
def outcome_from_attempts(spark, folder):
    """Outcome per file from its attempts."""
    rows = runs.outcome_from_attempts(_attempts(spark, folder), expected_missing=(404,))
    return rows.withColumn("status", F.col("status").cast("bigint"))


@query("""with failures as (
  select user_id % 10 as batch, event_id as position, 'u' || event_id as url,
    case when event_id % 2 = 0 then '500' else 'timeout' end as reason
  from events where event_type = 'error'),
ranked as (select *, row_number() over (partition by batch order by position) as rn from failures),
counts as (select batch, count(*) as n from failures group by 1)
select r.batch, cast(n as bigint) as failed,
  n || ' download(s) failed: ' || string_agg(url || ' (' || reason || ')', ', ' order by rn)
    || case when n > 5 then ', and ' || (n - 5) || ' more' else '' end as message
from ranked r join counts c on c.batch = r.batch where rn <= 5 group by r.batch, n""")
def failure_digest(spark, folder):
    """Failed files per batch, the first five by name."""
    even = F.col("event_id") % 2 == 0
    failures = table(spark, folder, "events").where(F.col("event_type") == "error").select(
        (F.col("user_id") % 10).alias("batch"),
        F.col("event_id").alias("position"),
        F.concat(F.lit("u"), "event_id").alias("url"),
        F.when(even, 500).alias("status"),
        F.when(~even, "timeout").alias("error"),
    )
    return runs.failure_digest(failures)


@query("""select cast(count(distinct user_id) as bigint) as symbols,
  cast(count(distinct user_id || '-' || cast(ts as date)) filter (user_id % 2 = 0) as bigint) as zip_files,
  cast(count(distinct user_id || '-' || cast(ts as date)) as bigint) as csv_files from events""")
def load_summary(spark, folder):
    """Symbols, archives and files of a load with one file per user and day."""
    day = F.date_format("ts", "yyyy-MM-dd")
    ending = F.when(F.col("user_id") % 2 == 0, ".zip").otherwise(".csv")
    files = table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("symbol"),
        F.concat_ws("", F.concat_ws("/", "user_id", day), ending).alias("path"),
        F.when(F.col("user_id") % 2 == 0, "inside.csv").alias("member"),
    )
    return runs.load_summary(files)


@query("""select o_orderkey, o_custkey as account_id, o_orderpriority as symbol, o_totalprice
from orders where o_orderpriority = '1-URGENT'""")
def order_blotter(spark, folder):
    """Orders with one symbol, all accounts."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("account_id"), F.col("o_orderpriority").alias("symbol"), "o_totalprice"
    )
    return runs.order_blotter(orders, symbol="1-urgent")


@query("""select o_orderkey, o_custkey as account_id, o_orderpriority as symbol, o_totalprice
from orders where o_custkey = 7""")
def account_blotter(spark, folder):
    """Orders of one account, all symbols."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("account_id"), F.col("o_orderpriority").alias("symbol"), "o_totalprice"
    )
    return runs.order_blotter(orders, account_id=7)


@query(f"""with {GAPS_SQL}
select strftime(d, '%Y-%m-%d') as day from missing where symbol = 'U7'""")
def sql_missing_days(spark, folder):
    """Days of one series without a bar, by the SQL function."""
    user_days(spark, folder).createOrReplaceTempView("barline_days")
    register_gap_function(spark, "barline_days")
    return spark.sql(
        f"select date_format(d, 'yyyy-MM-dd') as day from missing_days('U7', '1d', date'{GAP_START}', date'{GAP_END}')"
    )


@query(f"""with {GAPS_SQL}
select symbol, '1d' as "interval", strftime(d, '%Y-%m-%d') as day from missing
union all select 'NOBODY', '1d', strftime(d, '%Y-%m-%d') from calendar""")
def sql_missing_days_of_many(spark, folder):
    """Days without a bar of a list of series, one of which has none, by the SQL function in a lateral join."""
    user_days(spark, folder).createOrReplaceTempView("barline_days")
    nobody = spark.range(1).select(F.lit("NOBODY").alias("symbol"), F.lit("1d").alias("interval"))
    users(spark, folder).unionByName(nobody).createOrReplaceTempView("barline_wanted")
    register_gap_function(spark, "barline_days")
    return spark.sql(f"""select w.symbol, w.interval, date_format(m.d, 'yyyy-MM-dd') as day
        from barline_wanted w, lateral missing_days(w.symbol, w.interval, date'{GAP_START}', date'{GAP_END}') m""")


RANGES_FROM, RANGES_TO = "2023-12-31", "2024-02-02"


@query(f"""with {candles_sql("15m", "1h", "1w", "1M")},
wanted as (select distinct symbol, iv as "interval" from candles cross join (values ('15m'), ('1h'), ('1w'), ('1M'), ('3m')) w(iv)),
ticked as (
  select '15m' as "interval", g as t, row_number() over (order by g) as i from generate_series(timestamp '{RANGES_FROM}', timestamp '{RANGES_TO}' + interval 1 day - interval 1 second, interval 15 minute) s(g)
  union all select '3m', g, row_number() over (order by g) from generate_series(timestamp '{RANGES_FROM}', timestamp '{RANGES_TO}' + interval 1 day - interval 1 second, interval 3 minute) s(g)
  union all select '1h', g, row_number() over (order by g) from generate_series(timestamp '{RANGES_FROM}', timestamp '{RANGES_TO}' + interval 1 day - interval 1 second, interval 1 hour) s(g)
  union all select '1w', g, row_number() over (order by g) from generate_series(timestamp '2024-01-01', timestamp '{RANGES_TO}', interval 7 day) s(g)
  union all select '1M', g, row_number() over (order by g) from generate_series(timestamp '2024-01-01', timestamp '{RANGES_TO}', interval 1 month) s(g)),
lost as (
  select symbol, "interval", t, i, i - row_number() over (partition by symbol, "interval" order by i) as island
  from wanted join ticked using ("interval")
  where not exists (select 1 from candles c where c.symbol = wanted.symbol and c."interval" = wanted."interval" and c.open_time = t))
select symbol, "interval", cast(epoch_us(min(t)) // 1000000 as bigint) as first_time, cast(epoch_us(max(t)) // 1000000 as bigint) as last_time,
  cast(count(*) as bigint) as bars
from lost group by symbol, "interval", island""")
def missing_ranges(spark, folder):
    """Stretches of missing bars within days, weeks and months; one interval is not there at all."""
    bars = candles(spark, folder, "15m", "1h", "1w", "1M")
    wanted = bars.select("symbol").distinct().selectExpr("symbol", "explode(array('15m', '1h', '1w', '1M', '3m')) as interval")
    rows = gaps.missing_ranges(bars, wanted, RANGES_FROM, RANGES_TO, chunk_bars=500)
    return rows.select("symbol", "interval", epoch_seconds("first_open").alias("first_time"), epoch_seconds("last_open").alias("last_time"), "bars")
