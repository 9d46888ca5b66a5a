"""Queries on the symbol universe."""

from __future__ import annotations

from pyspark.sql import functions as F

from barline.functions.text import QUOTE_SUFFIXES, clean_symbol, split_symbol
from barline.operators import universe as u
from barline.operators.backfill import resolve_symbols
from barline.plans import query
from barline.plans.adapters import (
    UNIVERSE_SQL,
    borrowable_assets,
    margin_symbols,
    requested,
    table,
    universe,
)
from barline.schemas import Backfill, UniverseFilter


def _lists(spark, folder):
    return {"cross": margin_symbols(spark, folder, 11), "isolated": margin_symbols(spark, folder, 6)}


@query(f"""with {UNIVERSE_SQL}
select symbol, status, base_asset, quote_asset from flagged
where status = 'TRADING' and quote_asset = 'ECONOMY' and takes_market and (is_cross or is_isolated) and base_ok""")
def tradable_symbols(spark, folder):
    """Symbols that pass the status, quote, order-type, margin and borrowability filters together."""
    rows = u.tradable_symbols(
        universe(spark, folder), "economy", True, "any", **_lists(spark, folder),
        borrowable=borrowable_assets(spark, folder), require_borrowable="base",
    )
    return rows.select("symbol", "status", "base_asset", "quote_asset")


@query(f"""with {UNIVERSE_SQL}
select symbol, is_cross as cross_ok, is_isolated as isolated_ok, is_cross or is_isolated as any_ok from flagged""")
def margin_filter(spark, folder):
    """The three margin rules for every symbol."""
    rows = u.with_margin(universe(spark, folder), **_lists(spark, folder))
    return rows.select("symbol", *[u.margin_rule(mode).alias(f"{mode}_ok") for mode in ("cross", "isolated", "any")])


@query(f"""with {UNIVERSE_SQL}
select symbol, base_ok, quote_ok, base_ok and quote_ok as both_ok, base_ok or quote_ok as any_ok from flagged""")
def borrowable_filter(spark, folder):
    """The four borrowability rules for every symbol."""
    rows = u.with_borrowable(universe(spark, folder), borrowable_assets(spark, folder))
    return rows.select("symbol", *[u.borrowable_rule(mode).alias(f"{mode}_ok") for mode in ("base", "quote", "both", "any")])


CHECK_SQL = f"""{UNIVERSE_SQL},
checked as (
  select r.symbol, r.place, f.status, f.base_asset, f.quote_asset,
    case when f.symbol is null then 'missing' when f.status <> 'TRADING' then 'not_trading'
         when f.is_cross and (f.base_ok or f.quote_ok) then 'tradable' else 'filtered_out' end as verdict
  from requested r left join flagged f on f.symbol = r.symbol)"""


def _checked(spark, folder):
    return u.check_symbols(
        requested(spark, folder), universe(spark, folder), "cross", **_lists(spark, folder),
        borrowable=borrowable_assets(spark, folder), require_borrowable="any",
    )


@query(f"with {CHECK_SQL} select * from checked")
def check_symbols(spark, folder):
    """A verdict for every requested symbol."""
    return _checked(spark, folder)


@query(f"with {CHECK_SQL} select verdict, cast(count(*) as bigint) as symbols from checked group by 1")
def verdict_counts(spark, folder):
    return u.verdict_counts(_checked(spark, folder))


@query(f"""with {UNIVERSE_SQL}
select symbol, cast((row_number() over (order by symbol) - 1) // 25 as bigint) as batch
from universe where status = 'TRADING'""")
def symbol_batches(spark, folder):
    """Trading symbols in batches of 25 by name."""
    return u.with_batch(u.tradable_symbols(universe(spark, folder))).select("symbol", "batch")


@query(f"""with {UNIVERSE_SQL}
select symbol, 'CONFIGURED' as status, '' as base_asset, '' as quote_asset, '' as order_types, '' as permissions,
  false as is_margin_trading_allowed, place from requested""")
def configured_universe(spark, folder):
    """Universe rows of a plain symbol list."""
    rows = u.configured_universe(requested(spark, folder)).drop("position")
    return rows.withColumns({c: F.array_join(c, ",") for c in ("order_types", "permissions")})


@query(f"""with {UNIVERSE_SQL}
select cast(count(*) filter (status = 'TRADING' and takes_market) as bigint) as symbols, 'tradable' as source,
  cast(count(*) as bigint) as total_exchange_symbols from universe""")
def resolution_stats(spark, folder):
    rows = universe(spark, folder)
    return u.resolution_stats(u.tradable_symbols(rows, require_market_order=True), rows)


@query(f"""with {UNIVERSE_SQL}
select symbol || ',' || base_asset || ',' || quote_asset || ',' || status as value
from universe where status = 'TRADING'""")
def universe_listing(spark, folder):
    return u.universe_listing(u.tradable_symbols(universe(spark, folder)))


SUFFIX_SQL = "case event_id % 8 " + " ".join(f"when {k} then '{q}'" for k, q in enumerate(QUOTE_SUFFIXES)) + " else '' end"


def _pair_names(spark, folder):
    """Symbols that end in every known quote asset, or in none, with some characters that no symbol has."""
    k = (F.col("event_id") % 8).cast("int")
    quotes = F.array(*[F.lit(q) for q in [*QUOTE_SUFFIXES, "", ""]])
    odd = F.when(F.col("event_id") % 11 == 0, "/").otherwise("")
    rows = table(spark, folder, "events")
    return rows.select("event_id", F.concat("event_type", odd, F.element_at(quotes, k + 1)).alias("name"))


@query(f"""with named as (
  select event_id, event_type || case when event_id % 11 = 0 then '/' else '' end || {SUFFIX_SQL} as name, {SUFFIX_SQL} as quote
  from events)
select event_id, case when event_id % 11 <> 0 then upper(name) end as symbol,
  upper(substr(name, 1, length(name) - length(quote))) as base_asset, quote as quote_asset from named""")
def split_symbols(spark, folder):
    """Clean symbols, and the two assets that a symbol's name ends tell apart."""
    rows = _pair_names(spark, folder).withColumn("upper", F.upper("name"))
    base, quote = split_symbol("upper")
    return rows.select("event_id", clean_symbol("name").alias("symbol"), base.alias("base_asset"), quote.alias("quote_asset"))


@query(f"""with {UNIVERSE_SQL},
placed as (select symbol, row_number() over (order by symbol) - 1 as place from universe where status = 'TRADING' and takes_market)
select symbol, cast(place as bigint) as place, cast(place // 25 as bigint) as batch from placed where place < 60""")
def limited_symbols(spark, folder):
    """The first symbols of a run over the filtered universe, with their batches."""
    job = Backfill("1d", "2024-01-01", "2024-01-31", "/landing", universe=UniverseFilter(market_orders=True))
    rows = resolve_symbols(spark, job, universe(spark, folder), limit_symbols=60)
    return rows.select("symbol", "place", "batch")
