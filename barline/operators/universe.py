"""Screening of a symbol universe by status, quote asset, order type, margin and borrowability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barline.schemas import BATCH_SIZE, BORROWABLE_MODES, MARGIN_MODES, check_choice

# How many ways the symbols of one asset are spread when they meet the list of assets: a
# popular quote asset is shared by a large part of the universe.
SPREAD = 16

# Lengths of the beginnings by which symbols are ranked. There are at most some thousands of the first.
PREFIXES = (2, 6, 12)


def configured_universe(requested: DataFrame) -> DataFrame:
    """Universe rows for a plain list of symbols (column `symbol`, any other column is kept)."""
    fixed = {
        "symbol": F.upper("symbol"),
        "status": F.lit("CONFIGURED"),
        "base_asset": F.lit(""),
        "quote_asset": F.lit(""),
        "order_types": F.array().cast("array<string>"),
        "permissions": F.array().cast("array<string>"),
        "is_margin_trading_allowed": F.lit(False),
    }
    if "position" not in requested.columns:
        fixed["position"] = F.lit(None).cast("bigint")
    return requested.withColumns(fixed)


def eligible_keys(df: DataFrame, key: str, flag: str) -> DataFrame:
    """Distinct keys of margin pairs or margin assets whose flag is set."""
    return df.where(F.col(flag) & (F.col(key) != "")).select(key).distinct()


def _mark(df: DataFrame, key: str, members: DataFrame | None, name: str, spread_by: str | None = None):
    """Adds a flag that says whether `key` is in the one-column `members`; no members, no match.

    With `spread_by`, rows that share a key are spread by that column over SPREAD copies of
    the member list, so a popular key does not end up in one task.
    """
    if members is None:
        return df.withColumn(name, F.lit(False))
    listed = members.toDF("_member").distinct().withColumn(name, F.lit(True))
    if spread_by is None:
        marked = df.join(listed, F.col(key) == F.col("_member"), "left")
    else:
        slots = F.sequence(F.lit(0).cast("bigint"), F.lit(SPREAD - 1).cast("bigint"))
        listed = listed.withColumn("_copy", F.explode(slots))
        df = df.withColumn("_slot", F.pmod(F.xxhash64(spread_by), F.lit(SPREAD)))
        marked = df.join(listed, (F.upper(key) == F.col("_member")) & (F.col("_slot") == F.col("_copy")), "left")
    return marked.withColumn(name, F.coalesce(name, F.lit(False))).drop("_member", "_slot", "_copy")


def with_margin(df: DataFrame, cross: DataFrame | None = None, isolated: DataFrame | None = None) -> DataFrame:
    """Adds the flags `on_cross` and `on_isolated`, each list matched once."""
    df = _mark(_mark(df, "symbol", cross, "on_cross"), "symbol", isolated, "on_isolated")
    allowed = F.col("is_margin_trading_allowed") | F.array_contains("permissions", "MARGIN")
    return df.withColumn("on_cross", allowed | F.col("on_cross"))


def margin_rule(mode: str = "none") -> Column:
    """May the symbol be traded on cross margin, isolated margin, or either; of rows from `with_margin`."""
    check_choice("margin", mode, MARGIN_MODES)
    cross, isolated = F.col("on_cross"), F.col("on_isolated")
    return {"none": F.lit(True), "cross": cross, "isolated": isolated, "any": cross | isolated}[mode]


def with_borrowable(df: DataFrame, assets: DataFrame | None, sides=("base", "quote")) -> DataFrame:
    """Adds the flags `base_borrowable` and `quote_borrowable`: is the asset in the list."""
    for side in ("base", "quote"):
        listed = assets if side in sides else None
        df = _mark(df, f"{side}_asset", listed, f"{side}_borrowable", spread_by="symbol")
    return df


def borrowable_rule(mode: str | None = None) -> Column:
    """Can the base asset, the quote asset, both or any of them be borrowed; of rows from `with_borrowable`."""
    if mode is None:
        return F.lit(True)
    check_choice("require_borrowable", mode, BORROWABLE_MODES)
    base, quote = F.col("base_borrowable"), F.col("quote_borrowable")
    return {"base": base, "quote": quote, "both": base & quote, "any": base | quote}[mode]


_FLAGS = ["on_cross", "on_isolated", "base_borrowable", "quote_borrowable"]


def _marked(df, margin, cross, isolated, require, assets) -> DataFrame:
    """Rows with margin_ok and borrowable_ok; only the lists that the modes need are matched."""
    check_choice("margin", margin, MARGIN_MODES)
    df = with_margin(df, cross if margin in ("cross", "any") else None, isolated if margin in ("isolated", "any") else None)
    sides = ("base", "quote") if require in ("both", "any") else (require,)
    df = with_borrowable(df, assets, sides)
    return df.withColumns({"margin_ok": margin_rule(margin), "borrowable_ok": borrowable_rule(require)}).drop(*_FLAGS)


def margin_ok(df, margin="none", cross=None, isolated=None) -> DataFrame:
    """Adds margin_ok: may the symbol be traded on cross margin, isolated margin, or either."""
    return _marked(df, margin, cross, isolated, None, None).drop("borrowable_ok")


def borrowable_ok(df, require=None, assets=None) -> DataFrame:
    """Adds borrowable_ok: can the base asset, the quote asset, both or any of them be borrowed."""
    return _marked(df, "none", None, None, require, assets).drop("margin_ok")


def tradable_symbols(
    universe: DataFrame,
    quote_asset: str | None = None,
    require_market_order: bool = False,
    margin: str = "none",
    cross: DataFrame | None = None,
    isolated: DataFrame | None = None,
    borrowable: DataFrame | None = None,
    require_borrowable: str | None = None,
) -> DataFrame:
    """The trading symbols that pass every filter, sorted by name."""
    rows = universe.where(F.col("status") == "TRADING")
    if quote_asset:
        rows = rows.where(F.col("quote_asset") == quote_asset.upper())
    if require_market_order:
        rows = rows.where(F.array_contains("order_types", "MARKET"))
    rows = _marked(rows, margin, cross, isolated, require_borrowable, borrowable)
    return rows.where(F.col("margin_ok") & F.col("borrowable_ok")).drop("margin_ok", "borrowable_ok").orderBy("symbol")


def last_per_symbol(universe: DataFrame) -> DataFrame:
    """One row per symbol, the last by `position`, which tells the order of the exchange's list."""
    if "position" not in universe.columns:
        raise ValueError("the universe needs its position column")
    rest = [c for c in universe.columns if c not in ("symbol", "position")]
    return universe.groupBy("symbol").agg(*[F.max_by(c, "position").alias(c) for c in rest])


def check_symbols(
    requested: DataFrame,
    universe: DataFrame,
    margin: str = "none",
    cross: DataFrame | None = None,
    isolated: DataFrame | None = None,
    borrowable: DataFrame | None = None,
    require_borrowable: str | None = None,
) -> DataFrame:
    """Every requested symbol with a verdict: tradable, filtered_out, not_trading or missing.

    Repeated requests stay, and so do other columns of `requested`, such as its order.
    """
    known = _marked(last_per_symbol(universe), margin, cross, isolated, require_borrowable, borrowable)
    known = known.select("symbol", "status", "base_asset", "quote_asset", "margin_ok", "borrowable_ok")
    verdict = (
        F.when(F.col("status").isNull(), "missing")
        .when(F.col("status") != "TRADING", "not_trading")
        .when(F.col("margin_ok") & F.col("borrowable_ok"), "tradable")
        .otherwise("filtered_out")
    )
    rows = requested.withColumn("symbol", F.upper("symbol")).join(known, "symbol", "left")
    return rows.withColumn("verdict", verdict).drop("margin_ok", "borrowable_ok")


def verdict_counts(checked: DataFrame) -> DataFrame:
    return checked.groupBy("verdict").agg(F.count(F.lit(1)).alias("symbols"))


def resolution_stats(resolved: DataFrame, universe: DataFrame | None = None, source: str = "tradable") -> DataFrame:
    """Source, number of resolved symbols, and the universe's size (NULL for a configured list)."""
    sides = resolved.select(F.lit(1).alias("resolved"), F.lit(None).cast("int").alias("listed"))
    if universe is not None:
        sides = sides.unionAll(universe.select(F.lit(0).alias("resolved"), F.lit(1).alias("listed")))
    return sides.agg(
        F.coalesce(F.sum("resolved"), F.lit(0)).alias("symbols"),
        F.lit(source).alias("source"),
        F.sum("listed").alias("total_exchange_symbols"),
    )


def universe_listing(df: DataFrame) -> DataFrame:
    """One text line per symbol: symbol,base,quote,status."""
    return df.select(F.concat_ws(",", "symbol", "base_asset", "quote_asset", "status").alias("value"))


def ranked(symbols: DataFrame, prefixes: tuple[int, ...] = PREFIXES) -> DataFrame:
    """Adds `place`, the 0-based place of a symbol in name order.

    Symbols are counted by ever longer beginnings. A beginning's place is that of the shorter one it
    extends, plus the counts of its smaller siblings, so a window holds the siblings of one beginning only
    and a common beginning is split further, never ranked in one task.
    """
    levels = [F.substring("symbol", 1, n).alias(f"_p{n}") for n in prefixes]
    rows = symbols.select("*", *levels)
    names = [f"_p{n}" for n in prefixes]
    counts = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    found = None
    for k, name in enumerate(names):
        level = counts.groupBy(*names[: k + 1]).agg(F.sum("_n").alias("_n"))
        # The shortest beginnings have no parent; there are few of them, however many symbols.
        siblings = W.partitionBy(*names[:k]) if k else W.partitionBy()
        smaller = F.sum("_n").over(siblings.orderBy(name).rowsBetween(W.unboundedPreceding, W.currentRow - 1))
        level = level.select(*names[: k + 1], F.coalesce(smaller, F.lit(0)).alias("_smaller"))
        if found is not None:
            level = level.join(found, names[:k]).withColumn("_smaller", F.col("_smaller") + F.col("_before"))
        found = level.select(*names[: k + 1], F.col("_smaller").alias("_before"))
    inside = F.row_number().over(W.partitionBy(*names).orderBy("symbol"))
    placed = rows.join(found, names).withColumn("place", F.col("_before") + inside - 1)
    return placed.drop("_before", *names)


def with_batch(symbols: DataFrame, size: int = BATCH_SIZE, place: str | None = None) -> DataFrame:
    """Adds the number of the batch a symbol belongs to: in name order, or by a given 0-based place."""
    if size < 1:
        raise ValueError("a batch holds one symbol or more")
    rows = symbols if place else ranked(symbols)
    batched = rows.withColumn("batch", F.floor(F.col(place or "place") / size).cast("bigint"))
    return batched if place else batched.drop("place")


