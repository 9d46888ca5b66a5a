"""A backfill run as tables: which symbols, in which batches, which files, and its record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.operators.gaps import not_landed, planned_files
from barline.operators.runs import batch_status, plan_counts
from barline.operators.universe import configured_universe, ranked, tradable_symbols, with_batch
from barline.schemas import Backfill


def resolve_symbols(
    spark: SparkSession,
    job: Backfill,
    universe: DataFrame | None = None,
    cross: DataFrame | None = None,
    isolated: DataFrame | None = None,
    borrowable: DataFrame | None = None,
    limit_symbols: int | None = None,
) -> DataFrame:
    """The run's symbols with their `place` and `batch`.

    A symbol list keeps its order and is not filtered; a filtered universe goes by name. Filters that
    need a margin list fail without it.
    """
    wanted = job.universe
    if wanted is None:
        listed = spark.createDataFrame(list(enumerate(job.symbols)), "place bigint, symbol string")
        placed = configured_universe(listed)
    else:
        if universe is None:
            raise ValueError("a universe filter needs a universe")
        if wanted.margin in ("isolated", "any") and isolated is None:
            raise ValueError("margin isolated/any needs the isolated margin pairs")
        if wanted.borrowable and borrowable is None:
            raise ValueError("borrowable needs the margin assets")
        rows = tradable_symbols(
            universe, wanted.quote_asset, wanted.market_orders, wanted.margin, cross, isolated, borrowable, wanted.borrowable
        )
        placed = ranked(rows)
    if limit_symbols is not None:
        placed = placed.where(F.col("place") < limit_symbols)
    return with_batch(placed, job.batch_size, place="place")


def all_files(job: Backfill, candles: DataFrame, symbols: DataFrame, base_url: str) -> DataFrame:
    """The files that would fill the symbols' gaps, landed or not."""
    series = symbols.select("symbol", F.lit(job.interval).alias("interval"))
    return planned_files(candles, series, str(job.first_day), str(job.last_day), job.freq, base_url)


def plan_files(
    job: Backfill,
    candles: DataFrame,
    symbols: DataFrame,
    base_url: str,
    landed: DataFrame | None = None,
    force: bool = False,
) -> DataFrame:
    """Files to fetch: those for the symbols' gaps, less those in a listing (`path`) of landed files unless forced."""
    planned = all_files(job, candles, symbols, base_url)
    if landed is None:
        landed = planned.sparkSession.createDataFrame([], "path string")
    return not_landed(planned, landed, job.destination, force)


def dry_run(files: DataFrame, symbols: DataFrame) -> DataFrame:
    """Batch rows of a run that only counts: give it `all_files`, as planned files count before landed ones go."""
    return batch_status(plan_counts(files, symbols), dry_run=True)


def run_batches(batches: DataFrame, inserted: DataFrame | None = None) -> DataFrame:
    """The batch rows of a run, each with the number of files it loaded.

    `batches` has url_count, failed and status by batch; `inserted` (batch, path) names the files, and stays a table
    of its own: a run over an exchange has millions.
    """
    if inserted is None:
        return batches.withColumn("inserted", F.lit(0).cast("bigint"))
    files = inserted.groupBy("batch").agg(F.count(F.lit(1)).alias("inserted"))
    return batches.join(files, "batch", "left").withColumn("inserted", F.coalesce("inserted", F.lit(0).cast("bigint")))


def run_record(job: Backfill, symbols: DataFrame, batches: DataFrame, inserted: DataFrame | None = None) -> DataFrame:
    """One row about a run: what was asked, how many symbols it had, its totals and its status.

    The batches and the files they loaded are tables of their own, `run_batches` and `inserted`; here are their numbers.
    """
    wanted = job.universe
    asked = {
        "interval": job.interval,
        "first_day": str(job.first_day),
        "last_day": str(job.last_day),
        "freq": job.freq,
        "source": "universe" if wanted else "symbols",
        "quote_asset": wanted.quote_asset if wanted else None,
        "market_orders": wanted.market_orders if wanted else False,
        "margin": wanted.margin if wanted else "none",
        "borrowable": wanted.borrowable if wanted else None,
    }
    rows, status = run_batches(batches, inserted), F.col("status")
    total = rows.agg(
        F.sum("url_count").alias("url_count"),
        (F.sum("failed") if "failed" in rows.columns else F.lit(0).cast("bigint")).alias("failed"),
        F.when(F.count_if(status == "failed") > 0, "failed")
        .when(F.count_if(status == "complete_with_errors") > 0, "complete_with_errors")
        .otherwise(F.min(status))
        .alias("status"),
        F.count(F.lit(1)).alias("batches"),
        F.sum("inserted").alias("inserted"),
    )
    count = symbols.agg(F.count(F.lit(1)).alias("symbol_count"))
    one = F.lit(1)
    record = total.withColumn("_one", one).join(count.withColumn("_one", one), "_one").drop("_one")
    given = [F.lit(v).cast("boolean" if isinstance(v, bool) else "string").alias(k) for k, v in asked.items()]
    return record.select(*given, "symbol_count", "url_count", "failed", "status", "batches", "inserted")
