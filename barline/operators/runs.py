"""Tables about backfill runs: fetch outcomes, batch plans and summaries, orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Outcome classes of a file, and the attempts made after the first.
OUTCOMES = ["downloaded", "skipped", "missing_remote", "failed"]
RETRIES = 2
DIGEST_SIZE = 5


def outcome_counts(log: DataFrame, by: str = "batch") -> DataFrame:
    """Files per outcome class and batch from (batch, result, ok); other results count by `ok`."""
    outcome = F.when(F.col("result").isin(OUTCOMES), F.col("result")).otherwise(
        F.when(F.col("ok"), "downloaded").otherwise("failed")
    )
    return (
        log.select(by, outcome.alias("outcome"))
        .groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("url_count"),
            *[F.count_if(F.col("outcome") == name).alias(name) for name in OUTCOMES],
        )
    )


def run_totals(batches: DataFrame) -> DataFrame:
    return batches.agg(
        F.coalesce(F.sum("url_count"), F.lit(0)).cast("bigint").alias("url_count"),
        F.coalesce(F.sum("failed"), F.lit(0)).cast("bigint").alias("failed"),
    )


def batch_status(batches: DataFrame, continue_on_error: bool = False, dry_run: bool = False) -> DataFrame:
    """Adds the status label that a batch's failure count leads to."""
    if dry_run:
        return batches.withColumn("status", F.lit("dry_run"))
    broken = "complete_with_errors" if continue_on_error else "failed"
    return batches.withColumn("status", F.when(F.col("failed") > 0, broken).otherwise("complete"))


def outcome_from_attempts(
    attempts: DataFrame, expected_missing=(), retries: int = RETRIES, landed: DataFrame | None = None
) -> DataFrame:
    """Outcome per file from its attempts (url, attempt from 1, status, error).

    The first answer of 200 or of an expected-missing status decides, else the last of at most
    retries + 1 attempts. An attempt without a status leaves the status seen before it. Files
    in `landed` (url) were never tried and are skipped.
    """
    fine = (F.col("status") == 200) & F.col("error").isNull()
    absent = F.col("status").isin([int(s) for s in expected_missing]) & (F.col("status") != 200)
    tried = attempts.where(F.col("attempt") <= retries + 1).select(
        "url",
        "attempt",
        "status",
        F.coalesce("error", F.when(F.col("status") != 200, F.concat(F.lit("HTTP "), "status"))).alias("error"),
        F.when(fine | absent, F.col("attempt")).alias("final"),
    )
    known = F.when(F.col("status").isNotNull(), F.col("attempt"))
    last = tried.groupBy("url").agg(
        F.min("final").alias("final"),
        F.min_by("status", "final").alias("final_status"),
        F.max_by("status", known).alias("last_status"),
        F.min_by("error", "final").alias("final_error"),
        F.max_by("error", "attempt").alias("last_error"),
    )
    decided = F.col("final").isNotNull()
    outcome = last.select(
        "url",
        F.when(decided, F.col("final_status")).otherwise(F.col("last_status")).alias("status"),
        decided.alias("ok"),
        F.when(decided, F.col("final_error")).otherwise(F.col("last_error")).alias("error"),
        F.when(~decided, "failed")
        .when(F.col("final_status") == 200, "downloaded")
        .otherwise("missing_remote")
        .alias("result"),
    )
    if landed is None:
        return outcome
    skipped = landed.select("url").distinct().select(
        "url",
        F.lit(None).cast(outcome.schema["status"].dataType).alias("status"),
        F.lit(True).alias("ok"),
        F.lit(None).cast("string").alias("error"),
        F.lit("skipped").alias("result"),
    )
    return outcome.join(landed, "url", "left_anti").unionByName(skipped)


def failure_digest(failures: DataFrame, n: int = DIGEST_SIZE, by: str = "batch") -> DataFrame:
    """Per batch: the number of failed files and a message that names the first n.

    `failures` has (batch, position, url, status, error). Only n rows per batch and task are
    kept before the shuffle; the count is a plain aggregation.
    """
    reason = F.coalesce(F.when(F.col("status") != 0, F.col("status").cast("string")), F.col("error"))
    named = failures.select(by, "position", F.format_string("%s (%s)", "url", reason).alias("text"))
    first = W.partitionBy(by).orderBy("position", "text")
    top = (
        named.withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= n)
        .groupBy(by)
        .agg(F.array_sort(F.collect_list(F.struct("place", "text"))).alias("top"))
    )
    counts = failures.groupBy(by).agg(F.count(F.lit(1)).alias("failed"))
    more = F.when(F.col("failed") > n, F.format_string(", and %d more", F.col("failed") - n)).otherwise("")
    message = F.concat(
        F.col("failed").cast("string"),
        F.lit(" download(s) failed: "),
        F.array_join(F.col("top.text"), ", "),
        more,
    )
    return counts.join(top, by).select(by, "failed", message.alias("message"))


def plan_counts(keys: DataFrame, batches: DataFrame) -> DataFrame:
    """Planned files per batch, also for batches without any; `batches` has (symbol, batch).

    Files are counted per symbol before they meet the batch list.
    """
    per_symbol = keys.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    return (
        batches.select("symbol", "batch")
        .join(per_symbol, "symbol", "left")
        .groupBy("batch")
        .agg(F.count(F.lit(1)).alias("symbols"), F.coalesce(F.sum("n"), F.lit(0)).alias("url_count"))
    )


def load_summary(files: DataFrame) -> DataFrame:
    """Symbols, archives and CSV files of a load, from the (symbol, path, member) of its rows."""
    distinct = files.select("symbol", "path", "member").distinct()
    archives = distinct.select("symbol", "path", F.col("path").endswith(".zip").alias("zipped"))
    per_path = archives.groupBy("path").agg(
        F.min("symbol").alias("symbol"), F.max("zipped").alias("zipped"), F.count(F.lit(1)).alias("csv")
    )
    per_symbol = per_path.groupBy("symbol").agg(
        F.count_if("zipped").alias("zip_files"), F.sum("csv").alias("csv_files")
    )
    return per_symbol.agg(
        F.count(F.lit(1)).alias("symbols"),
        F.coalesce(F.sum("zip_files"), F.lit(0)).alias("zip_files"),
        F.coalesce(F.sum("csv_files"), F.lit(0)).alias("csv_files"),
    )


def order_blotter(orders: DataFrame, account_id=None, symbol: str | None = None) -> DataFrame:
    """Orders of an account and/or a symbol."""
    if account_id is not None:
        orders = orders.where(F.col("account_id") == account_id)
    return orders if symbol is None else orders.where(F.col("symbol") == symbol.upper())
