"""Checks that stand in for the constraints of the candle table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.functions.text import is_interval
from barline.schemas import CANDLE, KEY


def _any_null():
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in CANDLE.fieldNames()])


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with every column present, the others). A raw epoch that is too small ends up NULL."""
    return df.where(~_any_null()), df.where(_any_null())


def require_valid(df: DataFrame) -> DataFrame:
    """The same rows, but a NULL anywhere fails the job, as a NOT NULL column would."""
    message = F.concat_ws(" ", F.lit("a required column is NULL:"), *[F.col(c).cast("string") for c in KEY])
    return df.where(F.when(_any_null(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def duplicate_keys(df: DataFrame) -> DataFrame:
    return df.groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def quality_report(df: DataFrame) -> DataFrame:
    """Per interval: rows, rows with a NULL, extra rows of repeated keys; and if the interval is known."""
    keyed = df.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(_any_null().cast("bigint")).alias("with_null")
    )
    return (
        keyed.groupBy("interval")
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("with_null").alias("with_null"),
            F.sum(F.col("rows") - 1).alias("repeated"),
        )
        .withColumn("known_interval", is_interval())
    )
