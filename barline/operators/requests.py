"""Checks of many candle requests at once, by the rules that the functions apply to their own arguments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.functions.text import clean_symbol, is_interval
from barline.schemas import MAX_LENGTH, ORDERS


def problem() -> Column:
    """The first argument of a request that breaks its rule, NULL if all keep to theirs.

    A request has symbol, interval, from, to, limit, length and order; a missing bound, limit or order is allowed.
    """
    given = [
        ("symbol", clean_symbol("symbol").isNull()),
        ("interval", ~is_interval()),
        ("range", F.col("from") >= F.col("to")),
        ("limit", F.col("limit") < 1),
        ("length", ~F.col("length").between(1, MAX_LENGTH)),
        ("order", ~F.col("order").isin(ORDERS)),
    ]
    return F.coalesce(*[F.when(broken, name) for name, broken in given])


def checked(requests: DataFrame) -> DataFrame:
    return requests.withColumn("problem", problem())
