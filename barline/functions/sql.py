"""The two SQL functions, for users who write SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from barline.functions.time import EPOCH, MICROS_FROM, MILLIS_FROM


def register_time_function(spark: SparkSession) -> None:
    """time_in_second(t): UTC time of a raw epoch in milli- or microseconds."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION time_in_second(t BIGINT) RETURNS TIMESTAMP_NTZ
        RETURN CASE WHEN t >= {MICROS_FROM} THEN timestampadd(MICROSECOND, t, {EPOCH})
                    WHEN t >= {MILLIS_FROM} THEN timestampadd(MILLISECOND, t, {EPOCH}) END
    """)


def register_gap_function(spark: SparkSession, candle_view: str) -> None:
    """missing_days(sym, iv, start_d, end_d): days of a series without a bar in a view.

    Also of many at once: `FROM wanted w, LATERAL missing_days(w.symbol, w.interval, ...)` becomes one aggregation of
    the view, to a set of days for each series, and a join with the list.
    """
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION
            missing_days(sym STRING, iv STRING, start_d DATE, end_d DATE)
        RETURNS TABLE (d DATE)
        RETURN SELECT explode(array_except(sequence(start_d, end_d, INTERVAL 1 DAY), coalesce(a.days, array()))) AS d
               FROM (SELECT collect_set(to_date(open_time)) AS days FROM {candle_view}
                     WHERE symbol = sym AND interval = iv) a
    """)
