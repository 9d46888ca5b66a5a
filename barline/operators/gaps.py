"""Missing days and months of many series in one job, and the files that would fill them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barline.functions.text import object_key, url_to_path
from barline.functions.time import bar_number, bar_start
from barline.operators.chunks import CHUNK_BARS
from barline.schemas import FREQUENCIES, SERIES, check_choice


def actual_days(df: DataFrame, start, end, offset_seconds=0, min_bars=1) -> DataFrame:
    """Days on which a series has a bar.

    `offset_seconds` shifts the day boundary away from UTC; `min_bars` asks for fuller days.
    Only bars of the range are read.
    """
    local = F.col("open_time")
    if offset_seconds:
        local = F.timestamp_add("SECOND", F.lit(offset_seconds), local)
    day = F.to_date(local)
    days = df.select(*SERIES, day.alias("day"), "open_time").where(_near(start, end, offset_seconds))
    days = days.where(F.col("day").between(_date(start), _date(end)))
    if min_bars <= 1:
        return days.select(*SERIES, "day").distinct()
    return days.groupBy(*SERIES, "day").count().where(F.col("count") >= min_bars).drop("count")


def _near(start, end, offset_seconds):
    """The range on the stored column itself, which a scan can use."""
    low = F.expr(f"timestamp_ntz'{start} 00:00:00'")
    high = F.timestamp_add("DAY", F.lit(1), F.expr(f"timestamp_ntz'{end} 00:00:00'"))
    if offset_seconds:
        low = F.timestamp_add("SECOND", F.lit(-offset_seconds), low)
        high = F.timestamp_add("SECOND", F.lit(-offset_seconds), high)
    return (F.col("open_time") >= low) & (F.col("open_time") < high)


def _date(day):
    return F.lit(str(day)).cast("date")


def expected_days(series: DataFrame, start, end) -> DataFrame:
    """Every day of the range, both ends included, for every requested series."""
    calendar = F.sequence(_date(start), _date(end), F.expr("interval 1 day"))
    return series.select(*SERIES).distinct().select(*SERIES, F.explode(calendar).alias("day"))


def missing_days(df: DataFrame, series: DataFrame, start, end, offset_seconds=0, min_bars=1) -> DataFrame:
    """Days of the range on which a requested series has no bar.

    The calendar is daily for every interval, so bars longer than a day always show gaps.
    """
    actual = actual_days(df, start, end, offset_seconds, min_bars)
    return expected_days(series, start, end).join(actual, [*SERIES, "day"], "left_anti")


def missing_months(df: DataFrame, series: DataFrame, start, end, offset_seconds=0) -> DataFrame:
    """Calendar months of which every day is missing; months only partly in range never are."""
    month = F.trunc("day", "month")
    days = missing_days(df, series, start, end, offset_seconds)
    return (
        days.groupBy(*SERIES, month.cast("date").alias("day"))
        .agg(F.count(F.lit(1)).alias("days"))
        .where(F.col("days") == F.day(F.last_day("day")))
    )


def missing_ranges(df: DataFrame, series: DataFrame, start, end, chunk_bars: int = CHUNK_BARS) -> DataFrame:
    """(series, first_open, last_open, bars): the stretches of bars that a requested series lacks, at its own interval.

    Counted are the bars that open on the days of the range, both ends included. Bars have numbers, so a gap is
    a difference between neighbours. Neighbours meet inside a chunk of numbers; between chunks the first and last numbers
    of each do, and the range's ends stand for the chunks that are not there. A series without bars lacks
    all of them, an unknown interval is left out.
    """
    low, high = (F.lit(f"{day} 00:00:00").cast("timestamp_ntz") for day in (start, end))
    wanted = series.select(*SERIES).distinct().withColumns({"low": low, "high": F.timestamp_add("DAY", F.lit(1), high)})
    # The range's bars are lo .. hi: the first that opens in it, and the last before its end.
    before = [bar_number(f"timestampadd(MICROSECOND, -1, {side})") for side in ("low", "high")]
    wanted = wanted.select(*SERIES, (before[0] + 1).alias("lo"), before[1].alias("hi")).where("lo <= hi")
    rows = df.select(*SERIES, "open_time").where(_near(start, end, 0)).select(*SERIES, bar_number("open_time").alias("n"))
    rows = rows.where("n is not null").withColumn("chunk", F.floor(F.col("n") / chunk_bars)).distinct()
    previous = F.lag("n").over(W.partitionBy(*SERIES, "chunk").orderBy("n"))
    inside = rows.join(wanted.select(*SERIES), SERIES, "left_semi").withColumn("previous", previous)
    inside = inside.where("n - previous > 1").selectExpr(*SERIES, "previous + 1 as a", "n - 1 as z")
    chunks = rows.groupBy(*SERIES, "chunk").agg(F.min("n").alias("first"), F.max("n").alias("last"))
    # One row more per series stands for the range's end.
    ends = wanted.selectExpr(*SERIES, "hi + 1 as first", "hi + 1 as last", "lo")
    chunks = chunks.join(wanted.select(*SERIES, "lo"), SERIES).select(*ends.columns).unionByName(ends)
    by_place = W.partitionBy(*SERIES).orderBy("first")
    chunks = chunks.withColumn("previous", F.coalesce(F.lag("last").over(by_place), F.col("lo") - 1))
    between = chunks.where("first - previous > 1").selectExpr(*SERIES, "previous + 1 as a", "first - 1 as z")
    found = inside.unionByName(between)
    return found.select(*SERIES, bar_start("a").alias("first_open"), bar_start("z").alias("last_open"), F.expr("z - a + 1 as bars"))


def file_keys(gaps: DataFrame, freq: str, base_url: str) -> DataFrame:
    """Adds the address of the archive that would fill a gap; `day` names the day or the month."""
    check_choice("freq", freq, FREQUENCIES)
    return gaps.withColumn("url", object_key(base_url, freq))


def planned_files(df, series, start, end, freq: str, base_url: str) -> DataFrame:
    """Gaps of the given frequency with their file addresses."""
    check_choice("freq", freq, FREQUENCIES)
    find = missing_months if freq == "monthly" else missing_days
    return file_keys(find(df, series, start, end), freq, base_url).select(*SERIES, "day", "url")


def not_landed(planned: DataFrame, landed: DataFrame, destination: str, force: bool = False) -> DataFrame:
    """Planned files whose landing path is not in the listing (`path`); all of them if forced."""
    planned = planned.withColumn("path", url_to_path("url", destination))
    return planned if force else planned.join(landed.select("path"), "path", "left_anti")


def with_landed(planned: DataFrame, landed: DataFrame, destination: str) -> DataFrame:
    """Planned files with their landing path, and whether the listing (`path`) has it: a forced run takes all, others the rest."""
    listed = landed.select("path").distinct().withColumn("landed", F.lit(True))
    rows = planned.withColumn("path", url_to_path("url", destination)).join(listed, "path", "left")
    return rows.withColumn("landed", F.coalesce("landed", F.lit(False)))
