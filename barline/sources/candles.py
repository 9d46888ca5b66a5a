"""The candle table: Parquet partitioned by interval and symbol, loaded without duplicates.

A load is meant to have one writer at a time: the check against stored keys and the append are
two steps, and plain Parquet has no transaction around them.
"""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barline.functions.text import is_interval
from barline.functions.time import epoch_seconds
from barline.operators.chunks import CHUNK_BARS, with_chunk
from barline.operators.quality import require_valid, split_valid
from barline.schemas import CANDLE, KEY, SERIES
from barline.sources.klines import read_klines, to_candles

EPOCH_COLUMN = "open_epoch"


def read_candles(spark: SparkSession, root: str) -> DataFrame:
    """The candle table, or an empty one of the same columns if nothing is stored yet.

    The schema is given, so that an interval like 1d is not taken for a number.
    """
    try:
        stored = spark.read.schema(CANDLE).parquet(root)
        return stored.select(*CANDLE.fieldNames())  # partition columns would come last
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CANDLE)


def keep_first(df: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """One row per key: the smallest by `tie_break`, then by the remaining columns.

    One aggregation over one read of the batch; copies of a key shrink before the shuffle, however many there are.
    """
    ranked = _ranked(df, tie_break)
    return df.groupBy(*KEY).agg(F.min(F.struct(*ranked)).alias("_row")).select(*KEY, "_row.*").select(*_kept(df, tie_break))


def _ranked(df: DataFrame, tie_break: list[str] | None) -> list[str]:
    rest = [c for c in df.columns if c not in KEY]
    lead = [c for c in (tie_break or []) if c in rest]
    return lead + [c for c in rest if c not in lead]


def _kept(df: DataFrame, tie_break: list[str] | None) -> list[str]:
    return [c for c in df.columns if c not in (tie_break or [])]


def insert_or_ignore(existing: DataFrame, new: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """New candles whose key is not stored yet, one per key. Stored rows always win."""
    fresh = keep_first(new, tie_break)
    return fresh.join(existing.select(*KEY), KEY, "left_anti").select(*CANDLE.fieldNames())


def write_candles(df: DataFrame, root: str, mode: str = "append", chunk_bars: int = CHUNK_BARS) -> None:
    """Writes candles in files of at most about `chunk_bars` bars of one series, sorted by time.

    Rows are spread by series and chunk, so a long series is written by many tasks and its
    files cover separate stretches of time.
    """
    _laid_out(df, chunk_bars).write.mode(mode).partitionBy("interval", "symbol").parquet(root)


def _laid_out(df: DataFrame, chunk_bars: int) -> DataFrame:
    """Rows as files take them. `open_epoch`, in seconds, is for the file footers: they keep no extremes of a zone-less time."""
    rows = with_chunk(df.select(*CANDLE.fieldNames()), chunk_bars).withColumn(EPOCH_COLUMN, epoch_seconds("open_time"))
    return rows.repartition(*SERIES, "chunk").sortWithinPartitions("interval", "symbol", "open_time").drop("chunk")


def save_bucketed(df: DataFrame, table: str, path: str, buckets: int) -> None:
    """Saves candles as a catalog table bucketed by interval and time, one file a bucket.

    Bars of one moment lie together, so joins and groupings by (interval, open_time) of such a table need no shuffle.
    """
    keys = ["interval", "open_time"]
    rows = df.select(*CANDLE.fieldNames()).repartition(buckets, *keys)
    rows.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).mode("overwrite").saveAsTable(table)


def stored_series(spark: SparkSession, root: str) -> DataFrame:
    """(symbol, interval, first_time, last_time, count) of every stored series, from the files' footers alone.

    Times are Unix seconds. Spark's newer Parquet reader answers counts and extremes by partition from footers, so the work
    grows with the number of files and not with the bars. For tables that `write_candles` has written. Switches
    that push-down on for the session, for this reader only; nothing is stored if the folder is not there yet.
    """
    # The reader takes a column's statistics by its place, so all columns of the files are named, in their order.
    columns = [f"{f.name} {f.dataType.simpleString()}" for f in CANDLE.fields if f.name not in SERIES]
    stored = ", ".join([*columns, f"{EPOCH_COLUMN} bigint", "interval string", "symbol string"])
    readers = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(readers)
    spark.conf.set(readers, ",".join(r for r in before.split(",") if r != "parquet"))
    try:
        files = spark.read.schema(stored).parquet(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], stored)
    finally:
        spark.conf.set(readers, before)
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    found = files.groupBy("interval", "symbol").agg(F.min(EPOCH_COLUMN).alias("first_time"), F.max(EPOCH_COLUMN).alias("last_time"), F.count("*").alias("count"))
    return found.select(*SERIES, "first_time", "last_time", "count")


def stored_near(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Stored rows that a batch could collide with: its intervals, its span of time, and its series."""
    return _near(existing, new, _spans(new))


def _spans(new: DataFrame, *more) -> list:
    """One small aggregation over the batch: a row per known interval and one for all others, with its span of time."""
    known = F.when(is_interval(), F.col("interval")).alias("known")
    return new.groupBy(known).agg(F.min("open_time").alias("low"), F.max("open_time").alias("high"), *more).collect()


def _near(existing: DataFrame, new: DataFrame, spans: list) -> DataFrame:
    """The spans are constants, so the scan of the table skips partitions and row groups. The series are joined, so
    that the keys of all others go before the join by key."""
    near = F.lit(False)
    for interval, low, high, *_ in spans:
        if low is not None:
            same = F.col("interval") == interval if interval else ~is_interval()
            near = near | (same & F.col("open_time").between(_ntz(low), _ntz(high)))
    return existing.where(near).join(new.select(*SERIES).distinct(), SERIES, "left_semi")


def _ntz(moment):
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def append_candles(new: DataFrame, root: str, tie_break: list[str] | None = None, strict: bool = True) -> dict[str, int]:
    """Adds the candles that are not stored yet; running it again changes nothing.

    Gives the number of `rows` in the batch, of `keys` in it, and of rows `written`. A missing column fails the
    load, or with strict=False leaves out the row. The batch is read once: one row a key is kept while the load runs
    (for its spans, its series, the write); a part lost with an executor is read again.
    """
    spark = new.sparkSession
    new = require_valid(new) if strict else split_valid(new)[0]
    ranked = _ranked(new, tie_break)
    keyed = new.groupBy(*KEY).agg(F.min(F.struct(*ranked)).alias("_row"), F.count(F.lit(1)).alias("_copies"))
    one = keyed.select(*KEY, "_row.*", "_copies").persist()
    try:
        spans = _spans(one, F.sum("_copies").alias("rows"), F.count(F.lit(1)).alias("keys"))
        done = {"rows": sum(s["rows"] for s in spans), "keys": sum(s["keys"] for s in spans), "written": 0}
        if done["keys"]:
            stored = _near(read_candles(spark, root), one, spans).select(*KEY, F.lit(True).alias("_stored"))
            written, fresh = Observation(), F.col("_stored").isNull()
            rows = one.join(stored, KEY, "left").observe(written, F.count_if(fresh).alias("written"))
            write_candles(rows.where(fresh), root)
            done["written"] = _observed(written, "written")
        return done
    finally:
        one.unpersist()


def _observed(counts: Observation, name: str) -> int:
    """A count observed in a write that has succeeded; 0 if nothing was left to write, as that cuts the count out of the plan."""
    try:
        return counts.get[name]
    except Py4JJavaError:
        return 0


def compact_candles(spark: SparkSession, root: str, target: str, chunk_bars: int = CHUNK_BARS) -> None:
    """Writes the table below `root` anew below `target`: a file per chunk of a series, instead of one per load."""
    if root.rstrip("/") == target.rstrip("/"):
        raise ValueError("a table cannot be compacted onto itself")
    write_candles(read_candles(spark, root), target, "overwrite", chunk_bars)


def fragmented_series(spark: SparkSession, root: str, chunk_bars: int = CHUNK_BARS) -> DataFrame:
    """(series) of which some chunk lies in several files. Reads the opening times and which file a row is from."""
    stored = spark.read.schema(CANDLE).parquet(root)
    files = with_chunk(stored.select(*SERIES, "open_time", F.col("_metadata.file_path").alias("file")), chunk_bars)
    files = files.groupBy(*SERIES, "chunk", "file").agg(F.lit(1).alias("one"))
    return files.groupBy(*SERIES, "chunk").count().where("count > 1").select(*SERIES).distinct()


def compact_fragments(spark: SparkSession, root: str, staging: str, chunk_bars: int = CHUNK_BARS) -> DataFrame:
    """Rewrites those series of the table below `root` that are spread over more files than need be, and no other.

    They are written below `staging` first and then replace their partitions when the second write commits, so a reader finds
    the old files or the new ones; if it fails before, the table is as it was, and a rerun starts again.
    Gives the series that were rewritten.
    """
    stored = read_candles(spark, root)
    _laid_out(stored.join(fragmented_series(spark, root, chunk_bars), SERIES, "left_semi"), chunk_bars).write.mode("overwrite").parquet(staging)
    ready = spark.read.schema(f"{EPOCH_COLUMN} bigint, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in CANDLE.fields)).parquet(staging)
    into = _laid_out(ready, chunk_bars).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    into.partitionBy("interval", "symbol").parquet(root)
    return ready.select(*SERIES).distinct()


def csv_to_parquet(spark: SparkSession, source, root: str, keys: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Converts kline CSV files below a path to the candle table's format; `keys` may rewrite the symbol and interval of their folders."""
    raw = read_klines(spark, source)
    write_candles(require_valid(to_candles(keys(raw) if keys else raw)), root)
