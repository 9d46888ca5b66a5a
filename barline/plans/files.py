"""Queries that go through files and streams: raw kline files, incremental loads, streamed ticks."""

from __future__ import annotations

import io
from zipfile import ZIP_DEFLATED, ZipFile

import pandas as pd
from pyspark.sql import functions as F

from barline.functions.time import epoch_micros, epoch_seconds, epoch_to_ntz
from barline.operators import catalog
from barline.operators.quality import require_valid
from barline.operators.ratio import ratios
from barline.plans import query
from barline.plans.adapters import RATIO_SQL, SCHEMAS, candles, candles_sql, pairs, scratch, spans_sql, table
from barline.plans.market import FULL_SQL, PRICES, RATIO_COLUMNS_SQL, TIME_SQL, full, r6
from barline.schemas import CANDLE, INTERVALS, RAW
from barline.sources import klines
from barline.sources.candles import (
    append_candles,
    compact_candles,
    compact_fragments,
    csv_to_parquet,
    read_candles,
    save_bucketed,
    stored_series,
    write_candles,
)
from barline.sources.klines import file_lines, parse_lines, read_klines, to_candles, unzip, with_path_keys
from barline.streaming import bars
from barline.streaming.loads import read_counts, stream_load
from barline.streaming.ticks import open_candles, stream_candles


def _raw(rows, *more):
    """Candles as raw kline rows, even hours in milliseconds and odd ones in microseconds."""
    unit = F.when(F.floor(epoch_seconds() / 3600) % 2 == 0, 1000).otherwise(1)
    raw = rows.withColumns(
        {
            "open_time": F.floor(epoch_micros("open_time") / unit).cast("bigint"),
            "close_time": F.floor(epoch_micros("close_time") / unit).cast("bigint"),
            "ignore": F.lit(0.0),
        }
    )
    return raw.select("symbol", "interval", *RAW.fieldNames(), *more)


def _write_raw(rows, folder):
    """Raw kline files below <folder>/daily/klines/<symbol>/<interval>/."""
    _raw(rows).write.partitionBy("symbol", "interval").mode("append").csv(f"{folder}/daily/klines")


def _packed(files):
    """(path, content) of archives with one text each."""

    def pack(batches):
        for batch in batches:
            contents = []
            for text in batch["text"]:
                archive = io.BytesIO()
                with ZipFile(archive, "w", ZIP_DEFLATED) as z:
                    z.writestr("inside.csv", text)
                contents.append(archive.getvalue())
            yield pd.DataFrame({"path": batch["path"], "content": contents})

    path = F.format_string("/landing/spot/daily/klines/%s/%s/%s.zip", "symbol", "interval", "day")
    return files.select(path.alias("path"), "text").mapInPandas(pack, "path string, content binary")


def _archives(rows):
    """Archives with one day of one series each."""
    line = F.to_csv(F.struct(*RAW.fieldNames()))
    day = F.date_format(epoch_to_ntz("open_time"), "yyyy-MM-dd")
    lines = _raw(rows).select("symbol", "interval", day.alias("day"), line.alias("line"))
    return _packed(lines.groupBy("symbol", "interval", "day").agg(F.array_join(F.collect_list("line"), "\n").alias("text")))


def _plain_keys(rows):
    """Folder names like symbol=CLICK as plain keys."""
    return rows.withColumns({c: F.regexp_replace(c, "^[a-z]+=", "") for c in ("symbol", "interval")})


LOADED_SQL = f"with {candles_sql('1h')} select {FULL_SQL} from candles"


@query(LOADED_SQL)
def csv_load(spark, folder):
    """Candles written as raw files in mixed time units, read back and checked."""
    landing = scratch(spark)
    _write_raw(candles(spark, folder, "1h"), landing)
    return full(require_valid(to_candles(_plain_keys(read_klines(spark, landing)))))


@query(LOADED_SQL)
def zip_load(spark, folder):
    """Candles packed into one archive per series and day, unpacked and checked."""
    files = _archives(candles(spark, folder, "1h"))
    return full(require_valid(to_candles(with_path_keys(parse_lines(unzip(files))))))


@query(LOADED_SQL)
def table_load(spark, folder):
    """The candle table after two loads that overlap by a week, read from its files."""
    root = scratch(spark)
    c = candles(spark, folder, "1h")
    write_candles(c.where(F.col("open_time") < F.expr("timestamp_ntz'2024-01-16 00:00:00'")), root)
    append_candles(c.where(F.col("open_time") >= F.expr("timestamp_ntz'2024-01-09 00:00:00'")), root)
    return full(read_candles(spark, root))


@query(LOADED_SQL)
def stream_load_twice(spark, folder):
    """The candle table after an incremental load ran, new files arrived, and it ran again."""
    base = scratch(spark)
    c = candles(spark, folder, "1h")
    parts = (
        c.where(F.col("open_time") < F.expr("timestamp_ntz'2024-01-16 00:00:00'")),
        c.where(F.col("open_time") >= F.expr("timestamp_ntz'2024-01-09 00:00:00'")),
    )
    for part in parts:
        _write_raw(part, f"{base}/in")
        stream_load(spark, f"{base}/in", f"{base}/table", f"{base}/mark", keys=_plain_keys).awaitTermination()
    return full(read_candles(spark, f"{base}/table"))


def _ticks(rows):
    return rows.select(F.upper("event_type").alias("symbol"), "ts", F.col("event_id").alias("seq"), "value")


def _event_stream(spark, folder):
    return spark.readStream.schema(SCHEMAS["events"]).option("pathGlobFilter", "events.parquet").parquet(folder)


@query(LOADED_SQL)
def streamed_candles(spark, folder):
    """Hourly candle rows from a stream of ticks: those the watermark has closed, and the open ones after the run."""
    base = scratch(spark)
    (
        stream_candles(_ticks(_event_stream(spark, folder)), "1h")
        .writeStream.format("parquet")
        .option("path", f"{base}/bars")
        .option("checkpointLocation", f"{base}/mark")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    closed = spark.read.schema(CANDLE).parquet(f"{base}/bars")
    return full(closed.unionByName(open_candles(_ticks(table(spark, folder, "events")), closed, "1h")))


@query(f"with {candles_sql(*INTERVALS)} select {FULL_SQL} from candles")
def streamed_intervals(spark, folder):
    """Candle rows of all intervals from one stream of ticks, months and weeks by the calendar."""
    base = scratch(spark)
    bars.start_parts(_ticks(_event_stream(spark, folder)), f"{base}/parts", f"{base}/mark").awaitTermination()
    closed = bars.candles_from_parts(bars.read_parts(spark, f"{base}/parts"))
    return full(closed.unionByName(open_candles(_ticks(table(spark, folder, "events")), closed, INTERVALS)))


HELD_BACK, LATE_INTERVALS = 40, ["15m", "1h", "1d", "1M"]


def _late_parts(spark, folder, base):
    """Parts of a stream whose last run finds ticks of all times that were held back before."""
    events, back = table(spark, folder, "events"), F.col("event_id") % HELD_BACK == 0
    for rows in (events.where(~back), events.where(back)):
        rows.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(SCHEMAS["events"]).parquet(f"{base}/in")
        bars.start_parts(_ticks(stream), f"{base}/parts", f"{base}/mark", intervals=LATE_INTERVALS).awaitTermination()
    return bars.read_parts(spark, f"{base}/parts")


LATE_SQL = f"""with {spans_sql(*LATE_INTERVALS)},
mark as (select epoch_ms(max(ts)) - 3600000 as w from events where event_id % {HELD_BACK} <> 0)"""


@query(f"""{LATE_SQL}
select symbol, "interval", {TIME_SQL} as time, event_id as seq, cast(epoch_us(ts) as bigint) as us, value
from tick_bars, mark where event_id % {HELD_BACK} = 0 and epoch_ms(bar_end) <= w""")
def late_ticks(spark, folder):
    """Ticks that a stream met only after their bars had closed, once for each such bar."""
    late = bars.late_ticks(_late_parts(spark, folder, scratch(spark)))
    return late.select("symbol", "interval", epoch_seconds().alias("time"), "seq", epoch_micros("ts").alias("us"), "value")


@query(LOADED_SQL)
def csv_to_table(spark, folder):
    """Raw kline files converted to the candle table, compacted, and read from its files."""
    base = scratch(spark)
    c = candles(spark, folder, "1h")
    _write_raw(c, f"{base}/in")
    rows = to_candles(_plain_keys(read_klines(spark, f"{base}/in")))
    for half in (0, 1):
        append_candles(rows.where(F.pmod(F.xxhash64("open_time"), F.lit(2)) == half), f"{base}/table")
    compact_candles(spark, f"{base}/table", f"{base}/compact")
    return full(read_candles(spark, f"{base}/compact"))


DAMAGED_SQL = f"""with {candles_sql("1h")},
bad as (
  select symbol, open_time::date as day, 'GARBAGE ' || symbol || ' ' || {TIME_SQL} as line from candles where number_of_trades % 7 = 0
  union all
  select symbol, open_time::date, 'bad,bad,2,' || {TIME_SQL} || ',bad' from candles where number_of_trades % 11 = 0)"""


@query(f"""{DAMAGED_SQL}
select 'csv' as source, symbol, line from bad union all select 'zip', symbol, line from bad
union all select 'good csv', symbol, cast(count(*) as varchar) from candles group by symbol
union all select 'good zip', symbol, cast(count(*) as varchar) from candles group by symbol""")
def damaged_lines(spark, folder):
    """Damaged lines planted in plain files and in archives, as they are set aside, and the good rows that are left."""
    base = scratch(spark)
    c = candles(spark, folder, "1h")
    time = epoch_seconds().cast("string")
    n = F.col("number_of_trades")
    garbage = F.when(n % 7 == 0, F.concat_ws(" ", F.lit("GARBAGE"), "symbol", time))
    halves = F.when(n % 11 == 0, F.concat(F.lit("bad,bad,2,"), time, F.lit(",bad")))
    raw = _raw(c.withColumns({"_garbage": garbage, "_halves": halves}), "_garbage", "_halves")
    day = F.date_format(epoch_to_ntz("open_time"), "yyyy-MM-dd")
    lines = F.array_compact(F.array(F.to_csv(F.struct(*RAW.fieldNames())), "_garbage", "_halves"))
    files = raw.groupBy("symbol", "interval", day.alias("day")).agg(F.flatten(F.collect_list(lines)).alias("lines"))
    header = F.array(F.lit(",".join(RAW.fieldNames())))
    files = files.select("symbol", "interval", "day", F.array_join(F.concat(header, "lines"), "\n").alias("text"))
    files.drop("day").write.partitionBy("symbol", "interval").text(f"{base}/daily/klines")
    written = spark.read.option("recursiveFileLookup", "true").text(f"{base}/daily/klines")
    plain = _plain_keys(with_path_keys(file_lines(written)))
    zipped = with_path_keys(unzip(_packed(files)))
    parts = []
    for source, rows in (("csv", plain), ("zip", zipped)):
        lines = rows.select(F.col("symbol").alias("path"), "member", "line")
        bad = klines.damaged_lines(lines).select(F.lit(source).alias("source"), F.col("path").alias("symbol"), "line")
        good = klines.parse_lines(lines, strict=False).groupBy(F.col("path").alias("symbol")).agg(F.count(F.lit(1)).cast("string").alias("line"))
        parts += [bad, good.select(F.lit(f"good {source}").alias("source"), "symbol", "line")]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


def _loaded_in_parts(spark, folder, root):
    """A table after three loads: of all series, of two of them again for later days, and of one again that is there already."""
    c = candles(spark, folder, "1h", "1d")
    day = lambda d: F.expr(f"timestamp_ntz'2024-01-{d} 00:00:00'")
    write_candles(c.where((F.col("open_time") < day(16)) | ~F.col("symbol").isin("CLICK", "VIEW")), root)
    append_candles(c.where((F.col("open_time") >= day(16)) & F.col("symbol").isin("CLICK", "VIEW")), root)
    append_candles(c.where(F.col("symbol") == "ERROR"), root)


@query(f"""with {candles_sql("1h", "1d")}
select symbol, "interval", cast(epoch_us(min(open_time)) // 1000000 as bigint) as first_time,
  cast(epoch_us(max(open_time)) // 1000000 as bigint) as last_time, cast(count(*) as bigint) as "count"
from candles group by 1, 2""")
def stored_catalog(spark, folder):
    """Coverage of a stored table, from the footers of its files."""
    root = scratch(spark)
    _loaded_in_parts(spark, folder, root)
    return catalog.stored_coverage(stored_series(spark, root)).drop("base_asset", "quote_asset")


@query(f"""with {candles_sql("1h", "1d")}
select symbol, "interval", cast(count(*) as bigint) as rows, symbol in ('CLICK', 'VIEW') as rewritten, cast(1 as bigint) as files
from candles group by 1, 2""")
def compacted_fragments(spark, folder):
    """Rows and files of every series after three loads and a compaction, and whether it was rewritten."""
    base = scratch(spark)
    _loaded_in_parts(spark, folder, f"{base}/table")
    done = compact_fragments(spark, f"{base}/table", f"{base}/staging").withColumn("rewritten", F.lit(True))
    rows = spark.read.schema(CANDLE).parquet(f"{base}/table").select("symbol", "interval", F.col("_metadata.file_path").alias("file"))
    rows = rows.groupBy("symbol", "interval").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("file").alias("files"))
    return rows.join(done, ["symbol", "interval"], "left").fillna({"rewritten": False})


@query(f"""with {candles_sql("1h")}
select cast(count(*) as bigint) as rows, cast(count(*) as bigint) as written, true as several from candles""")
def load_in_batches(spark, folder):
    """What an incremental load counted that took a few files at a time."""
    base = scratch(spark)
    _write_raw(candles(spark, folder, "1h"), f"{base}/in")
    limits = {"max_files": 2, "counts": f"{base}/counts"}
    stream_load(spark, f"{base}/in", f"{base}/table", f"{base}/mark", keys=_plain_keys, **limits).awaitTermination()
    sums = [F.sum(c).alias(c) for c in ("rows", "written")]
    return read_counts(spark, f"{base}/counts").agg(*sums, (F.count(F.lit(1)) > 1).alias("several"))


@query(LOADED_SQL)
def converted_files(spark, folder):
    """Raw kline files converted in one step to the candle table's format."""
    base = scratch(spark)
    _write_raw(candles(spark, folder, "1h"), f"{base}/in")
    csv_to_parquet(spark, f"{base}/in", f"{base}/table", _plain_keys)
    return full(read_candles(spark, f"{base}/table"))


@query(f"""with {candles_sql("1h", "1d")}, {RATIO_SQL}
select base_symbol, quote_symbol, "interval", {TIME_SQL} as time, {RATIO_COLUMNS_SQL} from ratio""")
def ratio_stored(spark, folder):
    """Ratio candles of a list of pairs from a table that is bucketed by moment."""
    base = scratch(spark)
    name = f"barline_{base.rsplit('/', 1)[1]}"
    save_bucketed(candles(spark, folder, "1h", "1d"), name, base, 8)
    rows = ratios(spark.table(name), pairs(spark, folder), placed=True)
    return rows.select("base_symbol", "quote_symbol", "interval", epoch_seconds().alias("time"), *r6(*PRICES), "base_close", "quote_close")
