import glob
import json
import os
from datetime import datetime, timedelta
from types import SimpleNamespace
from zipfile import ZipFile

import pytest
from helpers import bar, random_candles
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from barline.functions.sql import register_gap_function, register_time_function
from barline.operators import backfill, quality, runs
from barline.schemas import CANDLE, INTERVALS, Backfill
from barline.sources import candles, klines, metadata, reports
from barline.streaming.loads import checkpoint_location, stream_load
from barline.streaming.ticks import candles_from_ticks, open_candles, stream_candles

T0 = datetime(2025, 1, 1)
HEADER = "open_time,open,high,low,close,volume,close_time,quote_volume,count,taker_buy_volume,taker_buy_quote_volume,ignore"
MILLIS = "1735689600000,1.0,2.0,0.5,1.5,10.0,1735775999999,15.0,3,5.0,7.5,0"
MICROS = "1735776000000000,1.5,2.5,1.0,2.0,11.0,1735862399999999,22.0,4,5.5,11.0,0"
SECONDS = "1735862400,1.5,2.5,1.0,2.0,11.0,1735948799,22.0,4,5.5,11.0,0"


def put(root, symbol, name, lines, interval="1d", freq="daily"):
    folder = root / "spot" / freq / "klines" / symbol / interval
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    if name.endswith(".zip"):
        with ZipFile(path, "w") as z:
            for member, text in lines.items():
                z.writestr(member, "\n".join(text) + "\n")
    else:
        path.write_text("\n".join(lines) + "\n")
    return path


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_csv_files_become_candles(spark, tmp_path):
    put(tmp_path, "BTCUSDT", "a.csv", [HEADER, MILLIS, MICROS])
    put(tmp_path, "ETHUSDT", "b.csv", [MILLIS], interval="1M", freq="monthly")
    raw = klines.read_klines(spark, str(tmp_path))
    assert sorted({(r.symbol, r.interval, r.freq) for r in raw.collect()}) == [
        ("BTCUSDT", "1d", "daily"),
        ("ETHUSDT", "1M", "monthly"),
    ]
    got = klines.to_candles(raw)
    assert got.schema.fieldNames() == CANDLE.fieldNames()
    first, second, _ = sorted(got.collect())
    assert first.open_time == T0 and first.close_time == T0 + timedelta(days=1, milliseconds=-1)
    assert second.open_time == T0 + timedelta(days=1) and second.close_time == T0 + timedelta(days=2, microseconds=-1)
    assert (first.quote_asset_volume, first.number_of_trades, first.taker_buy_quote_volume) == (15.0, 3, 7.5)
    fixed = klines.to_candles(klines.read_klines(spark, str(tmp_path), keys=False), "abc", "1h").first()
    assert (fixed.symbol, fixed.interval) == ("ABC", "1h")


def test_zip_files_give_the_same_rows(spark, tmp_path):
    put(tmp_path / "z", "BTCUSDT", "a.zip", {"inside.csv": [HEADER, MILLIS, MICROS], "notes.txt": ["x"], "sub/deep.csv": [MILLIS]})
    put(tmp_path / "c", "BTCUSDT", "a.csv", [MILLIS, MICROS])
    zipped = klines.to_candles(klines.read_zipped_klines(spark, str(tmp_path / "z")))
    assert rows(zipped) == rows(klines.to_candles(klines.read_klines(spark, str(tmp_path / "c")))) != []


def test_unsafe_archives_are_refused(spark, tmp_path):
    put(tmp_path, "A", "bad.zip", {"ok.csv": [MILLIS], "../outside.csv": [MILLIS]})
    put(tmp_path, "A", "worse.zip", {"/etc/outside.csv": [MILLIS]})
    put(tmp_path, "A", "good.zip", {"ok.csv": [MILLIS]})
    with pytest.raises(PythonException, match="unsafe member"):
        klines.scan_archives(spark, str(tmp_path)).count()
    scanned = klines.scan_archives(spark, str(tmp_path), on_unsafe="report").collect()
    assert sorted((os.path.basename(r.path), r.member) for r in scanned if r.error) == [
        ("bad.zip", "../outside.csv"),
        ("worse.zip", "/etc/outside.csv"),
    ]
    assert [(os.path.basename(r.path), r.member) for r in scanned if not r.error] == [("good.zip", "ok.csv")]


@pytest.mark.parametrize("block_chars", [1, 50, 10**6])
def test_blocks_are_cut_at_line_ends(spark, tmp_path, block_chars):
    lines = [HEADER, MILLIS, MICROS, "é" * 60, "", MILLIS]
    put(tmp_path, "A", "long.zip", {"long.csv": lines})
    files = spark.read.format("binaryFile").load(str(tmp_path / "spot/daily/klines/A/1d/long.zip"))
    got = [r.line for r in klines.unzip(files, block_chars=block_chars).collect()]
    assert got == [line for line in lines if line]


DAMAGED = ["GARBAGE LINE", "bad,bad,2,1,1,1,bad,1,1,1,1,1", MILLIS + ",13", "," + MILLIS.split(",", 1)[1]]


def test_damaged_lines_are_never_lost(spark, tmp_path):
    put(tmp_path / "c", "A", "a.csv", [HEADER, MILLIS, DAMAGED[0], MICROS, *DAMAGED[1:]])
    put(tmp_path / "z", "A", "a.zip", {"x.csv": [MILLIS, *DAMAGED, HEADER.upper(), MICROS]})
    for read, scan, folder in (
        (klines.read_klines, klines.scan_lines, "c"),
        (klines.read_zipped_klines, klines.scan_archives, "z"),
    ):
        source = str(tmp_path / folder)
        with pytest.raises(Exception, match="damaged line in"):
            read(spark, source).collect()
        assert read(spark, source, strict=False).count() == 2
        bad = klines.damaged_lines(scan(spark, source)).collect()
        assert sorted(r.line for r in bad) == sorted(DAMAGED) and all(r.path for r in bad)


def test_quality(spark, tmp_path):
    put(tmp_path, "A", "a.csv", [MILLIS, SECONDS])
    put(tmp_path, "A", "b.csv", [MILLIS])
    df = klines.to_candles(klines.read_klines(spark, str(tmp_path)))
    good, bad = quality.split_valid(df)
    assert good.count() == 2 and [r.open_time for r in bad.collect()] == [None]
    with pytest.raises(Exception, match="a required column is NULL"):
        quality.require_valid(df).collect()
    assert quality.require_valid(good).count() == 2
    assert [r.rows for r in quality.duplicate_keys(good).collect()] == [2]
    report = quality.quality_report(df).first()
    assert (report.interval, report.rows, report.with_null, report.repeated, report.known_interval) == ("1d", 3, 1, 1, True)


def test_load_is_idempotent_and_stored_rows_win(spark, make, tmp_path):
    root = str(tmp_path / "table")
    assert candles.read_candles(spark, root).count() == 0
    stored = random_candles(1, [30, 20])
    candles.append_candles(make(stored), root)
    changed = [r[:7] + (r[7] + 1,) + r[8:] for r in stored[10:]]
    fresh = [bar("S0", "1h", datetime(2030, 1, 1), 1.0, 1.0, 1.0, 1.0), bar("NEW", "1d", T0, 1.0, 1.0, 1.0, 1.0)]
    for _ in range(2):
        candles.append_candles(make(changed + fresh + fresh), root)
        assert rows(candles.read_candles(spark, root)) == sorted(stored + fresh)
    kept = {os.path.basename(p) for p in glob.glob(f"{root}/*")}
    assert {"interval=1d", "interval=1h"} <= kept


def test_copies_of_a_key_keep_the_first_by_file(spark, tmp_path):
    put(tmp_path, "A", "b.csv", [MILLIS])
    put(tmp_path, "A", "a.csv", [MILLIS.replace("10.0", "99.0")])
    df = klines.to_candles(klines.read_klines(spark, str(tmp_path)), keep=("path",))
    got = candles.insert_or_ignore(candles.read_candles(spark, str(tmp_path / "none")), df, ["path"])
    assert [r.volume for r in got.collect()] == [99.0]


def test_copies_are_reduced_before_the_shuffle_in_one_read(make):
    text = candles.keep_first(make(random_candles(1, [3])))._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Scan ExistingRDD") == 1
    assert text.index("partial_min") > text.index("Exchange hashpartitioning")


def test_copies_that_differ_keep_the_smallest(make):
    a = bar("A", "1d", T0, 1.0, 1.0, 1.0, 1.0)
    b = a[:7] + (0.5,) + a[8:]
    assert rows(candles.keep_first(make([a, b, a]))) == [b]
    assert rows(candles.keep_first(make([a, a, a]))) == [a]


def test_compaction_keeps_all_rows_in_fewer_files(spark, make, tmp_path):
    root, target = str(tmp_path / "t"), str(tmp_path / "u")
    stored = random_candles(1, [30], gap_share=0)
    for part in (stored[:10], stored[10:20], stored[20:]):
        candles.append_candles(make(part), root)
    candles.compact_candles(spark, root, target)
    assert rows(candles.read_candles(spark, target)) == sorted(stored)
    assert len(glob.glob(f"{target}/*/*/*.parquet")) < len(glob.glob(f"{root}/*/*/*.parquet"))
    with pytest.raises(ValueError):
        candles.compact_candles(spark, root, root + "/")


def test_long_series_are_written_in_stretches(spark, make, tmp_path):
    root = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        candles.write_candles(make(random_candles(2, [64], gap_share=0)), root, chunk_bars=16)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = glob.glob(f"{root}/interval=1h/symbol=S0/*.parquet")
    spans = sorted(tuple(spark.read.parquet(f).agg(F.min("open_time"), F.max("open_time")).first()) for f in files)
    assert len(spans) > 1


def test_interval_directories_keep_their_names(spark, make, tmp_path):
    root = str(tmp_path / "t")
    candles.write_candles(make([bar("A", i, T0, 1.0, 1.0, 1.0, 1.0) for i in ("1d", "3d", "1m", "1M")]), root)
    got = candles.read_candles(spark, root)
    assert got.schema["interval"].dataType.typeName() == "string"
    assert sorted(r.interval for r in got.collect()) == ["1M", "1d", "1m", "3d"]


def test_csv_to_parquet(spark, tmp_path):
    put(tmp_path / "in", "BTCUSDT", "a.csv", [HEADER, MILLIS, MICROS])
    candles.csv_to_parquet(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert candles.read_candles(spark, str(tmp_path / "out")).count() == 2


def test_landed_archives_are_not_planned_again(spark, make, tmp_path):
    for day in ("2026-03-01", "2026-03-03"):
        put(tmp_path, "A", f"A-1d-{day}.zip", {"x.csv": [MILLIS]})
    landed = klines.landed_files(spark, str(tmp_path))
    assert "content" not in landed._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    config = Backfill("1d", "2026-03-01", "2026-03-04", str(tmp_path), symbols=("A",))
    symbols = backfill.resolve_symbols(spark, config)
    files = backfill.plan_files(config, make([]), symbols, "https://d.test", landed)
    assert sorted(r.url[-14:-4] for r in files.collect()) == ["2026-03-02", "2026-03-04"]


def test_append_refuses_or_leaves_out_invalid_rows(spark, make, tmp_path):
    both = make([bar("BAD", "1d", T0, 1.0, 1.0, 1.0, 1.0), bar("Z", "1d", T0, 1.0, 1.0, 1.0, 1.0)])
    broken = both.withColumn("close", F.when(F.col("symbol") != "BAD", F.col("close")))
    with pytest.raises(Exception, match="a required column is NULL"):
        candles.append_candles(broken, str(tmp_path / "t"))
    candles.append_candles(broken, str(tmp_path / "t"), strict=False)
    assert [r.symbol for r in candles.read_candles(spark, str(tmp_path / "t")).collect()] == ["Z"]


def test_load_summary(spark, tmp_path):
    put(tmp_path, "A", "1.zip", {"x.csv": [MILLIS], "y.csv": [MICROS]})
    put(tmp_path, "A", "2.zip", {"x.csv": [MILLIS]})
    put(tmp_path, "B", "3.csv", [MILLIS, MICROS])
    columns = ["symbol", "path", "member"]
    files = klines.read_zipped_klines(spark, str(tmp_path)).select(*columns)
    files = files.unionAll(klines.read_klines(spark, str(tmp_path)).select(*columns))
    assert tuple(runs.load_summary(files).first()) == (2, 2, 4)


def test_stream_load_picks_up_new_files_once(spark, tmp_path):
    source, root, mark = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "mark")

    def run(**options):
        query = stream_load(spark, str(source), root, **({"checkpoint": mark} | options))
        query.awaitTermination(120)
        assert query.exception() is None

    put(source, "BTCUSDT", "1.csv", [HEADER, MILLIS])
    run()
    put(source, "BTCUSDT", "2.csv", [MILLIS.replace("10.0", "77.0"), MICROS, MICROS])
    run()
    run()
    got = rows(candles.read_candles(spark, root).select("open_time", "volume"))
    assert got == [(T0, 10.0), (T0 + timedelta(days=1), 11.0)]
    run(checkpoint=str(tmp_path / "lost"))
    assert rows(candles.read_candles(spark, root).select("open_time", "volume")) == got


def test_stream_load_of_archives(spark, tmp_path):
    source, root, mark = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "mark")
    for name, line in (("1.zip", MILLIS), ("2.zip", MICROS), ("3.zip", MICROS)):
        put(source, "BTCUSDT", name, {"inside.csv": [HEADER, line]})
        query = stream_load(spark, str(source), root, mark, zipped=True)
        query.awaitTermination(120)
        assert query.exception() is None
    got = candles.read_candles(spark, root)
    assert rows(got.select("symbol", "interval", "open_time")) == [
        ("BTCUSDT", "1d", T0),
        ("BTCUSDT", "1d", T0 + timedelta(days=1)),
    ]


def test_stream_load_with_invalid_rows(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "table")
    put(source, "A", "1.csv", [MILLIS, SECONDS])
    query = stream_load(spark, str(source), root, str(tmp_path / "m1"), strict=False)
    query.awaitTermination(120)
    assert candles.read_candles(spark, root).count() == 1
    query = stream_load(spark, str(source), str(tmp_path / "other"), str(tmp_path / "m2"))
    with pytest.raises(Exception, match="a required column is NULL"):
        query.awaitTermination(120)


def test_checkpoint_folder_comes_from_the_session():
    def session(**settings):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: settings.get("folder", default)))

    assert checkpoint_location(session(folder="/shared/"), "x") == "/shared/x"
    with pytest.raises(ValueError):
        checkpoint_location(session(), "x")


def test_streamed_ticks_equal_batch_candles(spark, tmp_path):
    ticks = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.upper("event_type").alias("symbol"), "ts", F.col("event_id").alias("seq"), "value"
    )
    folder = str(tmp_path / "ticks")
    ticks.orderBy("ts").coalesce(1).write.parquet(folder)
    ticks.orderBy("ts").coalesce(1).write.mode("append").parquet(folder)  # every tick twice
    stream = stream_candles(spark.readStream.schema(ticks.schema).parquet(folder))
    query = (
        stream.writeStream.format("memory").queryName("bars").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    closed = spark.table("bars")
    assert closed.schema.simpleString() == CANDLE.simpleString()
    exact = [c for c in CANDLE.fieldNames() if "volume" not in c]
    batch = rows(candles_from_ticks(ticks, ["1h"]).select(*exact))
    last = ticks.agg(F.max("ts")).first()[0] - timedelta(hours=1)
    assert rows(closed.select(*exact)) == [r for r in batch if r[3] < last] != []
    left = open_candles(ticks.unionAll(ticks), closed, "1h")
    assert sorted(rows(closed.select(*exact)) + rows(left.select(*exact))) == batch
    assert rows(open_candles(ticks, closed.limit(0), "1h").select(*exact)) == batch
    with pytest.raises(ValueError):
        stream_candles(ticks, "1M")


def test_calendar_bars(spark):
    moments = [datetime(2024, 1, 31, 23, 59, 59), datetime(2024, 2, 1), datetime(2024, 2, 29, 12), datetime(1969, 12, 31)]
    ticks = spark.createDataFrame([("A", t, k, float(k)) for k, t in enumerate(moments)], "symbol string, ts timestamp_ntz, seq long, value double")
    got = {(r.interval, r.open_time): r for r in candles_from_ticks(ticks, INTERVALS).collect()}
    ms = timedelta(milliseconds=1)

    def bounds(interval):
        return sorted((t, r.close_time + ms) for (i, t), r in got.items() if i == interval)

    day = datetime
    assert bounds("1M") == [(day(1969, 12, 1), day(1970, 1, 1)), (day(2024, 1, 1), day(2024, 2, 1)), (day(2024, 2, 1), day(2024, 3, 1))]
    assert bounds("1w") == [(day(1969, 12, 29), day(1970, 1, 5)), (day(2024, 1, 29), day(2024, 2, 5)), (day(2024, 2, 26), day(2024, 3, 4))]
    assert all((b - a).days == 3 and (a - day(1970, 1, 1)).days % 3 == 0 for a, b in bounds("3d"))
    assert got["1w", day(2024, 1, 29)].number_of_trades == 2
    with pytest.raises(ValueError):
        candles_from_ticks(ticks, ["1h", "90m"])


def test_sql_functions(spark, make):
    register_time_function(spark)
    assert spark.sql("select time_in_second(1735689600000) a, time_in_second(5) b").first() == (T0, None)
    make([bar("A", "1d", T0, 1.0, 1.0, 1.0, 1.0)]).createOrReplaceTempView("stored_candles")
    register_gap_function(spark, "stored_candles")
    got = spark.sql("select * from missing_days('A', '1d', date'2024-12-31', date'2025-01-02')").collect()
    assert sorted(str(r.d) for r in got) == ["2024-12-31", "2025-01-02"]


EXCHANGE = {
    "symbols": [
        {"symbol": "OAKELM", "status": "TRADING", "baseAsset": "OAK", "quoteAsset": "ELM",
         "orderTypes": ["LIMIT", "MARKET"], "permissions": ["SPOT"], "isMarginTradingAllowed": True},
        {"symbol": "M1", "status": "TRADING", "permissions": ["SPOT", "MARGIN"]},
        {"symbol": "M2", "status": "BREAK", "permissions": ["MARGIN"], "isMarginTradingAllowed": None},
        {"symbol": "M3", "status": "BREAK", "isMarginTradingAllowed": 1},
    ]
}


def write_json(path, document):
    path.write_text(json.dumps(document, indent=1))
    return str(path)


def test_exchange_metadata(spark, tmp_path):
    docs = metadata.read_json_documents(spark, write_json(tmp_path / "x.json", EXCHANGE))
    got = {r.symbol: r for r in metadata.parse_symbols(docs).collect()}
    oak = got["OAKELM"]
    assert (oak.status, oak.base_asset, oak.quote_asset, oak.order_types) == ("TRADING", "OAK", "ELM", ["LIMIT", "MARKET"])
    assert (got["M1"].base_asset, got["M1"].order_types) == ("", [])
    assert [got[s].is_margin_trading_allowed for s in ("OAKELM", "M1", "M2", "M3")] == [True, True, False, True]
    assert [got[s].position for s in ("OAKELM", "M3")] == [0, 3]


def test_metadata_without_a_required_key_fails(spark, tmp_path):
    docs = metadata.read_json_documents(spark, write_json(tmp_path / "x.json", {"symbols": [{"symbol": "A"}]}))
    with pytest.raises(Exception, match="a symbol has no status"):
        metadata.parse_symbols(docs).collect()


def test_margin_metadata(spark, tmp_path):
    pairs = [{"symbol": "btcusdt", "isMarginTrade": False}, {"symbol": "ETHUSDT"}, {"symbol": "N", "isMarginTrade": None}, {"symbol": ""}, {}]
    assets = [{"asset": "btc", "isBorrowable": True}, {"asset": "ETH"}, {"asset": "N", "isBorrowable": None}, {"asset": None}]
    got = metadata.parse_margin_pairs(metadata.read_json_documents(spark, write_json(tmp_path / "p.json", pairs)))
    assert rows(got.select("symbol", "is_margin_trade")) == [("BTCUSDT", False), ("ETHUSDT", True), ("N", False)]
    got = metadata.parse_margin_assets(metadata.read_json_documents(spark, write_json(tmp_path / "a.json", assets)))
    assert rows(got.select("asset", "is_borrowable")) == [("BTC", True), ("ETH", False), ("N", False)]


def test_reports(spark, tmp_path):
    log = spark.createDataFrame([(0, "downloaded", True), (1, "failed", False)], "batch int, result string, ok boolean")
    reports.write_run_record(runs.batch_status(runs.outcome_counts(log)), str(tmp_path / "run"))
    text = "".join(open(f).read() for f in glob.glob(str(tmp_path / "run" / "*.json")))
    got = sorted((json.loads(line) for line in text.splitlines()), key=lambda r: r["batch"])
    assert [(r["url_count"], r["failed"], r["status"]) for r in got] == [(1, 0, "complete"), (1, 1, "failed")]
    universe = metadata.parse_symbols(metadata.read_json_documents(spark, write_json(tmp_path / "x.json", EXCHANGE)))
    reports.write_listing(universe.where("symbol = 'OAKELM'"), str(tmp_path / "list"))
    assert spark.read.text(str(tmp_path / "list")).first().value == "OAKELM,OAK,ELM,TRADING"
