import re
from datetime import datetime, timedelta

import pytest
from helpers import DATA, bar, by_series, random_candles, seconds

from barline.functions.text import clean_symbol, split_symbol, url_to_path
from barline.functions.time import epoch_seconds, epoch_to_ntz, ntz_from_seconds
from barline.operators import catalog, gaps, indicators, ratio, series
from barline.plans.adapters import candles
from barline.schemas import SERVED, Backfill, UniverseFilter
from pyspark.sql import functions as F

T0 = datetime(2024, 1, 1)
HOURS = [bar("BTCUSDT", "1h", T0 + timedelta(hours=h), 10.0 + h, 12.0 + h, 9.0 + h, 11.0 + h) for h in range(48)]


def test_slice_is_half_open_ordered_and_limited(make):
    df = make(HOURS)
    from_, to = seconds(T0) + 3600, seconds(T0) + 4 * 3600
    assert [r.time for r in series.series(df, "btcusdt", "1h", from_, to).collect()] == [from_, from_ + 3600, to - 3600]
    newest = series.series(df, "BTCUSDT", "1h", limit=2, order="desc").collect()
    assert [r.time for r in newest] == [seconds(T0) + 47 * 3600, seconds(T0) + 46 * 3600]
    assert series.series(df, "ETHUSDT", "1h").count() == 0


def test_slice_with_zone_offset(make):
    shifted = [bar("A", "1d", T0 + timedelta(days=d, hours=9), 1.0, 1.0, 1.0, 1.0) for d in range(3)]
    rows = series.series(make(shifted), "A", "1d", seconds(T0), seconds(T0) + 86400, offset=9 * 3600).collect()
    assert [r.time for r in rows] == [seconds(T0)]


def test_fields(make):
    df = series.served_candle(make(HOURS))
    assert df.columns == SERVED
    assert series.select_fields(df, " close, time").columns == ["time", "close"]
    assert series.select_fields(df, None).columns == SERVED
    with pytest.raises(ValueError):
        series.select_fields(df, "time,price")


@pytest.mark.parametrize(
    "arguments",
    [
        {"limit": 0},
        {"from_": 5, "to": 5},
        {"order": "up"},
        {"interval": "1D"},
        {"symbol": "BTC/USDT"},
        {"symbol": "A" * 21},
    ],
)
def test_bad_parameters(make, arguments):
    with pytest.raises(ValueError):
        series.series(make(HOURS), **({"symbol": "BTCUSDT", "interval": "1h"} | arguments))


def test_pages_follow_each_other(make):
    df, seen, after = make(HOURS), [], None
    while True:
        page = [r.time for r in series.page_after(df, "BTCUSDT", "1h", 20, after).collect()]
        if not page:
            break
        seen += page
        after = page[-1]
    assert seen == [seconds(b[2]) for b in HOURS]
    back = series.page_after(df, "BTCUSDT", "1h", 9, seconds(T0) + 7200, order="desc").collect()
    assert [r.time for r in back] == [seconds(T0) + 3600, seconds(T0)]


def test_lookback_takes_all_bars_unless_limited(make):
    rows = [bar("A", "1m", T0 + timedelta(minutes=m), 1.0, 1.0, 1.0, 1.0) for m in range(1200)]
    as_of = seconds(T0) + 1200 * 60
    got = series.lookback(make(rows), 30, as_of, 1000, chunk_bars=100).agg(F.count("*"), F.max("open_time")).first()
    assert tuple(got) == (1000, T0 + timedelta(minutes=999))
    assert series.lookback(make(rows), 30, as_of).count() == 1200
    assert series.lookback(make(rows), None, as_of - 60).count() == 1199


def test_existence(spark, make):
    df = make(HOURS)
    assert series.series_exists(df, "BTCUSDT", "1h").count() == 1
    assert series.series_exists(df, "BTCUSDT", "1d").count() == 0
    asked = spark.createDataFrame([("BTCUSDT", "1h"), ("BTCUSDT", "1d")], "symbol string, interval string")
    assert sorted(map(tuple, series.existing_series(asked, df).collect())) == [
        ("BTCUSDT", "1d", False),
        ("BTCUSDT", "1h", True),
    ]


def test_latest_and_changes(make):
    rows = HOURS + [bar("FLAT", "1h", T0, 0.0, 1.0, 0.0, 1.0)]
    latest = {r.symbol: r for r in series.latest(make(rows)).collect()}
    assert latest["BTCUSDT"].close == 58.0 and latest["BTCUSDT"].open_time == T0 + timedelta(hours=47)
    change = {r.symbol: r.change_pct for r in series.session_change(make(rows)).collect()}
    assert change["BTCUSDT"] == pytest.approx(1 / 57 * 100) and change["FLAT"] is None


def test_catalog(make):
    rows = [bar("A", i, T0, 1.0, 1.0, 1.0, 1.0) for i in ("15m", "1d", "1M", "1m")]
    df = make(rows + HOURS)
    found = {r.symbol: r.intervals for r in catalog.symbols_intervals(df).collect()}
    assert found == {"A": ["15m", "1M", "1d", "1m"], "BTCUSDT": ["1h"]}
    assert [r.interval for r in catalog.intervals_of(df, "a").collect()] == ["15m", "1M", "1d", "1m"]
    c = catalog.coverage(df, ["btcusdt"]).first()
    assert tuple(c) == ("BTCUSDT", "1h", "BTC", "USDT", seconds(T0), seconds(T0) + 47 * 3600, 48)
    assert catalog.distinct_symbols(df).first().symbols == 2


def test_split_symbol(spark):
    rows = ["BTCUSDT", "USDT", "ETHBTC", "XFDUSD", "BNBETH", "ABC"]
    base, quote = split_symbol("s")
    got = spark.createDataFrame([(r,) for r in rows], "s string").select(base, quote).collect()
    assert list(map(tuple, got)) == [
        ("BTC", "USDT"),
        ("USDT", ""),
        ("ETH", "BTC"),
        ("X", "FDUSD"),
        ("BNB", "ETH"),
        ("ABC", ""),
    ]


def test_clean_symbol(spark):
    rows = ["btcusdt", "A/B", "", "A" * 21, "1000x"]
    got = spark.createDataFrame([(r,) for r in rows], "s string").select(clean_symbol("s")).collect()
    assert [r[0] for r in got] == ["BTCUSDT", None, None, None, "1000X"]


def test_raw_epochs(spark):
    rows = [(1735689600000,), (1735776000000000,), (1735862399999999,), (1735689600,), (None,)]
    got = spark.createDataFrame(rows, "t long").select(epoch_to_ntz("t")).collect()
    assert [r[0] for r in got] == [
        datetime(2025, 1, 1),
        datetime(2025, 1, 2),
        datetime(2025, 1, 2, 23, 59, 59, 999999),
        None,
        None,
    ]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, make, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        moments = [-86399, -1, 0, 1710054000, 1735775999]
        df = spark.createDataFrame([(m,) for m in moments], "s long")
        back = df.select(epoch_seconds(ntz_from_seconds("s")).alias("s")).collect()
        assert [r.s for r in back] == moments
        raw = df.sparkSession.range(1).select(epoch_to_ntz(F.lit(1735689600000)).cast("string").alias("t"))
        assert raw.first().t == "2025-01-01 00:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_url_to_path(spark):
    rows = {
        "https://d.test/data/spot/monthly/klines/BTCUSDT/1m/file.zip": "/tmp/x/spot/monthly/klines/BTCUSDT/1m/file.zip",
        "https://d.test//data/a//b.zip": "/tmp/x/a/b.zip",
        "https://d.test/database/b.zip?x=1#y": "/tmp/x/database/b.zip",
        "https://d.test/data/data/b.zip": "/tmp/x/data/b.zip",
        "https://d.test/": None,
        "https://d.test/data": None,
        "https://d.test": None,
    }
    df = spark.createDataFrame([(u,) for u in rows], "u string")
    got = {r.u: r.p for r in df.select("u", url_to_path("u", "/tmp/x/").alias("p")).collect()}
    assert got == rows


def test_ratio_sample(make):
    rows = [
        bar("BTCUSDT", "1d", T0, 120.0, 150.0, 90.0, 99.0),
        bar("ETHUSDT", "1d", T0, 8.0, 13.0, 7.0, 8.0),
        bar("BTCUSDT", "1d", T0 + timedelta(days=1), 1.0, 1.0, 1.0, 1.0),
        bar("ETHUSDT", "1d", T0 + timedelta(days=1), 0.0, 1.0, 0.0, 1.0),
        bar("ETHUSDT", "1d", T0 + timedelta(days=2), 1.0, 1.0, 1.0, 1.0),
    ]
    got = ratio.ratio(make(rows), "btcusdt", "ethusdt", "1d").collect()
    assert len(got) == 1
    assert (got[0].open, got[0].high, got[0].low, got[0].close) == (15.0, 15.0, 12.375, 12.375)
    assert (got[0].base_close, got[0].quote_close, got[0].time) == (99.0, 8.0, seconds(T0))
    assert ratio.ratio_lookback(make(rows), "btcusdt", "ethusdt", "1d", 1, seconds(T0)).count() == 0
    assert ratio.ratio_lookback(make(rows), "btcusdt", "ethusdt", "1d", 1, seconds(T0) + 1).count() == 1
    with pytest.raises(ValueError):
        ratio.ratio(make(rows), "BTCUSDT", "btcusdt", "1d")


def test_ratios_of_many_pairs_equal_single_ones(spark, make):
    df = make(random_candles(5, [60, 50, 40], gap_share=0.1))
    pairs = spark.createDataFrame([("S0", "S1"), ("S1", "S0"), ("S2", "S0"), ("S2", "S2"), ("S0", "NONE")], "base_symbol string, quote_symbol string")
    many = ratio.ratios(df, pairs)
    columns = ["open", "high", "low", "close", "base_close", "quote_close"]
    for base, quote in (("S0", "S1"), ("S1", "S0"), ("S2", "S0")):
        one = ratio.ratio(df, base, quote, "1h").select("time", *columns).collect()
        mine = many.where((F.col("base_symbol") == base) & (F.col("quote_symbol") == quote))
        mine = mine.select(epoch_seconds().alias("time"), *columns).orderBy("time").collect()
        assert one == mine and one
    assert many.select("base_symbol", "quote_symbol").distinct().count() == 3
    change = ratio.ratio_change(many).where("base_symbol = 'S2'").first()
    assert change.change_pct == pytest.approx((change.last_close - change.first_open) / change.first_open * 100)


def wanted(spark, *names):
    return spark.createDataFrame([(n, "1d") for n in names], "symbol string, interval string")


def test_gaps_of_an_empty_table(spark, make):
    months = gaps.planned_files(make([]), wanted(spark, "BTCUSDT"), "2026-03-01", "2026-03-31", "monthly", "https://d.test")
    assert [r.url for r in months.collect()] == [
        "https://d.test/data/spot/monthly/klines/BTCUSDT/1d/BTCUSDT-1d-2026-03.zip"
    ]


def test_months_only_partly_in_range_or_partly_loaded(spark, make):
    df = make([bar("A", "1d", datetime(2026, 2, 3), 1.0, 1.0, 1.0, 1.0)])
    months = gaps.missing_months(df, wanted(spark, "A"), "2026-01-15", "2026-04-30").collect()
    assert sorted((str(r.day), r.days) for r in months) == [("2026-03-01", 31), ("2026-04-01", 30)]


def test_missing_days_against_a_loop(spark, make):
    rows = random_candles(11, [5, 30, 1], interval="1d")
    got = gaps.missing_days(make(rows), wanted(spark, "S0", "S1", "S2", "NEW"), "2023-12-20", "2024-06-01").collect()
    present = {k[0]: {b[2].date() for b in bars} for k, bars in by_series(rows).items()}
    days = [(datetime(2023, 12, 20) + timedelta(days=d)).date() for d in range(165)]
    want = {(s, d) for s in ("S0", "S1", "S2", "NEW") for d in days if d not in present.get(s, set())}
    assert {(r.symbol, r.day) for r in got} == want and len(got) == len(want)


def test_gaps_with_shifted_days_and_fullness(spark, make):
    rows = [bar("A", "1h", T0 + timedelta(hours=h), 1.0, 1.0, 1.0, 1.0) for h in (15, 16, 30)]
    asked = spark.createDataFrame([("A", "1h")], "symbol string, interval string")

    def days(**kw):
        return sorted(str(r.day) for r in gaps.missing_days(make(rows), asked, "2024-01-01", "2024-01-02", **kw).collect())

    assert days() == []
    assert days(offset_seconds=9 * 3600) == ["2024-01-01"]
    assert days(min_bars=2) == ["2024-01-02"]


def test_not_landed(spark, make):
    planned = gaps.planned_files(make([]), wanted(spark, "A"), "2026-03-01", "2026-03-03", "daily", "https://d.test")
    landed = spark.createDataFrame([("/in/spot/daily/klines/A/1d/A-1d-2026-03-02.zip",)], "path string")
    assert sorted(r.url[-14:] for r in gaps.not_landed(planned, landed, "/in").collect()) == [
        "2026-03-01.zip",
        "2026-03-03.zip",
    ]
    assert gaps.not_landed(planned, landed, "/in", force=True).count() == 3


def test_backfill_parameters():
    good = {"interval": "1d", "first_day": "2026-03-01", "last_day": "2026-03-31", "destination": "d"}
    assert Backfill(symbols=("btcusdt",), **good).freq == "daily"
    for bad in (
        {},
        {"symbols": ("A",), "universe": UniverseFilter()},
        {"symbols": ("A",), "freq": "weekly"},
        {"symbols": ("A",), "batch_size": 0},
        {"symbols": ("A",), "interval": "7m"},
        {"symbols": ("A",), "last_day": "2026-02-01"},
    ):
        with pytest.raises(ValueError):
            Backfill(**(good | bad))
    for bad in ({"margin": "some"}, {"borrowable": "x"}):
        with pytest.raises(ValueError):
            UniverseFilter(**bad)


def test_signal_listing(make):
    rows = indicators.signal_listing(indicators.signals_thirds(make(HOURS))).collect()
    assert sorted((r.side, r.text, r.day) for r in rows) == [("Buy", "Long", "2024-01-01"), ("Sell", "Exit", "2024-01-02")]


# Plan shapes


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark, make, tmp_path):
    from barline.sources.candles import read_candles, write_candles

    write_candles(make(HOURS), str(tmp_path / "t"))
    df = read_candles(spark, str(tmp_path / "t"))
    text = plan(series.series(df, "BTCUSDT", "1h", seconds(T0), seconds(T0) + 7200, limit=9, fields="time,close"))
    assert "PartitionFilters: [isnotnull(symbol" in text and "(symbol#" in text
    assert "GreaterThanOrEqual(open_time,2024-01-01T00:00)" in text and "LessThan(open_time" in text
    assert "TakeOrderedAndProject" in text
    schema = text.split("ReadSchema: ")[1].split(">")[0]
    assert schema == "struct<open_time:timestamp_ntz,close:double"


def test_gap_scan_reads_times_only(spark, make, tmp_path):
    from barline.sources.candles import read_candles, write_candles

    write_candles(make(HOURS), str(tmp_path / "t"))
    text = plan(gaps.missing_days(read_candles(spark, str(tmp_path / "t")), wanted(spark, "A"), "2024-01-01", "2024-01-31"))
    assert "LeftAnti" in text and "CartesianProduct" not in text
    assert "ReadSchema: struct<open_time:timestamp_ntz>" in text and "GreaterThanOrEqual(open_time" in text


def test_candles_use_hash_aggregates(spark):
    text = plan(candles(spark, DATA, "15m", "1h"))
    assert "SortAggregate" not in text and text.count("Exchange hashpartitioning") == 1


def test_a_slice_without_a_limit_is_whole(make):
    rows = [bar("A", "1m", T0 + timedelta(minutes=m), 1.0, 1.0, 1.0, 1.0) for m in range(700)]
    assert series.series(make(rows), "A", "1m").count() == 700


def test_pairs_are_attached_after_the_shuffle_of_the_bars(spark, make):
    pairs = spark.createDataFrame([("S0", "S1"), ("S1", "S0")], "base_symbol string, quote_symbol string")
    df = ratio.ratios(make(random_candles(5, [60, 50], gap_share=0.1)), pairs)
    df.collect()
    text = plan(df).split("== Initial Plan ==")[0]
    assert "hashpartitioning(interval" in text and "CartesianProduct" not in text
    assert not re.search(r"hashpartitioning\(base_symbol#\d+, \d+\)", text)  # only the pair list is dealt by its symbols
