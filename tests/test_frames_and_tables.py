import glob
import os
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from helpers import bar, by_series, random_candles, seconds
from pyspark.sql import functions as F

from barline.functions.sql import register_gap_function
from barline.operators import catalog, frames, gaps, ratio, requests
from barline.operators.backtest import metrics
from barline.schemas import INTERVAL_SECONDS, INTERVALS, check_interval, check_length, check_limit, check_range, check_symbol
from barline.sources import candles
from barline.streaming import bars
from barline.streaming.loads import read_counts, stream_load
from barline.streaming.ticks import candles_from_ticks

T0 = datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Moving frames


@pytest.mark.parametrize("lengths", [(1, 1), (3, 7), (7, 3), (10, 500)])
def test_moving_frames_equal_sliding_ones(spark, lengths):
    rng = random.Random(sum(lengths))
    rows = [(s, "1h", c, p, rng.choice([rng.uniform(-5, 5), 0.0, 1e6])) for s in "AB" for c in range(2) for p in range(1, 61)]
    df = spark.createDataFrame(rows, "symbol string, interval string, chunk long, pos long, x double").repartition(4)
    a, b = lengths
    got = frames.with_top_before(frames.with_moving_means(df, {"mean": ("x", a), "other": ("x", b)}), "top", "x", a)
    values = {(s, c): [r[4] for r in sorted(rows) if (r[0], r[2]) == (s, c)] for s in "AB" for c in range(2)}
    assert got.count() == len(rows)
    for r in got.collect():
        x, p = values[r.symbol, r.chunk], r.pos
        for name, n in (("mean", a), ("other", b)):
            assert (r[name] is None) == (p < n)
            assert p < n or r[name] == pytest.approx(sum(x[p - n : p]) / n, abs=1e-7)
        assert r.top == max(x[max(0, p - 1 - a) : p - 1], default=None)


def test_moving_frames_stay_in_their_partitioning(spark):
    df = spark.range(1).selectExpr("'A' as symbol", "'1h' as interval", "0L as chunk", "id + 1 as pos", "1d as x")
    df = df.repartition("symbol", "interval", "chunk")
    text = plan(frames.with_top_before(frames.with_moving_means(df, {"m": ("x", 500), "n": ("x", 20)}), "top", "x", 9))
    assert text.count("Exchange") == 1 and "-499" not in text and "500 PRECEDING" not in text


def test_metrics_shuffle_the_bars_once(make):
    text = plan(metrics(make(random_candles(1, [80, 3]))))
    # Bars and the copies before each chunk are put together in one place; below it, copies and counts are dealt on their own.
    lines = text.splitlines()
    union = next(k for k, line in enumerate(lines) if "Union" in line)
    assert sum("Union" in line for line in lines) == 1
    assert sum("Exchange" in line for line in lines[:union]) <= 3


# Ranges of missing bars


@pytest.mark.parametrize("chunk_bars", [1, 5, 1000])
def test_missing_ranges(spark, chunk_bars):
    rng = random.Random(chunk_bars)
    start, end = datetime(2023, 12, 30), datetime(2024, 2, 3)
    have, want = [], []
    for interval in ("1h", "4h", "1d", "3d", "1w", "1M"):
        times = [t for t in grid(interval) if start <= t < end]
        for symbol, share in (("A", 0.7), ("B", 0.05), ("C", 1.0), ("D", 0.0)):
            kept = [t for t in times if rng.random() < share]
            have += [bar(symbol, interval, t, 1.0, 1.0, 1.0, 1.0) for t in kept + kept[:2]]
            have += [bar(symbol, interval, times[0] - timedelta(days=400), 1.0, 1.0, 1.0, 1.0)]
            lost = [k for k, t in enumerate(times) if t not in set(kept)]
            runs = [k for k in lost if k - 1 not in lost]
            for a in runs:
                z = next(k for k in range(a, len(times) + 1) if k + 1 not in lost)
                want.append((symbol, interval, times[a], times[z], z - a + 1))
    from barline.schemas import CANDLE

    df = spark.createDataFrame(have, CANDLE).repartition(3)
    series = spark.createDataFrame([(s, i) for s in "ABCD" for i in ("1h", "4h", "1d", "3d", "1w", "1M", "9x")] + [("A", "1h")], "symbol string, interval string")
    got = gaps.missing_ranges(df, series, "2023-12-30", "2024-02-02", chunk_bars)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def grid(interval):
    """Opening times of all bars from 2023 to 2024."""
    if interval == "1M":
        return [datetime(y, m, 1) for y in (2023, 2024) for m in range(1, 13)]
    width = timedelta(seconds=INTERVAL_SECONDS[interval])
    t = datetime(1970, 1, 5) if interval == "1w" else datetime(1970, 1, 1)
    t += (datetime(2023, 1, 1) - t) // width * width
    out = []
    while t < datetime(2024, 12, 31):
        out.append(t)
        t += width
    return out


def test_gap_function_of_many_series(spark, make):
    make([bar("A", "1d", T0, 1.0, 1.0, 1.0, 1.0), bar("B", "1h", T0, 1.0, 1.0, 1.0, 1.0)]).createOrReplaceTempView("bars_of_many")
    register_gap_function(spark, "bars_of_many")
    wanted = [("A", "1d"), ("B", "1d"), ("C", "1d")]
    spark.createDataFrame(wanted, "symbol string, interval string").createOrReplaceTempView("wanted_of_many")
    df = spark.sql("select w.symbol, day(m.d) as d from wanted_of_many w, lateral missing_days(w.symbol, w.interval, date'2024-01-01', date'2024-01-02') m")
    assert sorted(map(tuple, df.collect())) == [("A", 2), ("B", 1), ("B", 2), ("C", 1), ("C", 2)]
    assert "CartesianProduct" not in plan(df) and "NestedLoop" not in plan(df)


# Ratios


def test_ratios_of_repeated_bars_equal_the_ratio(spark, make):
    rows = random_candles(3, [12, 9], gap_share=0)
    rows += [r[:4] + tuple(x + 1 for x in r[4:8]) + r[8:] for r in rows[2:5] + rows[13:15]]
    df = make(rows)
    pairs = spark.createDataFrame([("S0", "S1")], "base_symbol string, quote_symbol string")
    many = [(r.open, r.high, r.low, r.close) for r in ratio.ratios(df, pairs).collect()]
    one = [(r.open, r.high, r.low, r.close) for r in ratio.ratio(df, "S0", "S1", "1h").collect()]
    assert sorted(many) == sorted(one) and len(many) > 0


def test_ratios_of_a_bucketed_table_shuffle_no_bars(spark, make, tmp_path):
    df = make(random_candles(4, [40, 40, 30], gap_share=0))
    candles.save_bucketed(df, "bucketed_bars", str(tmp_path / "b"), 4)
    try:
        stored = spark.table("bucketed_bars")
        pairs = spark.sql("select * from values ('S0', 'S1'), ('S2', 'S1') as t(base_symbol, quote_symbol)")
        got = ratio.ratios(stored, pairs, placed=True)
        assert sorted(map(str, got.collect())) == sorted(map(str, ratio.ratios(df, pairs).collect()))
        assert "hashpartitioning(interval" not in plan(got)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        one = ratio.ratio(stored, "S0", "S1", "1h")
        assert "hashpartitioning" not in plan(one)
        assert sorted(map(str, one.collect())) == sorted(map(str, ratio.ratio(df, "S0", "S1", "1h").collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table bucketed_bars")


# The stored table


def test_catalog_from_footers(spark, make, tmp_path):
    root, readers = str(tmp_path / "t"), spark.conf.get("spark.sql.sources.useV1SourceList")
    assert candles.stored_series(spark, root).count() == 0
    rows = random_candles(6, [30, 20, 5])
    candles.append_candles(make(rows[:25]), root)
    candles.append_candles(make(rows), root)
    stored = candles.stored_series(spark, root)
    assert "PushedAggregation: [MIN(open_epoch), MAX(open_epoch), COUNT(*)]" in plan(stored)
    got = {(r.symbol, r.interval): (r.first_time, r.last_time, r["count"]) for r in stored.collect()}
    assert got == {k: (seconds(v[0][2]), seconds(v[-1][2]), len(v)) for k, v in by_series(rows).items()}
    df = candles.read_candles(spark, root)
    both = [sorted(map(tuple, catalog_rows.collect())) for catalog_rows in (catalog.coverage(df, ["s1"], "1h"), catalog.stored_coverage(stored, ["s1"], "1h"))]
    assert both[0] == both[1] and len(both[0]) == 1
    assert sorted(map(str, catalog.symbols_intervals(stored).collect())) == sorted(map(str, catalog.symbols_intervals(df).collect()))
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == readers


def test_a_load_counts_what_it_did(spark, make, tmp_path):
    root, rows = str(tmp_path / "t"), random_candles(7, [10])
    assert candles.append_candles(make(rows[:6] + rows[:2]), root) == {"rows": 8, "keys": 6, "written": 6}
    assert candles.append_candles(make(rows), root) == {"rows": 10, "keys": 10, "written": 4}
    assert candles.append_candles(make(rows), root) == {"rows": 10, "keys": 10, "written": 0}
    assert candles.append_candles(make([]), root) == {"rows": 0, "keys": 0, "written": 0}
    assert candles.read_candles(spark, root).count() == 10


def test_only_fragmented_series_are_rewritten(spark, make, tmp_path):
    root, staging = str(tmp_path / "t"), str(tmp_path / "s")
    rows = random_candles(8, [30, 20, 10], gap_share=0)
    candles.append_candles(make([r for r in rows if r[0] != "S0"] + rows[:9]), root)
    candles.append_candles(make(rows[:30]), root)
    before = {f for f in glob.glob(f"{root}/*/*/*.parquet") if "symbol=S0" not in f}
    done = candles.compact_fragments(spark, root, staging)
    assert [tuple(r) for r in done.collect()] == [("S0", "1h")]
    files = set(glob.glob(f"{root}/*/*/*.parquet"))
    assert before < files and len(files) == len(before) + 1
    assert sorted(map(tuple, candles.read_candles(spark, root).collect())) == sorted(rows)
    assert candles.compact_fragments(spark, root, staging).count() == 0
    assert set(glob.glob(f"{root}/*/*/*.parquet")) == files


def test_a_backlog_is_loaded_a_few_files_at_a_time(spark, tmp_path):
    folder = tmp_path / "in" / "spot" / "daily" / "klines" / "AAA" / "1d"
    folder.mkdir(parents=True)
    for day in range(5):
        start = seconds(T0) + day * 86400
        line = f"{start * 1000},1,2,0.5,1.5,10,{(start + 86400) * 1000 - 1},15,3,5,7.5,0"
        (folder / f"{day}.csv").write_text(f"{line}\n{line}\n")
    paths = {"root": str(tmp_path / "t"), "checkpoint": str(tmp_path / "c"), "counts": str(tmp_path / "n")}
    stream_load(spark, str(tmp_path / "in"), max_files=2, **paths).awaitTermination()
    counts = sorted(map(tuple, read_counts(spark, paths["counts"]).collect()))
    assert counts == [(0, 4, 2, 2), (1, 4, 2, 2), (2, 2, 1, 1)]
    assert candles.read_candles(spark, paths["root"]).count() == 5
    with pytest.raises(ValueError):
        stream_load(spark, str(tmp_path / "in"), max_files=2, max_bytes="1g", **paths)


def test_files_that_are_done_move_to_the_archive(spark, tmp_path):
    folder = tmp_path / "in" / "spot" / "daily" / "klines" / "AAA" / "1d"
    folder.mkdir(parents=True)
    paths = {"root": str(tmp_path / "t"), "checkpoint": str(tmp_path / "c"), "archive": str(tmp_path / "done")}
    for day in range(3):
        start = seconds(T0) + day * 86400
        (folder / f"{day}.csv").write_text(f"{start * 1000},1,2,0.5,1.5,10,{(start + 86400) * 1000 - 1},15,3,5,7.5,0\n")
        stream_load(spark, str(tmp_path / "in"), **paths).awaitTermination()
    assert candles.read_candles(spark, paths["root"]).count() == 3
    moved = [f for _, _, names in os.walk(tmp_path / "done") for f in names if f.endswith(".csv")]
    assert "0.csv" in moved


# Streamed bars


def test_bounds_of_all_intervals_equal_the_batch_ones(spark):
    moments = np.array([0, 86399, 1709164800, 1709251199, 1709251200, 1735689599, 1735689600, 345600, 345599])
    ticks = spark.createDataFrame([("A", datetime(1970, 1, 1) + timedelta(seconds=int(s)), k, 1.0) for k, s in enumerate(moments)], "symbol string, ts timestamp_ntz, seq long, value double")
    got = {(r.interval, seconds(r.open_time)) for r in candles_from_ticks(ticks, INTERVALS).collect()}
    assert got == {(i, int(s)) for i in INTERVALS for s in bars.bounds(i, moments)[0]}


def test_streamed_bars_with_late_and_repeated_ticks(spark, tmp_path):
    rng = random.Random(11)
    schema = "symbol string, ts timestamp_ntz, seq long, value double"
    ticks = [(rng.choice("AB"), T0 + timedelta(seconds=rng.randint(0, 60 * 86400)), k, round(rng.uniform(1, 9), 2)) for k in range(900)]
    late = [t for t in ticks if t[2] % 10 == 0]
    first = [t for t in ticks if t[2] % 10] + [(None, T0, -1, 1.0), ("A", None, -2, 1.0), ("A", T0, -3, None)]
    intervals, where = ["1h", "1d", "1w", "1M"], {c: str(tmp_path / c) for c in ("in", "path", "checkpoint")}
    newest = [t for t in first if t[1] is not None and t[2] >= 0 and t[1] > max(x[1] for x in first if x[1] is not None) - timedelta(minutes=90)]
    for part in (first, late + newest):
        spark.createDataFrame(part, schema).repartition(3).write.mode("append").parquet(where["in"])
        stream = spark.readStream.schema(schema).parquet(where["in"])
        bars.start_parts(stream, where["path"], where["checkpoint"], intervals=intervals, slots=3).awaitTermination()
    parts = bars.read_parts(spark, where["path"])
    mark = max(t[1] for t in first if t[1] is not None and t[2] >= 0) - timedelta(hours=1)
    width = {i: timedelta(seconds=INTERVAL_SECONDS[i]) for i in intervals}

    def end(interval, t):
        start = max(g for g in grid(interval) if g <= t)
        return min(g for g in grid(interval) if g > t) if interval == "1M" else start + width[interval]

    want = sorted((i, t[0], t[2]) for t in late for i in intervals if end(i, t[1]) <= mark)
    assert sorted((r.interval, r.symbol, r.seq) for r in bars.late_ticks(parts).collect()) == want and want
    exact = ["symbol", "interval", "open_time", "close_time", "open", "high", "low", "close", "number_of_trades"]
    whole = spark.createDataFrame(ticks, schema)
    batch = {tuple(r) for r in candles_from_ticks(whole, intervals).select(*exact).collect()}
    got = bars.candles_from_parts(parts, with_late=True).select(*exact).collect()
    assert {tuple(r) for r in got} == {b for b in batch if b[3] + timedelta(milliseconds=1) <= mark} and got
    assert {r.interval for r in got} == set(intervals)


# Requests


def test_requests_are_judged_as_the_functions_judge_their_arguments(spark):
    rng = random.Random(5)
    asked = [
        (rng.choice(["btc", "BTC1", "é9", "a-b", "", "x" * 21, "x_y"]), rng.choice(["1h", "1M", "7m"]), rng.choice([None, 1, 5]), rng.choice([None, 5, 9]), rng.choice([None, 0, 1]), rng.choice([0, 1, 500, 501]))
        for _ in range(200)
    ]
    df = spark.createDataFrame([(*a, "asc") for a in asked], "symbol string, interval string, from long, to long, limit long, length long, order string")
    for r in requests.checked(df).collect():
        steps = {"symbol": (check_symbol, [r.symbol]), "interval": (check_interval, [r.interval]), "range": (check_range, [r["from"], r.to]), "limit": (check_limit, [r.limit]), "length": (check_length, [r.length])}
        broken = []
        for name, (step, given) in steps.items():
            try:
                step(*given)
            except ValueError:
                broken.append(name)
        assert r.problem == (broken[0] if broken else None)
