"""Operators that follow the order of a series, against plain loops, with chunks of a few bars."""

import statistics

import pytest
from pyspark.sql import functions as F
from helpers import by_series, random_candles, seconds

from barline.operators import backtest, indicators
from barline.operators.chunks import first_n, last_n, over_chunks
from barline.schemas import SERIES

LENGTHS = [1, 2, 3, 7, 40, 113, 0]
CHUNKS = [1, 5, 16, 65536]
ROWS = random_candles(7, LENGTHS)
ZERO_ROWS = random_candles(8, [1, 2, 9, 60, 150], zero_share=0.1)
OPEN, HIGH, LOW, CLOSE = 4, 5, 6, 7


def collect(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("chunk_bars", CHUNKS)
@pytest.mark.parametrize("n", [1, 6, 50])
def test_first_and_last_n(make, n, chunk_bars):
    for cut, part in ((first_n, lambda b: b[:n]), (last_n, lambda b: b[-n:])):
        got = collect(cut(make(ROWS), n, chunk_bars=chunk_bars), *SERIES, "open_time")
        assert got == sorted((*k, b[2]) for k, bars in by_series(ROWS).items() for b in part(bars))


def plain_sma(bars, length):
    closes = [b[CLOSE] for b in bars]
    return {
        seconds(bars[i][2]): sum(closes[i + 1 - length : i + 1]) / length for i in range(length - 1, len(bars))
    }


@pytest.mark.parametrize("chunk_bars", CHUNKS)
@pytest.mark.parametrize("cap", [None, 30])
@pytest.mark.parametrize("length", [1, 5, 20])
def test_sma(make, length, cap, chunk_bars):
    got = {(s, i, t): v for s, i, t, v in indicators.sma(make(ROWS), length, cap, chunk_bars).collect()}
    want = {
        (*k, t): v for k, bars in by_series(ROWS).items() for t, v in plain_sma(bars[:cap], length).items()
    }
    assert got == pytest.approx(want)


@pytest.mark.parametrize("chunk_bars", CHUNKS)
@pytest.mark.parametrize("cap", [None, 10])
def test_signals_thirds(make, cap, chunk_bars):
    got = collect(indicators.signals_thirds(make(ROWS), cap, chunk_bars), *SERIES, "time", "text")
    want = []
    for k, bars in by_series(ROWS).items():
        bars = bars[:cap]
        n = len(bars)
        if n >= 2:
            buy = n // 3
            exit_ = min(max(buy + 1, n * 2 // 3), n - 1)
            want += [(*k, seconds(bars[buy][2]), "Long"), (*k, seconds(bars[exit_][2]), "Exit")]
    assert got == sorted(want)


@pytest.mark.parametrize("chunk_bars", CHUNKS)
@pytest.mark.parametrize("last", [None, 1, 25])
def test_equity_with_zero_closes(make, last, chunk_bars):
    curve = backtest.equity(make(ZERO_ROWS), last, 10000.0, chunk_bars)
    got = {(s, i, t): v for s, i, t, v in curve.select(*SERIES, "open_time", "value").collect()}
    want = {}
    for k, bars in by_series(ZERO_ROWS).items():
        bars = bars[-last:] if last else bars
        value, previous = 10000.0, bars[0][CLOSE]
        for b in bars:
            if previous:
                value *= 1 + (b[CLOSE] - previous) / previous
            want[(*k, b[2])] = value
            previous = b[CLOSE]
    assert got == pytest.approx(want)


@pytest.mark.parametrize("chunk_bars", CHUNKS)
@pytest.mark.parametrize("cap", [None, 10])
def test_total_return(make, cap, chunk_bars):
    rows = backtest.total_return(make(ZERO_ROWS), cap, chunk_bars)
    got = {(r.symbol, r.interval): (r.total_return_pct, r.win_rate_pct, r.trade_count) for r in rows.collect()}
    want = {}
    for k, bars in by_series(ZERO_ROWS).items():
        bars = bars[:cap]
        if len(bars) >= 2:
            a, z = bars[0][CLOSE], bars[-1][CLOSE]
            value = (z - a) / a * 100 if a else None
            want[k] = (value, None if value is None else (100.0 if value >= 0 else 0.0), 1)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k])


@pytest.mark.parametrize("chunk_bars", CHUNKS)
def test_risk(make, chunk_bars):
    curve = make(ROWS).selectExpr("symbol", "interval", "open_time", "close as value")
    got = {(r.symbol, r.interval): r for r in backtest.risk(curve, 365, chunk_bars).collect()}
    for k, bars in by_series(ROWS).items():
        values = [b[CLOSE] for b in bars]
        peak, fall = 0.0, 0.0
        for v in values:
            peak = max(peak, v)
            fall = min(fall, v / peak - 1)
        gains = [b / a - 1 for a, b in zip(values, values[1:])]
        sharpe = None
        if len(gains) >= 2:
            sharpe = statistics.mean(gains) / statistics.stdev(gains) * 365**0.5
        assert got[k].bars == len(bars)
        assert got[k].max_drawdown_pct == pytest.approx(fall * 100)
        assert got[k].sharpe == (None if sharpe is None else pytest.approx(sharpe))


def crossings(bars, fast, slow):
    """Signal per bar of the two-average rule."""
    closes = [b[CLOSE] for b in bars]

    def mean(i, n):
        return sum(closes[i + 1 - n : i + 1]) / n if i + 1 >= n else None

    out = [None] * len(bars)
    for i in range(1, len(bars)):
        f, s, f0, s0 = mean(i, fast), mean(i, slow), mean(i - 1, fast), mean(i - 1, slow)
        if None not in (f, s, f0, s0):
            out[i] = "buy" if f > s and f0 <= s0 else "exit" if f < s and f0 >= s0 else None
    return out


@pytest.mark.parametrize("chunk_bars", CHUNKS)
def test_ma_cross(make, chunk_bars):
    got = collect(indicators.ma_cross(make(ROWS), 3, 8, chunk_bars), *SERIES, "time", "signal")
    want = [
        (*k, seconds(b[2]), s)
        for k, bars in by_series(ROWS).items()
        for b, s in zip(bars, crossings(bars, 3, 8))
        if s
    ]
    assert got == sorted(want) and want


@pytest.mark.parametrize("chunk_bars", CHUNKS)
def test_breakout(make, chunk_bars):
    got = collect(indicators.breakout(make(ROWS), 4, 6, chunk_bars), *SERIES, "time")
    want = []
    for k, bars in by_series(ROWS).items():
        ranges = [None] + [
            max(b[HIGH] - b[LOW], abs(b[HIGH] - a[CLOSE]), abs(b[LOW] - a[CLOSE])) for a, b in zip(bars, bars[1:])
        ]
        for i in range(6, len(bars)):
            top, atr = max(b[HIGH] for b in bars[i - 4 : i]), sum(ranges[i - 5 : i + 1]) / 6
            if bars[i][CLOSE] > top and bars[i][CLOSE] - bars[i - 1][CLOSE] > atr:
                want.append((*k, seconds(bars[i][2])))
    assert got == sorted(want) and want


@pytest.mark.parametrize("chunk_bars", CHUNKS)
def test_net_equity_and_trades(make, chunk_bars):
    curve = backtest.net_equity(make(ROWS), 3, 8, 1000.0, 10, 5, chunk_bars)
    got = {(s, i, t): (h, v) for s, i, t, h, v in curve.select(*SERIES, "open_time", "held", "value").collect()}
    rows = backtest.trades(make(ROWS), 3, 8, 2.0, chunk_bars)
    got_trades = collect(rows, *SERIES, "entry_time", "entry_price")
    got_exits = {(r.symbol, r.entry_time): (r.exit_time, r.exit_price, r.pnl) for r in rows.collect()}
    want, entries, exits = {}, [], {}
    for k, bars in by_series(ROWS).items():
        held, value, entry = 0, 1000.0, None
        for i, (b, signal) in enumerate(zip(bars, crossings(bars, 3, 8))):
            if held:
                value *= b[CLOSE] / bars[i - 1][CLOSE]
            now = {"buy": 1, "exit": 0, None: held}[signal]
            if now != held:
                value *= 1 - 15 / 1e4
                if now:
                    entry = b
                    entries.append((*k, seconds(b[2]), b[CLOSE]))
                    exits[(k[0], seconds(b[2]))] = (None, None, None)
                else:
                    exits[(k[0], seconds(entry[2]))] = (seconds(b[2]), b[CLOSE], 2.0 * (b[CLOSE] - entry[CLOSE]))
            held = now
            want[(*k, b[2])] = (held, value)
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert {k: v[1] for k, v in got.items()} == pytest.approx({k: v[1] for k, v in want.items()})
    assert got_trades == sorted(entries) and entries
    assert got_exits.keys() == exits.keys()
    for k in exits:
        assert got_exits[k] == pytest.approx(exits[k])


@pytest.mark.parametrize("chunk_bars", CHUNKS)
@pytest.mark.parametrize("halo", [0, 1, 4, 30])
def test_every_bar_sees_the_bars_before_it(make, halo, chunk_bars):
    rows = ROWS + random_candles(4, [30], interval="1M", gap_share=0)

    def steps(bars, w):
        return bars.withColumn("past", F.collect_list("open_time").over(w.rowsBetween(-halo, -1 if halo else 0)))

    seen = over_chunks(make(rows), halo, steps, chunk_bars=chunk_bars)
    got = {(r.symbol, r.interval, r.open_time): r.past for r in seen.collect()}
    want = {}
    for k, bars in by_series(rows).items():
        for i, b in enumerate(bars):
            want[(*k, b[2])] = [x[2] for x in (bars[max(0, i - halo) : i] if halo else [b])]
    assert got == want and seen.count() == len(rows)


def test_length_is_checked(make):
    with pytest.raises(ValueError):
        indicators.sma(make(ROWS), 0)
    with pytest.raises(ValueError):
        indicators.sma(make(ROWS), 501)


# Plan shapes


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def windows_over_whole_series(text):
    """Windows that follow the bars' time and are split by nothing but the series."""
    return [
        line
        for line in text.splitlines()
        if "Window [" in line and "open_time" in line.split("windowspecdefinition")[-1] and "chunk" not in line
    ]


@pytest.mark.parametrize(
    "run",
    [
        indicators.sma,
        lambda df: indicators.sma(df, limit=10**8),
        indicators.ma_cross,
        indicators.breakout,
        backtest.net_equity,
        backtest.trades,
        lambda df: backtest.risk(df.selectExpr("symbol", "interval", "open_time", "close as value")),
        indicators.signals_thirds,
        lambda df: indicators.signals_thirds(df, 10**8),
        lambda df: backtest.total_return(df, 10**8),
        backtest.equity,
        lambda df: backtest.equity(df, 10**8),
        backtest.metrics,
        lambda df: first_n(df, 10**8),
        lambda df: last_n(df, 10**8),
    ],
)
def test_no_window_runs_over_a_whole_series(make, run):
    assert windows_over_whole_series(plan(run(make(ROWS)))) == []


def test_copied_bars_are_picked_before_the_shuffle(make):
    assert "WindowGroupLimit" in plan(indicators.sma(make(ROWS), 500))


def test_no_job_runs_while_a_plan_is_built(spark, make):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    df = make(ROWS)
    for build in (lambda: first_n(df, 5), lambda: indicators.signals_thirds(df), lambda: backtest.equity(df, 5)):
        build()
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


@pytest.mark.parametrize("chunk_bars", CHUNKS)
def test_metrics_come_from_the_curve_and_the_trades(make, chunk_bars):
    got = {(r.symbol, r.interval): r for r in backtest.metrics(make(ROWS), 3, 8, 1000.0, 10, 5, chunk_bars).collect()}
    curve = backtest.net_equity(make(ROWS), 3, 8, 1000.0, 10, 5, chunk_bars).orderBy("open_time").collect()
    done = backtest.trades(make(ROWS), 3, 8, 1.0, chunk_bars).collect()
    assert len(got) == len(by_series(ROWS))
    for k, r in got.items():
        values = [c.value for c in curve if (c.symbol, c.interval) == k]
        pnl = [t.pnl for t in done if (t.symbol, t.interval) == k]
        closed = [p for p in pnl if p is not None]
        assert r.bars == len(values) and r.final_value == pytest.approx(values[-1])
        assert r.total_return_pct == pytest.approx((values[-1] / 1000 - 1) * 100)
        assert (r.trade_count, r.closed_count) == (len(pnl), len(closed))
        assert r.win_rate_pct == (pytest.approx(100 * sum(p > 0 for p in closed) / len(closed)) if closed else None)


def test_sharpe_follows_the_interval(make):
    rows = random_candles(3, [50], interval="1h") + random_candles(3, [50], interval="1d")
    curve = make(rows).selectExpr("symbol", "interval", "open_time", "close as value")
    got = {r.interval: r.sharpe for r in backtest.risk(curve).collect()}
    assert got["1h"] == pytest.approx(got["1d"] * 24**0.5)
