import random

import pytest
from pyspark.sql import functions as F

from barline.operators import backfill, runs, universe as u
from barline.schemas import UNIVERSE, Backfill, UniverseFilter

SYMBOLS = [
    ("BTCUSDT", "TRADING", "BTC", "USDT", ["LIMIT", "MARKET"], ["SPOT"], True, 0),
    ("ETHUSDT", "BREAK", "ETH", "USDT", ["LIMIT", "MARKET"], ["SPOT"], False, 1),
    ("BNBBTC", "TRADING", "BNB", "BTC", ["LIMIT"], ["SPOT"], False, 2),
]


@pytest.fixture(scope="module")
def base(spark):
    return spark.createDataFrame(SYMBOLS, UNIVERSE)


@pytest.fixture(scope="module")
def listed(spark):
    return lambda *names: spark.createDataFrame([(n,) for n in names], "key string")


def names(df):
    return [r.symbol for r in df.collect()]


def test_status_quote_and_order_filters(base):
    assert names(u.tradable_symbols(base)) == ["BNBBTC", "BTCUSDT"]
    assert names(u.tradable_symbols(base, "usdt", True)) == ["BTCUSDT"]
    assert u.tradable_symbols(base).columns == base.columns


def test_margin_and_borrowable_filters(base, listed):
    rows = u.tradable_symbols(
        base, "USDT", margin="any", isolated=listed("ETHUSDT"), borrowable=listed("BTC"), require_borrowable="base"
    )
    assert names(rows) == ["BTCUSDT"]
    assert names(u.tradable_symbols(base, margin="isolated", isolated=listed("BNBBTC"))) == ["BNBBTC"]
    assert names(u.tradable_symbols(base, margin="cross", cross=listed("BNBBTC"))) == ["BNBBTC", "BTCUSDT"]
    assert names(u.tradable_symbols(base, margin="isolated")) == []
    for mode, want in {"base": [], "quote": ["BNBBTC"], "both": [], "any": ["BNBBTC"]}.items():
        assert names(u.tradable_symbols(base, "BTC", borrowable=listed("BTC"), require_borrowable=mode)) == want
    with pytest.raises(ValueError):
        u.margin_ok(base, "all")
    with pytest.raises(ValueError):
        u.borrowable_ok(base, "neither", listed("BTC"))


def test_eligible_keys(spark):
    pairs = spark.createDataFrame([("A", True), ("B", False), ("A", True), ("", True)], "symbol string, ok boolean")
    assert names(u.eligible_keys(pairs, "symbol", "ok")) == ["A"]


def verdicts(df):
    return {r.symbol: r.verdict for r in df.collect()}


def test_verdicts(spark, base, listed):
    asked = spark.createDataFrame([("btcusdt", 0), ("ethusdt", 1), ("missingusdt", 2), ("btcusdt", 3)], "symbol string, place int")
    checked = u.check_symbols(asked, base)
    assert verdicts(checked) == {"BTCUSDT": "tradable", "ETHUSDT": "not_trading", "MISSINGUSDT": "missing"}
    assert sorted((r.place, r.symbol) for r in checked.collect())[3] == (3, "BTCUSDT")
    assert {r.verdict: r.symbols for r in u.verdict_counts(checked).collect()} == {"tradable": 2, "not_trading": 1, "missing": 1}
    out = u.check_symbols(asked.where("place = 0"), base, "cross", borrowable=listed("BTC"), require_borrowable="quote")
    assert verdicts(out) == {"BTCUSDT": "filtered_out"}


def test_the_last_of_repeated_universe_rows_counts(spark, base):
    first = base.withColumn("position", F.lit(0))
    later = base.where("symbol = 'ETHUSDT'").withColumn("status", F.lit("TRADING")).withColumn("position", F.lit(9))
    asked = spark.createDataFrame([("ETHUSDT",)], "symbol string")
    assert verdicts(u.check_symbols(asked, first.unionByName(later))) == {"ETHUSDT": "tradable"}
    with pytest.raises(ValueError, match="position"):
        u.check_symbols(asked, base.drop("position"))


def test_configured_universe_and_stats(spark, base):
    asked = spark.createDataFrame([("btcusdt",), ("abc",)], "symbol string")
    rows = u.configured_universe(asked)
    assert names(rows) == ["BTCUSDT", "ABC"] and {r.status for r in rows.collect()} == {"CONFIGURED"}
    assert rows.select(*UNIVERSE.fieldNames()).schema.simpleString() == UNIVERSE.simpleString()
    assert tuple(u.resolution_stats(u.tradable_symbols(base), base).first()) == (2, "tradable", 3)
    assert tuple(u.resolution_stats(rows, source="config").first()) == (2, "config", None)


@pytest.mark.parametrize("prefixes", [(1,), (1, 2), (2, 4, 5), (20,)])
def test_ranks_and_batches(spark, prefixes):
    rng = random.Random(len(prefixes))
    want = sorted({"".join(rng.choice("ABC1") for _ in range(rng.randint(1, 6))) for _ in range(200)})
    df = spark.createDataFrame([(s,) for s in rng.sample(want, len(want))], "symbol string")
    assert [r.symbol for r in u.ranked(df, prefixes).orderBy("place").collect()] == want
    got = {r.symbol: r.batch for r in u.with_batch(df, 7).collect()}
    assert got == {s: i // 7 for i, s in enumerate(want)}
    placed = df.withColumn("at", F.lit(13))
    assert {r.batch for r in u.with_batch(placed, 7, "at").collect()} == {1}
    with pytest.raises(ValueError):
        u.with_batch(df, 0)


def attempts(spark, rows):
    return spark.createDataFrame(rows, "url string, attempt int, status int, error string")


def outcome(url, tries, retries, expected_missing):
    """A file's outcome by walking through its tries."""
    status = error = None
    for attempt, (s, e) in enumerate(tries[: retries + 1]):
        if s is not None:
            status = s
        if e is None and s == 200:
            return (url, 200, True, None, "downloaded")
        error = e or f"HTTP {s}"
        if s in expected_missing:
            return (url, s, True, error, "missing_remote")
    return (url, status, False, error, "failed")


def test_outcomes_against_a_loop(spark):
    rng = random.Random(3)
    cases = {}
    for i in range(150):
        tries = []
        for _ in range(rng.randint(1, 5)):
            s = rng.choice([200, 404, 500, None])
            tries.append((s, "timeout" if s is None or rng.random() < 0.1 else None))
        cases[f"u{i}"] = tries
    rows = [(u_, n + 1, s, e) for u_, tries in cases.items() for n, (s, e) in enumerate(tries)]
    for expected in ((), (404,)):
        got = runs.outcome_from_attempts(attempts(spark, rows), expected)
        assert sorted(map(tuple, got.collect())) == sorted(outcome(u_, t, 2, expected) for u_, t in cases.items())


def test_landed_files_are_skipped(spark):
    log = attempts(spark, [("a", 1, 200, None), ("b", 1, 500, None)])
    landed = spark.createDataFrame([("a",), ("c",)], "url string")
    got = {r.url: (r.result, r.ok, r.status) for r in runs.outcome_from_attempts(log, landed=landed).collect()}
    assert got == {"a": ("skipped", True, None), "b": ("failed", False, 500), "c": ("skipped", True, None)}


def test_outcome_counts_and_status(spark):
    log = [(0, "downloaded", True), (0, "other", True), (0, "other", False), (1, "skipped", True), (1, "missing_remote", True)]
    counts = runs.outcome_counts(spark.createDataFrame(log, "batch int, result string, ok boolean"))
    got = {r.batch: tuple(r)[1:] for r in counts.collect()}
    assert got == {0: (3, 2, 0, 0, 1), 1: (2, 0, 1, 1, 0)}
    assert tuple(runs.run_totals(counts).first()) == (5, 1)

    def status(**kw):
        return [r.status for r in runs.batch_status(counts, **kw).orderBy("batch").collect()]

    assert status() == ["failed", "complete"]
    assert status(continue_on_error=True) == ["complete_with_errors", "complete"]
    assert status(dry_run=True) == ["dry_run", "dry_run"]


def test_failure_digest(spark):
    rows = [(0, i, f"u{i}", 500 if i % 2 else None, None if i % 2 else "timeout") for i in range(7)] + [(1, 0, "x", 404, None)]
    df = spark.createDataFrame(rows, "batch int, position int, url string, status int, error string")
    got = {r.batch: (r.failed, r.message) for r in runs.failure_digest(df).collect()}
    assert got[0] == (7, "7 download(s) failed: u0 (timeout), u1 (500), u2 (timeout), u3 (500), u4 (timeout), and 2 more")
    assert got[1] == (1, "1 download(s) failed: x (404)")


def test_plan_counts_keep_empty_batches(spark):
    keys = spark.createDataFrame([("A",), ("A",), ("B",)], "symbol string")
    batches = spark.createDataFrame([("A", 0), ("B", 0), ("C", 1)], "symbol string, batch int")
    got = sorted(map(tuple, runs.plan_counts(keys, batches).collect()))
    assert got == [(0, 2, 3), (1, 1, 0)]


def test_order_blotter(spark):
    orders = spark.createDataFrame([("x", "BTCUSDT"), ("x", "ETHUSDT"), ("y", "BTCUSDT")], "account_id string, symbol string")
    assert runs.order_blotter(orders).count() == 3
    assert runs.order_blotter(orders, "x").count() == 2
    assert runs.order_blotter(orders, "x", "btcusdt").count() == 1


def test_a_popular_quote_asset_is_spread(base, listed):
    text = u.borrowable_ok(base, "quote", listed("USDT"))._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(symbol" in text


def test_the_digest_keeps_few_rows_before_the_shuffle(spark):
    df = spark.createDataFrame([(0, 0, "u", 500, None)], "batch int, position int, url string, status int, error string")
    assert "WindowGroupLimit" in runs.failure_digest(df)._jdf.queryExecution().executedPlan().toString()


JOB = {"interval": "1d", "first_day": "2026-03-01", "last_day": "2026-04-10", "destination": "/in"}


def test_backfill_of_a_list(spark, make):
    config = Backfill(symbols=("zz", "btcusdt"), batch_size=1, freq="monthly", **JOB)
    symbols = backfill.resolve_symbols(spark, config)
    assert sorted((r.symbol, r.status, r.batch) for r in symbols.collect()) == [
        ("BTCUSDT", "CONFIGURED", 1),
        ("ZZ", "CONFIGURED", 0),
    ]
    assert names(backfill.resolve_symbols(spark, config, limit_symbols=1)) == ["ZZ"]
    files = backfill.plan_files(config, make([]), symbols, "https://d.test")
    assert sorted(r.path for r in files.collect()) == [
        f"/in/spot/monthly/klines/{s}/1d/{s}-1d-2026-03.zip" for s in ("BTCUSDT", "ZZ")
    ]
    landed = spark.createDataFrame([("/in/spot/monthly/klines/ZZ/1d/ZZ-1d-2026-03.zip",)], "path string")
    files = backfill.plan_files(config, make([]), symbols, "https://d.test", landed)
    assert [r.symbol for r in files.collect()] == ["BTCUSDT"]
    assert backfill.plan_files(config, make([]), symbols, "https://d.test", landed, force=True).count() == 2
    planned = backfill.all_files(config, make([]), symbols, "https://d.test")
    got = sorted(map(tuple, backfill.dry_run(planned, symbols).collect()))
    assert got == [(0, 1, 1, "dry_run"), (1, 1, 1, "dry_run")]
    daily = Backfill(symbols=("zz", "btcusdt"), **JOB)
    assert backfill.plan_files(daily, make([]), symbols, "https://d.test").count() == 2 * 41


def test_run_record(spark):
    job = Backfill(universe=UniverseFilter("USDT", margin="any"), **JOB)
    batches = spark.createDataFrame([(0, 3, 0, "complete"), (1, 2, 1, "failed")], "batch bigint, url_count bigint, failed bigint, status string")
    inserted = spark.createDataFrame([(0, "/b"), (0, "/a")], "batch bigint, path string")
    symbols = spark.createDataFrame([("A",), ("B",)], "symbol string")
    r = backfill.run_record(job, symbols, batches, inserted).first()
    assert (r.source, r.quote_asset, r.margin, r.market_orders, r.freq) == ("universe", "USDT", "any", False, "daily")
    assert (r.symbol_count, r.url_count, r.failed, r.status) == (2, 5, 1, "failed")
    assert (r.batches, r.inserted) == (2, 2)
    each = backfill.run_batches(batches, inserted).collect()
    assert sorted((b.batch, b.status, b.inserted) for b in each) == [(0, "complete", 2), (1, "failed", 0)]
    assert backfill.run_record(job, symbols, batches).first().inserted == 0


def test_backfill_of_the_tradable_universe(spark, base, listed):
    config = Backfill(universe=UniverseFilter(quote_asset="usdt", market_orders=True), **JOB)
    assert names(backfill.resolve_symbols(spark, config, base)) == ["BTCUSDT"]
    for extra in ({"margin": "any"}, {"borrowable": "base"}):
        with pytest.raises(ValueError):
            backfill.resolve_symbols(spark, Backfill(universe=UniverseFilter(**extra), **JOB), base)
    with pytest.raises(ValueError):
        backfill.resolve_symbols(spark, config)
