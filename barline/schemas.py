"""Fixed schemas, fixed values and parameter checks."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

# Supported bar lengths and their length in seconds. A month counts as its
# shortest length; the figure only sizes chunks and is never used as a calendar month.
INTERVAL_SECONDS = {
    "1m": 60,
    "3m": 180,
    "5m": 300,
    "15m": 900,
    "30m": 1800,
    "1h": 3600,
    "2h": 7200,
    "4h": 14400,
    "6h": 21600,
    "8h": 28800,
    "12h": 43200,
    "1d": 86400,
    "3d": 259200,
    "1w": 604800,
    "1M": 2419200,
}
INTERVALS = list(INTERVAL_SECONDS)

# Defaults of the candle queries, and the longest average.
DEFAULT_LENGTH = 20
MAX_LENGTH = 500
EQUITY_START = 10000.0
BATCH_SIZE = 25
SYMBOL_LETTERS = 20

YEAR_SECONDS = 365 * 86400

SERIES = ["symbol", "interval"]
KEY = ["symbol", "interval", "open_time"]

# Positional columns of a raw kline file.
RAW = T.StructType(
    [
        T.StructField("open_time", T.LongType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("close_time", T.LongType()),
        T.StructField("quote_asset_volume", T.DoubleType()),
        T.StructField("number_of_trades", T.LongType()),
        T.StructField("taker_buy_base_volume", T.DoubleType()),
        T.StructField("taker_buy_quote_volume", T.DoubleType()),
        T.StructField("ignore", T.DoubleType()),
    ]
)

# The candle table. Times are UTC wall-clock. Every column is required, and
# (symbol, interval, open_time) is unique; operators/quality.py checks both.
CANDLE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("interval", T.StringType()),
        T.StructField("open_time", T.TimestampNTZType()),
        T.StructField("close_time", T.TimestampNTZType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("quote_asset_volume", T.DoubleType()),
        T.StructField("number_of_trades", T.LongType()),
        T.StructField("taker_buy_base_volume", T.DoubleType()),
        T.StructField("taker_buy_quote_volume", T.DoubleType()),
    ]
)

# Columns of a served candle, in output order.
SERVED = [
    "time",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "quote_asset_volume",
    "number_of_trades",
    "taker_buy_base_volume",
    "taker_buy_quote_volume",
]

UNIVERSE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("base_asset", T.StringType()),
        T.StructField("quote_asset", T.StringType()),
        T.StructField("order_types", T.ArrayType(T.StringType())),
        T.StructField("permissions", T.ArrayType(T.StringType())),
        T.StructField("is_margin_trading_allowed", T.BooleanType()),
        T.StructField("position", T.LongType()),
    ]
)

MARGIN_MODES = ["none", "cross", "isolated", "any"]
BORROWABLE_MODES = ["base", "quote", "both", "any"]
FREQUENCIES = ["daily", "monthly"]
ORDERS = ["asc", "desc"]


def check_choice(name, value, allowed):
    if value not in allowed:
        raise ValueError(f"{name} must be one of {', '.join(allowed)}, not {value!r}")
    return value


def check_limit(limit):
    """A limit is given or None, which means all rows."""
    if limit is not None and limit < 1:
        raise ValueError(f"limit must be at least 1, not {limit}")
    return limit


def check_length(length):
    if not 1 <= length <= MAX_LENGTH:
        raise ValueError(f"length must lie in 1..{MAX_LENGTH}, not {length}")
    return length


def check_range(from_, to):
    if from_ is not None and to is not None and from_ >= to:
        raise ValueError("from_ must be lower than to")


def check_interval(interval):
    return check_choice("interval", interval, INTERVALS)


def check_symbol(symbol):
    if re.fullmatch(rf"[^\W_]{{1,{SYMBOL_LETTERS}}}", symbol) is None:
        raise ValueError(f"a symbol has up to {SYMBOL_LETTERS} letters and digits, unlike {symbol!r}")
    return symbol.upper()


def check_legs(base, quote):
    base, quote = check_symbol(base), check_symbol(quote)
    if base == quote:
        raise ValueError("the two legs of a ratio must differ")
    return base, quote


@dataclass(frozen=True)
class UniverseFilter:
    """Which symbols of an exchange's universe a run takes."""

    quote_asset: str | None = None
    market_orders: bool = False
    margin: str = "none"
    borrowable: str | None = None

    def __post_init__(self):
        check_choice("margin", self.margin, MARGIN_MODES)
        if self.borrowable is not None:
            check_choice("borrowable", self.borrowable, BORROWABLE_MODES)


@dataclass(frozen=True)
class Backfill:
    """A run that fills gaps: one interval, a range of days, and a symbol list or a universe filter."""

    interval: str
    first_day: str
    last_day: str
    destination: str
    symbols: tuple[str, ...] = ()
    universe: UniverseFilter | None = None
    freq: str = "daily"
    batch_size: int = BATCH_SIZE

    def __post_init__(self):
        if bool(self.symbols) == (self.universe is not None):
            raise ValueError("give either symbols or a universe filter")
        check_interval(self.interval)
        check_choice("freq", self.freq, FREQUENCIES)
        if self.batch_size < 1:
            raise ValueError("a batch holds one symbol or more")
        if str(self.first_day) > str(self.last_day):
            raise ValueError("first_day must not be after last_day")
