"""Text columns: symbols, intervals, object keys and paths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from barline.functions.time import _col
from barline.schemas import INTERVALS, SYMBOL_LETTERS

# Quote assets tried in this order as the end of a symbol.
QUOTE_SUFFIXES = ["USDT", "USDC", "FDUSD", "BTC", "ETH", "BNB"]


def split_symbol(col="symbol") -> tuple[Column, Column]:
    """(base, quote) by the first known suffix that leaves a base; else (symbol, '')."""
    symbol = _col(col)

    def pick(of_suffix, otherwise):
        return reduce(
            lambda rest, q: F.when(
                symbol.endswith(q) & (F.length(symbol) > len(q)), of_suffix(q)
            ).otherwise(rest),
            reversed(QUOTE_SUFFIXES),
            otherwise,
        )

    base = pick(lambda q: F.substring(symbol, F.lit(1), F.length(symbol) - len(q)), symbol)
    return base, pick(F.lit, F.lit(""))


def clean_symbol(col) -> Column:
    """Upper-cased symbol, or NULL if it is not 1..20 letters and digits, by the rule of `check_symbol`."""
    symbol = F.upper(_col(col))
    return F.when(symbol.rlike(rf"^[\p{{L}}\p{{N}}]{{1,{SYMBOL_LETTERS}}}\z"), symbol)


def is_interval(col="interval") -> Column:
    return _col(col).isin(INTERVALS)


def object_key(base_url, freq, symbol="symbol", interval="interval", day="day") -> Column:
    """Address of the archive that holds one day or one month of a series."""
    pattern = "yyyy-MM" if freq == "monthly" else "yyyy-MM-dd"
    symbol, interval = _col(symbol), _col(interval)
    return F.concat(
        F.lit(f"{base_url.rstrip('/')}/data/spot/{freq}/klines/"),
        F.concat_ws("/", symbol, interval, F.concat_ws("-", symbol, interval, F.date_format(_col(day), pattern))),
        F.lit(".zip"),
    )


def url_to_path(url, destination) -> Column:
    """Landing path of an address: its path without a leading data/ folder; NULL if none is left."""
    path = F.try_parse_url(_col(url), F.lit("PATH"))
    path = F.regexp_replace(path, r"/(\.?/)+", "/")
    path = F.regexp_replace(path, r"/\.?\z", "")
    path = F.regexp_replace(path, r"^/?(data(/|\z))?", "")
    return F.when(path != "", F.concat(F.lit(destination.rstrip("/") + "/"), path))
