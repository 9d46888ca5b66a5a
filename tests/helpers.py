"""Rows and orderings that several test files use."""

import random
from datetime import datetime, timedelta

from barline.schemas import INTERVAL_SECONDS

DATA = "/root/testdata/sf0.001"


def bar(symbol, interval, open_time, open_, high, low, close, volume=1.0, trades=1):
    close_time = open_time + timedelta(seconds=INTERVAL_SECONDS[interval], milliseconds=-1)
    half = volume / 2
    return (symbol, interval, open_time, close_time, open_, high, low, close, volume, volume, trades, half, half)


def random_candles(seed, lengths, zero_share=0.0, gap_share=0.3, interval="1h"):
    """Series of the given lengths with gaps; a seed makes them repeatable."""
    rng = random.Random(seed)
    rows = []
    for k, length in enumerate(lengths):
        t = datetime(2024, 1, 1)
        for _ in range(length):
            t += timedelta(seconds=INTERVAL_SECONDS[interval]) * (rng.randint(2, 40) if rng.random() < gap_share else 1)
            open_, close = rng.uniform(1, 100), rng.uniform(1, 100)
            if rng.random() < zero_share:
                close = 0.0
            high, low = max(open_, close) + rng.random(), min(open_, close) - rng.random()
            rows.append(bar(f"S{k}", interval, t, open_, high, low, close))
    return rows


def by_series(rows):
    """{(symbol, interval): bars in order} of plain rows."""
    out = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        out.setdefault((r[0], r[1]), []).append(r)
    return out


def seconds(t):
    return int((t - datetime(1970, 1, 1)).total_seconds())
