"""Series work that never puts a whole series into one task.

A series can be very long, and one series may hold a large share of the table, so a window
over (symbol, interval) alone is unsafe. Every operator that needs the order of a series goes
through one of these steps instead:

- a *chunk* is a stretch of time that fits at most `chunk_bars` bars of the series' interval;
- chunk summaries (a count, a maximum, a last value, ...) come from a plain aggregation, which
  combines before it shuffles, and are carried from chunk to chunk by a window over the chunk
  summaries, which are fewer than the bars by the factor `chunk_bars`;
- the carried value is joined back by (series, chunk), and the remaining window runs inside one
  chunk;
- a frame that looks back a number of bars runs inside one chunk that also holds copies of the
  bars before it.

Results are exact for any chunk size; `chunk_bars` only sets the size of a task's share.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barline.functions.time import epoch_seconds, interval_seconds
from barline.schemas import SERIES

CHUNK_BARS = 65536


def chunk_of(chunk_bars: int = CHUNK_BARS) -> Column:
    """Number of the chunk that holds a bar."""
    return F.floor(epoch_seconds("open_time") / (interval_seconds("interval") * chunk_bars)).cast("bigint")


def with_chunk(df: DataFrame, chunk_bars: int = CHUNK_BARS) -> DataFrame:
    return df.withColumn("chunk", chunk_of(chunk_bars))


def carry(
    df: DataFrame,
    keys: list[str],
    chunk: str,
    summary: dict[str, Column],
    *across: Callable[[WindowSpec, WindowSpec], dict[str, Column]],
) -> DataFrame:
    """One row per (series, chunk) with values carried over from the series' other chunks.

    `summary` aggregates a chunk. Each step of `across` gets two windows, over the chunks before
    a chunk (the nearest last) and over those after it (the nearest last, too), and turns the
    summaries, and the results of the steps before it, into new columns.
    """
    carried = df.groupBy(*keys, chunk).agg(*[c.alias(name) for name, c in summary.items()])
    series = W.partitionBy(*keys)
    past, later = [
        series.orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow - 1)
        for order in (F.asc(chunk), F.desc(chunk))
    ]
    for step in across:
        carried = carried.withColumns(step(past, later))
    return carried.drop(*summary)


def with_carried(df, keys, chunk, summary, *across) -> DataFrame:
    """Rows of `df` with the carried values of their chunk.

    Windows inside a chunk belong before this join, whose sort they already provide.
    """
    return df.join(carry(df, keys, chunk, summary, *across), [*keys, chunk])


def bar_counts(df: DataFrame, keys: list[str] = SERIES) -> DataFrame:
    """Per (series, chunk): the bars in it, in the chunks before it and in those after it."""
    return carry(
        df,
        keys,
        "chunk",
        {"n": F.count(F.lit(1))},
        lambda past, later: {
            "here": F.col("n"),
            "before": F.coalesce(F.sum("n").over(past), F.lit(0)),
            "after": F.coalesce(F.sum("n").over(later), F.lit(0)),
        },
    )


def _edge(df, n, keys, chunk_bars, backward) -> DataFrame:
    rows = with_chunk(df, chunk_bars)
    ahead = F.col("after" if backward else "before")
    needed = bar_counts(rows, keys).where(ahead < n).select(*keys, "chunk", ahead.alias("ahead"))
    time = F.desc("open_time") if backward else F.asc("open_time")
    inside = F.row_number().over(W.partitionBy(*keys, "chunk").orderBy(time))
    rows = rows.join(needed, [*keys, "chunk"]).withColumn("place", F.col("ahead") + inside)
    return rows.where(F.col("place") <= n).drop("chunk", "ahead", "place")


def first_n(df: DataFrame, n: int, keys: list[str] = SERIES, chunk_bars: int = CHUNK_BARS) -> DataFrame:
    """The n earliest bars of every series.

    A bar's place is the number of bars in the chunks before its own, plus its place there, so a
    series stays split however large n is. Chunks past the n-th bar are dropped first.
    """
    return _edge(df, n, keys, chunk_bars, backward=False)


def last_n(df: DataFrame, n: int, keys: list[str] = SERIES, chunk_bars: int = CHUNK_BARS) -> DataFrame:
    """The n latest bars of every series, by the same route from the other end."""
    return _edge(df, n, keys, chunk_bars, backward=True)


def _halos(rows: DataFrame, halo: int, keys: list[str]) -> DataFrame:
    """Copies of the `halo` bars before every chunk, under that chunk's number.

    They are among the last `halo` bars of the chunks before it: usually of the one before, and
    of several if those have few bars. Each task keeps the last bars of its chunks before the
    shuffle. A bar in place p of its series belongs to the chunks that have p .. p + halo - 1
    bars before them; matching by p's and the chunks' multiples of `halo` makes that an equal
    join.
    """
    counts = bar_counts(rows, keys)
    from_end = F.row_number().over(W.partitionBy(*keys, "chunk").orderBy(F.desc("open_time")))
    tails = rows.withColumn("from_end", from_end).where(F.col("from_end") <= halo)
    ends = counts.select(*keys, "chunk", (F.col("before") + F.col("here")).alias("end"))
    tails = tails.join(ends, [*keys, "chunk"]).withColumn("place", F.col("end") - F.col("from_end") + 1)
    step = F.floor(F.col("place") / halo)
    tails = tails.drop("chunk", "end", "from_end").withColumn("step", F.explode(F.array(step, step + 1)))
    starts = counts.where(F.col("before") > 0).select(
        *keys, "chunk", "before", F.floor(F.col("before") / halo).alias("step")
    )
    near = F.col("before").between(F.col("place"), F.col("place") + halo - 1)
    return tails.join(starts, [*keys, "step"]).where(near).select(*rows.columns)


def over_chunks(
    df: DataFrame,
    halo: int,
    steps: Callable[[DataFrame, WindowSpec], DataFrame],
    keys: list[str] = SERIES,
    chunk_bars: int = CHUNK_BARS,
) -> DataFrame:
    """Runs a row-frame computation that looks back at most `halo` bars, chunk by chunk.

    Each chunk also gets the `halo` bars before it, which serve as its past and are dropped
    again. `steps` adds columns with the window it is given; `pos` numbers the bars it sees, so
    pos > n for n <= halo says that a bar has n bars before it. Keeps `chunk` for a next step.
    """
    rows = with_chunk(df, chunk_bars)
    bars = rows.withColumn("home", F.lit(True))
    if halo:
        bars = bars.unionByName(_halos(rows, halo, keys).withColumn("home", F.lit(False)))
    w = W.partitionBy(*keys, "chunk").orderBy("open_time")
    return steps(bars.withColumn("pos", F.row_number().over(w)), w).where("home").drop("home", "pos")
