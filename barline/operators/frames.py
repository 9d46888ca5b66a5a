"""Moving sums and maxima of any length at the same cost a bar.

Spark adds up a sliding frame anew for each row, so a moving average of 500 bars costs 25 times one
of 20. Here bars are cut into blocks as long as the frame. A frame then is the end of one block and the
beginning of the next: running values inside the blocks give both, and a lag brings the first to
the row of the second. All windows here lie inside the partitioning by (series, chunk) that the caller has.

A sum only ever takes away a part of a block from the block, so values outside of the two blocks
leave no trace in it; it agrees with the frame's own sum up to rounding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barline.schemas import SERIES

BLOCK = "block"


def along(keys: list[str] = SERIES, block: str = BLOCK):
    """The order of the bars of a chunk, in the form in which blocks have sorted them."""
    return W.partitionBy(*keys, "chunk").orderBy(block, "pos")


def with_blocks(bars: DataFrame, size: int, block: str = BLOCK) -> DataFrame:
    """Adds the number of the block of `size` bars; `pos` counts a chunk's bars from 1."""
    return bars.withColumn(block, F.floor((F.col("pos") - 1) / size).cast("bigint"))


def with_moving_means(bars: DataFrame, means: dict[str, tuple[str, int]], keys: list[str] = SERIES) -> DataFrame:
    """Adds, for each name, the mean of a column over the last so many bars; NULL before there are as many.

    A NULL counts as 0. Leaves `block`, whose order `along` has.
    """
    size = max(length for _, length in means.values())
    columns = {c for c, _ in means.values()}
    bars = with_blocks(bars, size)
    upto = W.partitionBy(*keys, "chunk", BLOCK).orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    bars = bars.withColumns({f"_upto_{c}": F.coalesce(F.sum(c).over(upto), F.lit(0.0)) for c in columns})
    whole = W.partitionBy(*keys, "chunk", BLOCK)
    bars = bars.withColumns({f"_rest_{c}": F.coalesce(F.sum(c).over(whole), F.lit(0.0)) - F.col(f"_upto_{c}") for c in columns})
    w = along(keys)

    def total(c: str, length: int) -> Column:
        inside = F.lag(BLOCK, length).over(w) == F.col(BLOCK)
        before = F.when(inside, -F.lag(f"_upto_{c}", length).over(w)).otherwise(F.lag(f"_rest_{c}", length, 0.0).over(w))
        return F.col(f"_upto_{c}") + F.coalesce(before, F.lit(0.0))

    bars = bars.withColumns({name: F.when(F.col("pos") >= n, total(c, n) / n) for name, (c, n) in means.items()})
    return bars.drop(*[f"_{part}_{c}" for part in ("upto", "rest") for c in columns])


def with_top_before(bars: DataFrame, name: str, column: str, length: int, keys: list[str] = SERIES) -> DataFrame:
    """Adds the greatest value of a column over the `length` bars before a bar; of fewer where there are fewer."""
    bars = with_blocks(bars, length, "_block")
    inside = W.partitionBy(*keys, "chunk", "_block")
    upto = F.max(column).over(inside.orderBy(F.desc("pos")).rowsBetween(W.unboundedPreceding, W.currentRow))
    bars = bars.withColumn("_from", upto)
    bars = bars.withColumn("_upto", F.max(column).over(inside.orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)))
    w = along(keys, "_block")
    top = F.greatest(F.lag("_upto").over(w), F.lag("_from", length).over(w))
    return bars.withColumn(name, top).drop("_block", "_from", "_upto")
