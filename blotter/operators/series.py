"""Trailing windows over long series, without one task for the whole series.

A row-based trailing window over an ordered series needs, at each row, only the rows just
before it. ``halo_window`` cuts the series into blocks of neighbouring rows, gives every block the
last rows of the blocks before it (its halo), and runs the window in each block by itself. The
halo of a block comes from the last ``before`` rows of each earlier block: every block has a row
at least, so the nearest ``before`` blocks hold enough of them, however short blocks are and
whatever gaps lie between them. Only those tails (one row a block) pass through a window over
all blocks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def halo_window(rows: DataFrame, order: str, block: Column, before: int,
                measures: Callable[[WindowSpec], dict[str, Column]], keys: list[str] | None = None) -> DataFrame:
    """Adds ``measures`` over the trailing window of the series of each of the ``keys``.

    ``order`` orders a series and is unique and not null in it; ``block`` must not fall as it
    grows. ``measures`` gets a window in row order, to which it adds a frame that reaches back
    ``before`` rows at most.
    """
    keys = list(keys or [])
    row = F.struct(*[F.col(c) for c in rows.columns])
    cut = rows.select(*keys, block.alias("_block"), F.col(order).alias("_at"), row.alias("_row"))
    # the last rows of every block, in order
    last = cut.withColumn("_n", F.row_number().over(
        Window.partitionBy(*keys, "_block").orderBy(F.col("_at").desc()))).where(F.col("_n") <= before)
    tails = last.groupBy(*keys, "_block").agg(F.array_sort(F.collect_list(F.struct("_at", "_row"))).alias("_tail"))
    nearest = Window.partitionBy(*keys).orderBy("_block").rowsBetween(-before, -1)
    earlier = F.flatten(F.collect_list("_tail").over(nearest))
    halo = tails.withColumn("_earlier", earlier).select(
        *keys, "_block", F.explode(F.slice("_earlier", F.greatest(F.size("_earlier") - before, F.lit(0)) + 1, F.lit(before)))
        .alias("_e")).select(*keys, "_block", "_e._at", "_e._row", F.lit(True).alias("_halo"))
    every = cut.withColumn("_halo", F.lit(False)).unionByName(halo).select("_block", "_halo", "_row.*")
    w = Window.partitionBy(*keys, "_block").orderBy(order)
    return every.withColumns(measures(w)).where(~F.col("_halo")).drop("_block", "_halo")
