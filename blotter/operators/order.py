"""Order of small results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def ordered(df: DataFrame, *order: Column | str) -> DataFrame:
    """Orders a result whose rows are bounded by the calendar or by a fixed domain (days, hours,
    areas, labels): they go to one task and are sorted there, which saves the sampling job and the
    range exchange of a sort of unbounded rows."""
    return df.repartition(1).sortWithinPartitions(*order)
