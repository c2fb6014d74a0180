"""Connected components of a link table, by alternating large-star and small-star steps.

Every step replaces links by links to the smallest neighbour, so a component shrinks to a
star around its smallest node in a few rounds. Steps are grouped minima and joins; the
links of a round are written to the shared checkpoint folder. A node with very many links
is a skewed join key that adaptive execution splits, and its minimum is pre-aggregated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("hi", "lo").union(links.select("lo", "hi")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.join(least, "u").where("v > u")
            .select(F.col("v").alias("hi"), F.least("u", "m").alias("lo")))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = (links.join(least, "hi").where("lo > m")
             .select(F.col("lo").alias("hi"), F.col("m").alias("lo")))
    return moved.union(least.toDF("hi", "lo")).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) of any orientation -> (node, root) for every linked node.

    The root is the smallest node of the component. Loops, repeated and null links are
    ignored; no links give an empty result.
    """
    now = saved(links.where("a <> b")
                .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                .distinct())
    state = _state(now)
    while state[0]:
        after = saved(_small_star(_large_star(now)))
        before, state = state, _state(after)
        now = after
        if state == before:
            break
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
        now.select("lo", "lo").distinct())
