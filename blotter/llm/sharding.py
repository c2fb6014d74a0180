"""Byte-balanced sharding of indivisible groups by Karmarkar-Karp differencing.

Documents with equal texts are one group and go to one shard. A partial partition is a
vector of shard sums; at first every group is one, with its bytes on one side. The two
partial partitions with the largest spread are combined again and again, oppositely
ordered (largest sum with smallest), until one is left.

Differencing is sequential, so it is done in two steps of bounded size:

* the groups that hold at least 1/(shards x ``HEAVY``) of all bytes; there can be no more
  than shards x ``HEAVY`` of them, so they are differenced on the driver. This settles
  the groups that no other group can balance, a hot group of copies among them;
* all other groups, hashed to blocks of about ``BLOCK_GROUPS``. Each block starts with
  its share of the heavy groups' partial partition and is differenced in one task, so
  every block evens out the heavy groups' remaining spread by its own part.

Documents get their shard by a join on the text's md5: for the heavy groups a broadcast
join (bounded as above, so a hot group is never shuffled by its key), for the rest a
shuffle whose keys hold a bounded number of bytes each.

Defined cases: a null text has no bytes and is a group of its own (its checksum is that of
no bytes); the empty text is another group; repeated rows are copies of a group; an empty
table gives an empty result; equal sizes are ordered by md5; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import block_of, blocks_for, saved, unit_hash

SHARDS = 24
ROW_BYTES = 8
HEAVY = 250
BLOCK_GROUPS = 20_000
SLOT_ROWS = 5_000


def difference(sizes: list[int], shards: int, start: list[float] | None = None) -> np.ndarray:
    """Shard of each item by Karmarkar-Karp differencing.

    ``start`` is a partial partition to build upon: its i-th sum already belongs to
    shard i. Without it shards are interchangeable and numbered as they come.
    """
    n = len(sizes)
    if not n:
        return np.empty(0, np.int64)
    sums: list[list[float]] = [[0] * (shards - 1) + [s] for s in sizes]  # ascending
    order0 = None
    if start is not None:
        order0 = sorted(range(shards), key=lambda i: start[i])
        sums.append([start[i] for i in order0])
    made: list[tuple[int, int, list[int]]] = []  # node -> its two parts and their order
    leaves = len(sums)
    heap = [(v[0] - v[-1], i) for i, v in enumerate(sums)]
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        both = [x + y for x, y in zip(sums[a], reversed(sums[b]))]
        order = sorted(range(shards), key=both.__getitem__)
        v = [both[i] for i in order]
        sums[a] = sums[b] = None
        made.append((a, b, order))
        sums.append(v)
        heapq.heappush(heap, (v[0] - v[-1], len(sums) - 1))
    # walk back from the last partition: shard of every position of every part
    place: list[list[int] | None] = [None] * len(sums)
    place[-1] = list(range(shards))
    for node in range(len(sums) - 1, leaves - 1, -1):
        a, b, order = made[node - leaves]
        here = [0] * shards
        for position, was in enumerate(order):
            here[was] = place[node][position]
        place[a], place[b], place[node] = here, here[::-1], None
    shard = np.array([place[i][-1] for i in range(n)], np.int64)
    if start is not None:  # name the shards as the given partition does
        name = np.empty(shards, np.int64)
        for position, s in enumerate(order0):
            name[place[n][position]] = s
        shard = name[shard]
    return shard


def _measured(docs: DataFrame) -> DataFrame:
    text = F.col("text")
    return docs.select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.md5(text.cast("binary")), F.lit("null")).alias("key"))


def assign(groups: DataFrame, shards: int = SHARDS, heavy: int = HEAVY,
           block_groups: int = BLOCK_GROUPS) -> tuple[DataFrame, DataFrame]:
    """(key, bytes) -> the shards (key, shard) of the heavy and of all other groups."""
    spark = groups.sparkSession
    total, count = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count("*")).first()
    limit = -(-total // (shards * heavy)) or 1
    big = groups.where(F.col("bytes") >= limit).orderBy(F.desc("bytes"), "key").collect()
    placed = difference([r["bytes"] for r in big], shards)
    sums = np.zeros(shards)
    np.add.at(sums, placed, [r["bytes"] for r in big])
    of_big = spark.createDataFrame([(r["key"], int(s)) for r, s in zip(big, placed)],
                                   "key string, shard int")
    small = groups.where(F.col("bytes") < limit)
    blocks = blocks_for(count - len(big), block_groups)
    light = max(1, total - int(sums.sum()))

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "key"], ascending=[False, True])
        part = float(pdf["bytes"].sum()) / light
        pdf["shard"] = difference(pdf["bytes"].tolist(), shards, (sums * part).tolist())
        return pdf[["key", "shard"]]

    of_small = (small.withColumn("block", block_of(unit_hash(F.col("key")), blocks))
                .groupBy("block").applyInPandas(block, "key string, shard int"))
    return of_big, of_small


def numbered(rows: DataFrame, by: str, h: str, per_block: int, count: int) -> DataFrame:
    """Adds ``slot``: gapless numbers from 0 within each value of ``by``, in the order of the
    32-bit key ``h``, counted in blocks so that a large value is no single task."""
    rows = rows.withColumn("_block", block_of(F.col(h), blocks_for(count, per_block)))
    sizes = rows.groupBy(by, "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(by, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(by, "_block").orderBy(h, "doc_id", "key")
    return (rows.join(bases, [by, "_block"])
            .withColumn("slot", F.col("_base") + F.row_number().over(inside) - 1)
            .drop("_block", "_base"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, heavy: int = HEAVY,
                    block_groups: int = BLOCK_GROUPS, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot), one row per document."""
    rows = saved(_measured(docs))
    groups = saved(rows.groupBy("key").agg(F.sum("size").alias("bytes")))
    of_big, of_small = assign(groups, shards, heavy, block_groups)
    # at most shards x heavy rows: the bound of ``assign``
    first = rows.join(F.broadcast(of_big.withColumnRenamed("shard", "big")), "key", "left")
    rest = first.where("big is null").drop("big").join(of_small, "key")
    placed = first.where("big is not null").withColumnRenamed("big", "shard").unionByName(rest)
    placed = placed.withColumn("h", F.coalesce(unit_hash(F.col("doc_id")), F.lit(0)))
    return (numbered(placed, "shard", "h", slot_rows * shards, rows.count())
            .select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot")))
