"""Conflict-constrained best-fit packing of documents into fixed-length sequences.

Every document is cut into chunks of at most ``capacity`` words; chunks are packed,
longest first, into bins of ``capacity`` words. A bin never holds two chunks of the same
source or of the same duplicate cluster (equal texts). Open bins stand in the order of
their residual and carry a bitmap of the sources and one of the clusters they hold. The
search starts at the smallest residual that fits and goes on to the next larger one until
it meets a compatible bin, which is then the tightest compatible one; without any, a new
bin is opened. Bins of equal residual and equal bitmaps stand together, so a hot source
or cluster is passed over in one step for each such group.

Best fit is sequential, so the documents are dealt to blocks by a hash of their own, about
``BLOCK_ROWS`` rows to a block whatever the size of the corpus, and each block is packed
in one task. Only ids, sizes, sources and text hashes travel, never texts. A hot source or
cluster is spread over all blocks.

Defined cases: a null or wordless text is one chunk of 0 words; a null source is a source
of its own; null texts are one cluster; a document longer than a bin fills bins of its own
and its last chunk is packed with others; repeated rows are packed each on its own (they
share a cluster, so never in one bin); equal lengths are ordered by doc_id and hash; an
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import block_of, blocks_for, unit_hash, word_count

CAPACITY = 2048
BLOCK_ROWS = 10_000


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int = CAPACITY) -> list[int]:
    """Bin of each item, in the order given. Items must not be larger than the capacity."""
    source_bit = {s: 1 << i for i, s in enumerate(dict.fromkeys(sources))}
    shared = [c for c, n in Counter(clusters).items() if n > 1]  # others never conflict
    cluster_bit = {c: 1 << i for i, c in enumerate(shared)}
    # levels[r]: the open bins of residual r, by their bitmaps; occupied: bit r is set if any
    levels: list[dict[tuple[int, int], list[int]]] = [{} for _ in range(capacity + 1)]
    occupied, bins, out = 0, 0, []
    for size, source, cluster in zip(sizes, sources, clusters):
        s, c = source_bit[source], cluster_bit.get(cluster, 0)
        found = None
        left = occupied >> size << size
        while left:
            r = (left & -left).bit_length() - 1
            found = next((k for k in levels[r] if not (k[0] & s or k[1] & c)), None)
            if found is not None:
                break
            left &= left - 1
        if found is None:
            r, found, number = capacity, (0, 0), bins
            bins += 1
        else:
            alike = levels[r][found]
            number = alike.pop()
            if not alike:
                del levels[r][found]
                if not levels[r]:
                    occupied &= ~(1 << r)
        levels[r - size].setdefault((found[0] | s, found[1] | c), []).append(number)
        occupied |= 1 << (r - size)
        out.append(number)
    return out


def chunks(docs: DataFrame, capacity: int) -> DataFrame:
    """(doc_id, chunk, first_word, words, skey, cluster), one row per chunk."""
    d = docs.select("doc_id", word_count(F.col("text")).alias("n"),
                    F.coalesce(F.concat(F.lit("0"), "source"), F.lit("1")).alias("skey"),
                    F.xxhash64("text").alias("cluster"))
    last = F.greatest(F.ceil(F.col("n") / capacity) - 1, F.lit(0))
    return (d.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
            .withColumn("first_word", F.col("chunk") * capacity)
            .withColumn("words", F.least(F.col("n") - F.col("first_word"), F.lit(capacity)))
            .drop("n"))


def pack(docs: DataFrame, capacity: int = CAPACITY, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, chunk, first_word, words, block, bin, start): one row per chunk. ``bin``
    numbers the bins of a block, ``start`` is the chunk's first place in its bin."""
    blocks = blocks_for(docs.count(), block_rows)
    # copies of a text differ in their ids, repeated rows are dealt by chance of the row's hash
    h = F.coalesce(unit_hash(F.col("doc_id")), F.col("cluster").bitwiseAND(F.lit(0xFFFFFFFF)))
    dealt = chunks(docs, capacity).withColumn("block", block_of(h, blocks))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["words", "doc_id", "cluster", "skey", "chunk"],
                              ascending=[False, True, True, True, True], na_position="last")
        pdf["bin"] = np.array(best_fit(pdf["words"].tolist(), pdf["skey"].tolist(),
                                       pdf["cluster"].tolist(), capacity), np.int64)
        pdf["start"] = pdf.groupby("bin")["words"].cumsum() - pdf["words"]
        return pdf[["doc_id", "chunk", "first_word", "words", "block", "bin", "start"]]

    return dealt.groupBy("block").applyInPandas(
        run, "doc_id long, chunk long, first_word long, words long, block long, bin long, start long")


def numbered_bins(packed: DataFrame) -> DataFrame:
    """Replaces (block, bin) by ``bin_id``, gapless from 0 over the corpus."""
    per_block = packed.groupBy("block").agg((F.max("bin") + 1).alias("bins"))
    # one row per block: the sum over all blocks before runs in one task
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = per_block.select("block", F.coalesce(F.sum("bins").over(before), F.lit(0)).alias("base"))
    return packed.join(base, "block").select(
        "doc_id", "chunk", "first_word", "words", (F.col("base") + F.col("bin")).alias("bin_id"), "start")
