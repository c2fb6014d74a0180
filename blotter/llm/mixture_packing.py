"""Packing of tokenized documents into windows that hold every source in its proportion.

Every source has a queue of its documents in pseudo-random order, and a target: its share of
all tokens. A window of ``CAPACITY`` tokens is filled by deficit round-robin: each source's
deficit grows by its share of the window, and the sources in turn send as many tokens as their
deficit allows, once it has reached ``GRAIN`` tokens (or the rest of their queue). A source
whose share of a window is less than a grain waits for several windows; what it is owed, or has
been given ahead to fill a window, is carried on. Documents are cut where a turn or a window
ends. Each token is packed once and windows have no padding: the tokens that are left at the end
of a partition fill windows whose lengths are the powers of two of their number.

Partitions are packed in parallel. Partition b of B holds the b-th B-th part of every queue,
in whole grains, so all partitions have the proportions of the corpus, and what a source is owed
where a partition begins is known beforehand: its share of all tokens of the partitions before,
less its own tokens there. The deficits of a partition start with this carry.

A queue may hold any share of the rows: its running totals are taken in hashed runs of about
``RUN_ROWS`` rows, whose sums are added up per source; a long document is queued in chunks of
``CHUNK`` tokens, each at a place of its own. Texts are encoded once and never
shuffled: the ids are written to the shared folder, planning uses ids and numbers of rows,
and at the end each chunk's ids meet the list of its pieces.

Defined cases: a null text is empty and has the end id alone; a null source is a source of
its own; repeated rows are packed each on its own; documents of equal doc_id are told apart by
their row's place in the input; an empty table gives an empty result; other columns are
ignored, whatever their names. Very long texts are encoded whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import word_bpe
from .common import block_of, blocks_for, scratch_path

CAPACITY, GRAIN, END_ID = 4096, 256, 2
#: tokens of a partition, of a queued chunk of a document, rows of a run of a queue
PARTITION_TOKENS, CHUNK, RUN_ROWS = 1 << 22, 1 << 16, 10_000


def capacities(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the windows for so many tokens: full ones, then powers of two."""
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [1 << i for i in reversed(range(rest.bit_length())) if rest >> i & 1]


def fill(queues: list[list[int]], shares: list[float], deficits: list[float],
         capacity: int = CAPACITY, grain: int = GRAIN) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Deficit round-robin over queues of documents (given by their lengths).

    Yields (queue, document, start, length, window, offset). ``deficits`` is updated in place.
    """
    left = np.array([sum(q) for q in queues], np.int64)
    share, deficit = np.array(shares, np.float64), np.array(deficits, np.float64)
    head, begun = [0] * len(queues), [0] * len(queues)
    turn = 0
    for window, room in enumerate(capacities(int(left.sum()), capacity)):
        size = room
        waiting = np.where(left > 0, share, 0.0)
        if waiting.sum() <= 0:  # only sources without a share are left
            waiting = (left > 0).astype(np.float64)
        deficit += size * waiting / waiting.sum()
        pieces: list[list[int]] = []

        def send(q: int, n: int):
            nonlocal room
            left[q] -= n
            deficit[q] -= n
            while n:
                doc, at = head[q], begun[q]
                some = min(n, queues[q][doc] - at)
                if pieces and pieces[-1][0] == q and pieces[-1][1] == doc:
                    pieces[-1][3] += some
                else:
                    pieces.append([q, doc, at, some, size - room])
                n, room = n - some, room - some
                head[q], begun[q] = (doc + 1, 0) if at + some == queues[q][doc] else (doc, at + some)

        ready = np.flatnonzero((left > 0) & (deficit >= np.minimum(grain, left)))
        first = np.searchsorted(ready, turn)
        last = -1
        for q in np.concatenate([ready[first:], ready[:first]]).tolist():
            send(q, min(room, int(left[q]), int(deficit[q])))
            last = q
            if not room:
                break
            turn = q + 1  # a source that a full window stops is the first of the next one
        else:
            turn %= len(queues)
        while room:  # tokens ahead of time: to the last one for less than a grain, else to the largest deficit
            q = last if room < grain and last >= 0 and left[last] else int(np.where(left > 0, deficit, -np.inf).argmax())
            send(q, min(room, int(left[q]), max(grain, int(deficit[q]))))
            last = q
        for q, doc, at, n, offset in pieces:
            yield q, doc, at, n, window, offset
    deficits[:] = deficit.tolist()


def encoded(docs: DataFrame, vocabulary: str, chunk: int = CHUNK) -> DataFrame:
    """(row, doc_id, skey, doc_tokens, chunk, size, ids): the ids of all documents in chunks,
    each document with its end id; written to the shared folder. ``row`` numbers the rows."""
    d = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                    F.coalesce(F.concat(F.lit("0"), "source"), F.lit("1")).alias("skey"),
                    F.coalesce("text", F.lit("")).alias("text"))
    schema = T.StructType([d.schema["row"], d.schema["doc_id"], d.schema["skey"], T.StructField("doc_tokens", T.LongType()),
                           T.StructField("chunk", T.LongType()), T.StructField("size", T.LongType()),
                           T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_bpe.encoder(vocabulary)
        end = np.array([END_ID], encode.dtype)
        for b in batches:
            done = 0
            for ids, ends in encode(b.column(3).cast(pa.string())):
                of, tokens, number, size, parts = [], [], [], [], []
                for i, (x, y) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
                    mine = np.concatenate([ids[x:y], end])
                    for c in range(0, len(mine), chunk):
                        of.append(done + i)
                        tokens.append(len(mine))
                        number.append(c // chunk)
                        size.append(min(chunk, len(mine) - c))
                        parts.append(mine[c:c + chunk].tobytes())
                done += len(ends)
                take = pa.array(of, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(i).take(take) for i in range(3)), *(pa.array(v, pa.int64()) for v in (tokens, number, size)),
                     pa.array(parts, pa.binary())], names=schema.names)

    path = scratch_path(docs.sparkSession, "packed-ids")
    # small row groups: a writer holds one in memory
    d.mapInArrow(run, schema).write.option("parquet.block.size", 16 << 20).parquet(path)
    return docs.sparkSession.read.parquet(path)


def queued(chunks: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """(row, chunk, skey, size, at, total): each chunk's place in its source's queue, and the
    tokens of the source."""
    d = chunks.select("row", "chunk", "skey", "size").withColumn(
        "h", F.shiftrightunsigned(F.xxhash64("row", "chunk"), 32))
    d = d.withColumn("run", block_of(F.col("h"), blocks_for(chunks.count(), run_rows)))
    runs = d.groupBy("skey", "run").agg(F.sum("size").alias("run_size"))
    before = Window.partitionBy("skey").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    bases = runs.select("skey", "run", F.coalesce(F.sum("run_size").over(before), F.lit(0)).alias("base"))
    totals = runs.groupBy("skey").agg(F.sum("run_size").alias("total"))
    in_run = Window.partitionBy("skey", "run").orderBy("h", "row", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    return (d.join(bases.join(totals, "skey"), ["skey", "run"])
            .withColumn("at", F.col("base") + F.coalesce(F.sum("size").over(in_run), F.lit(0)))
            .select("row", "chunk", "skey", "size", "at", "total"))


def dealt(queue: DataFrame, partitions: int, grain: int = GRAIN) -> DataFrame:
    """Cuts the chunks where partitions begin: (block, skey, row, chunk, first, size, at, begin,
    total). ``begin`` is the source's tokens in all partitions before."""
    grains = f"((total + {grain - 1}) div {grain})"
    # partition b begins at grain floor(b * grains / B) of the queue; the product needs more than 64 bits
    block_at = f"cast((cast(%s div {grain} + 1 as decimal(20,0)) * {partitions} - 1) div {grains} as bigint)"
    begin = f"least(total, cast(cast(block as decimal(20,0)) * {grains} div {partitions} as bigint) * {grain})"
    end = f"least(total, cast(cast(block + 1 as decimal(20,0)) * {grains} div {partitions} as bigint) * {grain})"
    return (queue.withColumn("block", F.explode(F.expr(
                f"sequence({block_at % 'at'}, {block_at % '(at + size - 1)'})")))
            .withColumns({"begin": F.expr(begin), "_end": F.expr(end)})
            .withColumns({"_from": F.greatest("at", "begin"), "_to": F.least(F.col("at") + F.col("size"), F.col("_end"))})
            .where("_to > _from")
            .select("block", "skey", "row", "chunk", (F.col("_from") - F.col("at")).alias("first"),
                    (F.col("_to") - F.col("_from")).alias("size"), F.col("_from").alias("at"), "begin", "total"))


def _windows(tokens, capacity: int):
    rest = tokens % capacity
    return F.floor(tokens / capacity).cast("long") + F.bit_count(rest)


def plan(chunks: DataFrame, shares: dict[str | None, float] | None = None, capacity: int = CAPACITY,
         grain: int = GRAIN, partition_tokens: int = PARTITION_TOKENS) -> DataFrame:
    """(row, chunk, first, length, sequence_id, offset): the pieces of the chunks.

    ``shares`` gives other target proportions by source name (0 for those left out); they
    hold while a source's part of the queue lasts.
    """
    tokens = chunks.agg(F.sum("size")).first()[0] or 0
    parts = dealt(queued(chunks), blocks_for(tokens, partition_tokens), grain)
    per_block = parts.groupBy("block").agg(F.sum("size").alias("tokens"))
    # one row per partition: the sums over all partitions before run in one task
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_block.select("block", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(n) for c, n in
                                        ((F.col("tokens"), "done"), (_windows(F.col("tokens"), capacity), "windows"))])
    share = F.col("total") / F.lit(float(max(tokens, 1)))
    if shares is not None:
        known = {("1" if k is None else "0" + k): v / sum(shares.values()) for k, v in shares.items()}
        share = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in known.items() for x in kv]), F.col("skey")), F.lit(0.0))
    owed = share * F.col("done") - F.col("begin")
    rows = parts.join(bases, "block").select(
        "block", "skey", "at", "row", "chunk", "first", "size", "windows", share.alias("share"),
        F.greatest(F.least(owed, F.lit(float(capacity))), F.lit(-float(capacity))).alias("owed"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["skey", "at"], ignore_index=True)
        starts = np.flatnonzero(np.concatenate([[True], pdf["skey"].to_numpy()[1:] != pdf["skey"].to_numpy()[:-1]]))
        sizes = pdf["size"].tolist()
        queues = [sizes[a:b] for a, b in zip(starts, [*starts[1:], len(sizes)])]
        got = np.array(list(fill(queues, pdf["share"].to_numpy()[starts], pdf["owed"].to_numpy()[starts].tolist(),
                                 capacity, grain)), np.int64).reshape(-1, 6)
        at = starts[got[:, 0]] + got[:, 1]
        return pd.DataFrame({"row": pdf["row"].to_numpy()[at], "chunk": pdf["chunk"].to_numpy()[at],
                             "first": pdf["first"].to_numpy()[at] + got[:, 2], "length": got[:, 3],
                             "sequence_id": pdf["windows"].iloc[0] + got[:, 4], "offset": got[:, 5]})

    return rows.groupBy("block").applyInPandas(
        run, "row long, chunk long, first long, length long, sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary: str, shares: dict[str | None, float] | None = None, capacity: int = CAPACITY,
         grain: int = GRAIN, partition_tokens: int = PARTITION_TOKENS, chunk: int = CHUNK,
         checksums: bool = False) -> DataFrame:
    """(doc_id, doc_tokens, start, length, sequence_id, offset, ids): every piece with its ids
    (32-bit little-endian), or with their ``ids_crc32`` in place of them."""
    chunks = encoded(docs, vocabulary, chunk)
    pieces = plan(chunks, shares, capacity, grain, partition_tokens).groupBy("row", "chunk").agg(
        F.array_sort(F.collect_list(F.struct("first", "length", "sequence_id", "offset"))).alias("pieces"))
    d = chunks.join(pieces, ["row", "chunk"]).select("doc_id", "doc_tokens", "chunk", "size", "ids", "pieces")
    last = T.StructField("ids_crc32", T.LongType()) if checksums else T.StructField("ids", T.BinaryType())
    schema = T.StructType([d.schema["doc_id"], d.schema["doc_tokens"], *[T.StructField(c, T.LongType()) for c in
                           ("start", "length", "sequence_id", "offset")], last])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(5)
            first, length, sequence, offset = lists.flatten().flatten()
            row = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
            values: list = [None] * len(row)
            at, a, n, sizes = 0, first.to_numpy(), length.to_numpy(), b.column(3).to_pylist()
            for r, raw in enumerate(b.column(4)):
                raw = raw.as_buffer()
                ids = np.frombuffer(raw, f"<u{raw.size // sizes[r]}").astype("<u4")
                while at < len(row) and row[at] == r:
                    piece = ids[a[at]:a[at] + n[at]].tobytes()
                    values[at] = zlib.crc32(piece) if checksums else piece
                    at += 1
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(take), b.column(1).take(take), pa.array(b.column(2).to_numpy()[row] * chunk + a), length,
                 sequence, offset, pa.array(values, pa.int64() if checksums else pa.binary())], names=schema.names)

    return d.mapInArrow(run, schema)
