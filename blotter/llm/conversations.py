"""Repair of the turn structure of conversations with the cheapest edits.

A conversation's rows, in the order of their turns, are kept, given another role (cost 1) or
deleted (2), and empty user or assistant turns may be inserted anywhere (5), so that the first
letters of the roles read ``(s?(ua)+)?``. Blank rows and rows whose role and text stood earlier
must be deleted; a truncated row that is not deleted costs 5 more. Of the cheapest edit scripts
the one whose audit (initials of the edits K, R, D, I) comes first in ASCII order is taken.

Between two rows a script is in one of four states (nothing yet, after a system, user or
assistant turn). The script is found by divide and conquer in linear space: a forward vector
(cost of every state, and the order of the audits behind them) over the first half meets a
backward cost vector over the second half; of the states at which their sums are least, the one
with the least audit is the crossing, and both halves are solved in the same way. Audits of
two states at one place never begin with one another (each ends with the edit of the same row),
so their order decides the order of the whole scripts and four small ranks replace the strings.

A conversation may hold any share of the rows. Equal rows are counted before anything is
shuffled, the narrow rows (no texts) are range-sorted and cut into blocks of at most
``BLOCK`` rows; every block is reduced to its 4 x 4 vectors, the blocks of a conversation meet at
their crossings, and each block is then solved by itself. Only the audit, one letter per row and
a single cell of the result, is ever held as a whole for a conversation; the repaired
turns are a stream of sorted rows.

Defined cases: a null role or text is one space (blank rows go), a null conv_id is a
conversation of its own; null turns come first; rows of equal turn are ordered by role,
then by the SHA-256 of their text; rows that repeat exactly stand beside each other and all but
the first are duplicates; a role that does not begin with s, u or a cannot be kept; an empty
table gives empty results; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import scratch_path

#: white space of the ASCII range
BLANK = " \t\n\x0b\x0c\r"
#: rows of a block: 2 ** BLOCK_BITS
BLOCK_BITS = 11
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
FAR = 1 << 60
START, USER, ASSISTANT = 0, 2, 3
#: state reached from a state by a turn whose role begins with the letter
STEPS = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
#: state reached from a state by one inserted turn, or by a row given the role that fits
NEXT = [USER, USER, ASSISTANT, USER]
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: turns to insert at the end of a conversation
TO_END = [0, 2, 1, 0]

#: from a state: (state after, cost, order among the ways from the same state)
Ways = list[list[tuple[int, int, object]]]


@lru_cache(maxsize=None)
def row_ways(code: str) -> Ways:
    """Cheapest edits of one row, with inserted turns before it. ``code`` is ``d`` for a row
    that must go, else the role's letter, as a capital if the row is truncated."""
    extra = TRUNCATED_COST if code.isupper() else 0
    ways = []
    for before in range(4):
        best: dict[int, tuple[int, str]] = {}
        state = before
        for inserted in range(3):  # a third one leads back to a state already reached
            edits = [(state, DELETE_COST, "D")]
            if code != "d":
                edits.append((NEXT[state], REROLE_COST + extra, "R"))
                if code.lower() in STEPS[state]:
                    edits.append((STEPS[state][code.lower()], extra, "K"))
            for after, cost, letter in edits:
                way = (INSERT_COST * inserted + cost, "I" * inserted + letter)
                best[after] = min(best.get(after, way), way)
            state = NEXT[state]
        ways.append([(after, *way) for after, way in sorted(best.items())])
    return ways


def forward(parts: list[Ways], start: int) -> tuple[list[int], list[int]]:
    """Least cost from ``start`` to every state, and the order of the least audits."""
    cost, rank = [FAR] * 4, [0] * 4
    cost[start] = 0
    for ways in parts:
        best: list = [None] * 4
        for before in range(4):
            c, r = cost[before], rank[before]
            if c < FAR:
                for after, more, order in ways[before]:
                    way = (c + more, r, order)
                    if best[after] is None or way < best[after]:
                        best[after] = way
        cost = [FAR if b is None else b[0] for b in best]
        order = sorted((s for s in range(4) if best[s]), key=lambda s: best[s][1:])
        for i, s in enumerate(order):
            rank[s] = i
    return cost, rank


def backward(parts: list[Ways], end: list[int]) -> list[int]:
    """Least cost from every state to the end vector."""
    for ways in reversed(parts):
        end = [min((more + end[after] for after, more, _ in ways[before]), default=FAR)
               for before in range(4)]
    return end


def meeting(ahead: tuple[list[int], list[int]], behind: list[int]) -> int:
    """The state at which both halves cost least; of equals the one of the least audit."""
    cost, rank = ahead
    return min((s for s in range(4) if cost[s] < FAR), key=lambda s: (cost[s] + behind[s], rank[s]))


def crossings(parts: list[Ways], start: int, end: int) -> list[int]:
    """The state before the first part and after every part of the least script."""
    if len(parts) < 2:
        return [start, end][:len(parts) + 1]
    half = len(parts) // 2
    one_end = [FAR] * 4
    one_end[end] = 0
    middle = meeting(forward(parts[:half], start), backward(parts[half:], one_end))
    return crossings(parts[:half], start, middle) + crossings(parts[half:], middle, end)[1:]


@lru_cache(maxsize=20_000)
def block_vectors(codes: str) -> tuple[int, ...]:
    """Costs (16) and orders (16) of a block from every state to every state."""
    parts = [row_ways(c) for c in codes]
    vectors = [forward(parts, s) for s in range(4)]
    return tuple([c for v in vectors for c in v[0]] + [r for v in vectors for r in v[1]])


def block_ways(vectors: list[int]) -> Ways:
    """A block's vectors in the form of a row's ways."""
    return [[(after, vectors[4 * before + after], vectors[16 + 4 * before + after])
             for after in range(4) if vectors[4 * before + after] < FAR] for before in range(4)]


@lru_cache(maxsize=20_000)
def block_edits(codes: str, start: int, end: int) -> tuple[str, ...]:
    """Letters of every row of a block that leads from ``start`` to ``end``."""
    parts = [row_ways(c) for c in codes]
    at = crossings(parts, start, end)
    return tuple(next(w[2] for w in ways[a] if w[0] == b) for ways, a, b in zip(parts, at, at[1:]))


def damage(conversations: DataFrame) -> tuple[DataFrame, Column]:
    """Damaged rows and the number of times that each one stands: a hash of conversation
    and turn drops a row, empties it, takes its sentence marks, repeats it or sets its role."""
    c = conversations.select("conv_id", "turn", *[F.coalesce(x, F.lit(" ")).alias(x) for x in ("role", "text")])
    key = F.concat_ws(":", *[F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", "turn")])
    fate = F.crc32(key.cast("binary")) % 20
    text = (F.when(fate == 1, F.lit("")).when(fate == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")))
    role = F.when(fate == 4, F.lit("user")).otherwise(F.col("role"))
    damaged = c.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                       F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("copies"))
    return damaged, F.col("copies")


def _rows(conversations: DataFrame, copies: Column) -> DataFrame:
    none = F.lit(" ")
    return (conversations.withColumn("_copies", copies.cast("long")).where("_copies > 0")
            .select("conv_id", "turn", F.coalesce("role", none).alias("role"),
                    F.coalesce("text", none).alias("text"), "_copies")
            .withColumn("_hash", F.unhex(F.sha2("text", 256))))


_ORDER = ["conv_id", "turn", "role", "_hash"]  # ascending, nulls first


def _placed(rows: DataFrame) -> DataFrame:
    """Distinct narrow rows with their number and a ``place`` that grows in row order."""
    end = F.rtrim("text", F.lit(BLANK))
    mark = F.when(end == "", F.lit("b")).when(F.right(end, F.lit(1)).isin(*".!?"), F.lit("f")).otherwise(F.lit("t"))
    narrow = (rows.withColumn("mark", mark).groupBy(*_ORDER, "mark").agg(F.sum("_copies").alias("n")))
    path = scratch_path(rows.sparkSession, "conversation-rows")
    (narrow.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
     .withColumn("place", F.monotonically_increasing_id()).write.parquet(path))
    return rows.sparkSession.read.parquet(path)


def _blocks(placed: DataFrame) -> DataFrame:
    """One row per block of a conversation: its codes in row order and its counts."""
    firsts = placed.groupBy("conv_id", "role", "_hash").agg(F.min("place").alias("place"))
    d = placed.join(firsts.select("place", F.lit(True).alias("first")), "place", "left")
    letter = F.substring("role", 1, 1)
    letter = F.when(letter.isin("s", "u", "a"), letter).otherwise(F.lit("x"))
    blank = F.col("mark") == "b"
    fresh = ~blank & F.col("first").isNotNull()
    code = (F.when(~fresh, F.lit("d")).when(F.col("mark") == "t", F.upper(letter)).otherwise(letter))
    d = d.select("conv_id", F.shiftright("place", BLOCK_BITS).alias("block"), "turn", "n",
                 F.struct("place", code.alias("code"), letter.alias("letter"), "n").alias("row"),
                 blank.alias("blank"), fresh.alias("fresh"), (fresh & (F.col("mark") == "t")).alias("cut"))
    listed = d.groupBy("conv_id", "block").agg(
        F.array_sort(F.collect_list("row")).alias("rows"),
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.size(F.collect_set("turn")).alias("turns"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("n")) - F.col("fresh").cast("int")).alias("duplicate"),
        F.count_if("cut").alias("truncated"))
    text = lambda field: F.array_join(F.transform("rows", lambda r: r[field]), "")
    return listed.select("conv_id", "block", text("code").alias("codes"), text("letter").alias("letters"),
                         F.transform("rows", lambda r: r["n"]).alias("n"),
                         "low", "high", "turns", "blank", "duplicate", "truncated")


#: neighbouring role letters of a legal conversation
LEGAL = {"su", "ua", "au"}


def _reduced(blocks: DataFrame) -> DataFrame:
    """Adds every block's vectors and the number of its illegal neighbours; written."""
    schema = T.StructType([*blocks.schema, T.StructField("vectors", T.ArrayType(T.LongType())),
                           T.StructField("illegal", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes, letters, n = (b.column(i).to_pylist() for i in (2, 3, 4))
            illegal = [sum(n) - len(n) + sum(x + y not in LEGAL for x, y in zip(t, t[1:]))
                       for t, n in zip(letters, n)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([block_vectors(c) for c in codes], pa.list_(pa.int64())),
                 pa.array(illegal, pa.int64())], names=schema.names)

    path = scratch_path(blocks.sparkSession, "conversation-blocks")
    blocks.mapInArrow(run, schema).write.parquet(path)
    return blocks.sparkSession.read.parquet(path)


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _met(blocks: DataFrame) -> DataFrame:
    """(conv_id, block, start, end, tail, counts): the crossings between the blocks of every
    conversation; ``counts`` and the turns to insert at its end stand at its first block."""
    one = F.struct("block", "vectors", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal",
                   F.left("letters", F.lit(1)).alias("head"), F.right("letters", F.lit(1)).alias("last"),
                   F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x - 1).alias("more"))
    grouped = blocks.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("blocks"))
    schema = T.StructType([grouped.schema["conv_id"], T.StructField("block", T.LongType()),
                           T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                           T.StructField("tail", T.IntegerType()),
                           T.StructField("counts", T.ArrayType(T.LongType()))])

    def counted(blocks: list[dict], cost: int) -> list[int]:
        ranges = [(b["low"], b["high"]) for b in blocks if b["low"] is not None]
        turns = sum(b["turns"] for b in blocks) - sum(x[1] == y[0] for x, y in zip(ranges, ranges[1:]))
        gaps = max(r[1] for r in ranges) - min(r[0] for r in ranges) + 1 - turns if ranges else 0
        between = sum(x["last"] + y["head"] not in LEGAL for x, y in zip(blocks, blocks[1:]))
        total = [sum(b[k] for b in blocks) for k in ("blank", "duplicate", "truncated", "illegal")]
        total[-1] += between
        return [gaps, *total, cost]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in schema]
            for conv, blocks in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                parts = [block_ways(x["vectors"]) for x in blocks]
                ahead, to_end = forward(parts, START), [INSERT_COST * n for n in TO_END]
                end = meeting(ahead, to_end)
                cost = ahead[0][end] + to_end[end] + DELETE_COST * sum(x["more"] for x in blocks)
                at = crossings(parts, START, end)
                for i, x in enumerate(blocks):
                    for column, value in zip(out, (conv, x["block"], at[i], at[i + 1], 0 if i else TO_END[end],
                                                   None if i else counted(blocks, cost))):
                        column.append(value)
            types = [b.column(0).type, pa.int64(), *[pa.int32()] * 3, pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, out, types)), names=schema.names)

    return grouped.mapInArrow(run, schema)


def _audits(blocks: DataFrame, met: DataFrame) -> DataFrame:
    """(conv_id, counts, audit) of every conversation that has rows."""
    m = met.withColumnRenamed("conv_id", "_conv").withColumnRenamed("block", "_block")
    d = blocks.join(m, (F.col("block") == F.col("_block")) & F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "conv_id", "block", "codes", "n", "start", "end", "tail", "counts")
    schema = T.StructType([d.schema[c] for c in ("conv_id", "block", "tail", "counts")]
                          + [T.StructField("edits", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            edits = ["".join(e + "D" * (n - 1) for e, n in zip(block_edits(codes, start, end), ns))
                     for codes, ns, start, end in zip(*(b.column(i).to_pylist() for i in range(2, 6)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(6), b.column(7), pa.array(edits, pa.string())],
                                             names=schema.names)

    slices = F.array_sort(F.collect_list(F.struct("block", "edits")))
    return (d.mapInArrow(run, schema).groupBy("conv_id")
            .agg(slices.alias("slices"), F.max("counts").alias("counts"), F.max("tail").alias("tail"))
            .select("conv_id", "counts", F.concat(F.array_join(F.transform("slices", lambda s: s["edits"]), ""),
                                                  F.repeat(F.lit("I"), F.col("tail"))).alias("audit")))


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, place, turn, edit, role, text): the turns of the repaired conversations, each
    conversation in one partition and in order. A task reads the sorted rows as a stream and
    holds one audit at a time; inserted turns have a null turn."""
    s = rows.schema
    none = {c: F.lit(None).cast(s[c].dataType).alias(c) for c in ("turn", "role", "text", "_copies", "_hash")}
    stream = (audits.select("conv_id", F.lit(0).alias("kind"), "audit", *none.values())
              .union(rows.select("conv_id", F.lit(1), F.lit(None).cast("string"), *none))
              .repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "_hash").drop("_hash"))
    schema = T.StructType([s["conv_id"], T.StructField("place", T.LongType()), s["turn"],
                           T.StructField("edit", T.StringType()), T.StructField("role", T.StringType()),
                           T.StructField("text", T.StringType())])
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        conv, audit, at, state, place = None, "", 0, START, 0

        def inserted():
            nonlocal at, state, place
            while audit[at:at + 1] == "I":
                at, state, place = at + 1, NEXT[state], place + 1
                out.append((conv, place, None, "I", NAMES[state], ""))

        def batch(types):
            columns = zip(*out) if out else [[]] * len(schema)
            got = pa.RecordBatch.from_arrays(list(map(pa.array, map(list, columns), types)), names=schema.names)
            out.clear()
            return got

        types = None
        for b in batches:
            types = [b.column(0).type, pa.int64(), b.column(3).type, *[pa.string()] * 3]
            for key, kind, edits, turn, role, text, copies in zip(*(c.to_pylist() for c in b.columns)):
                if kind == 0:
                    inserted()  # at the end of the conversation before
                    conv, audit, at, state, place = key, edits, 0, START, 0
                    continue
                for _ in range(copies):
                    inserted()
                    edit, at = audit[at], at + 1
                    if edit == "D":
                        continue
                    state = NEXT[state] if edit == "R" else STEPS[state][role[0]]
                    place += 1
                    out.append((conv, place, turn, edit, NAMES[state] if edit == "R" else role, text))
            yield batch(types)
        if types:
            inserted()
            yield batch(types)

    return stream.mapInArrow(run, schema)


def repair(conversations: DataFrame, copies: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(reports, turns). ``reports`` has a row for every conv_id of the table: gaps, blank,
    duplicate, truncated, illegal, cost and audit; ``turns`` are the repaired turns (see
    ``repaired``). ``copies`` says how often a row stands (0: not at all, once by default)."""
    rows = _rows(conversations, F.lit(1) if copies is None else copies)
    blocks = _reduced(_blocks(_placed(rows)))
    path = scratch_path(conversations.sparkSession, "conversation-audits")
    _audits(blocks, _met(blocks)).write.parquet(path)
    audits = conversations.sparkSession.read.parquet(path)
    ids = conversations.select("conv_id").distinct()
    a = audits.withColumnRenamed("conv_id", "_conv")
    counts = [F.coalesce(F.get("counts", F.lit(i)), F.lit(0)).cast("long").alias(c) for i, c in enumerate(COUNTS)]
    reports = ids.join(a, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"))
    return reports, repaired(rows, audits)


EMPTY_HASH = hashlib.sha256().hexdigest()


def with_digests(reports: DataFrame, turns: DataFrame) -> DataFrame:
    """Adds ``repaired_sha256`` of the repaired ``role:text`` lines. The turns must stand in
    order within their partition, as ``repaired`` gives them."""
    schema = T.StructType([T.StructField("_conv", turns.schema["conv_id"].dataType),
                           T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, kind = None, None, None
        for b in batches:
            kind = b.column(0).type
            convs, digests = [], []
            for key, place, role, text in zip(*(c.to_pylist() for c in b.columns)):
                if place == 1:
                    if digest:
                        convs.append(conv)
                        digests.append(digest.hexdigest())
                    conv, digest = key, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([pa.array(convs, kind), pa.array(digests, pa.string())], names=schema.names)
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([digest.hexdigest()])], names=schema.names)

    d = turns.select("conv_id", "place", "role", "text").mapInArrow(run, schema)
    return reports.join(d, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv").withColumn(
        "repaired_sha256", F.coalesce("repaired_sha256", F.lit(EMPTY_HASH)))
