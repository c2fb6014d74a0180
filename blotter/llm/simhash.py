"""SimHash near-duplicate groups by bit-sliced comparison.

1. Fingerprints: one 64-bit SimHash of the word shingles of every whole text.
2. Classes: equal fingerprints are one class, represented once.
3. Candidates: the 64 bits are cut into ``BLOCKS`` parts. Two fingerprints within
   ``radius`` bits agree on at least ``BLOCKS - radius`` whole parts, so every choice of
   that many parts is a key under which they meet: no link is lost. Keys held by a single
   class are dropped before any comparison.
4. Bit-sliced comparison: the fingerprints of one key stand next to each other. Bit planes
   are stored vertically (bit b of eight neighbours in one byte), the planes of the rows and
   of the rows ``s`` places further are xor-ed, and carry-save counters add up eight
   distances per byte. A block of lanes is abandoned as soon as all its pairs have passed
   the radius.
5. Groups: the links of one task are merged there to stars, the stars of all tasks to
   connected components.

A key with more than ``CELL`` classes is cut into sub-blocks whose pairs are compared in
separate tasks, so a task's memory does not grow with the largest group. Links are never
expanded to all pairs of a group.

Defined cases: null, empty and blank texts have fingerprint 0 and are one group; texts with
fewer words than a shingle hash their whole word sequence; repeated rows share a class;
a null doc_id never represents a group that has another id; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from .common import saved
from .components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
BLOCKS = 5
CELL = 4096
#: shingle hashes whose bits are unpacked at once, rows compared at once, pairs merged at once
HASH_CHUNK, LANES, MERGE = 65_536, 16_384, 1_000_000


# --- fingerprints -------------------------------------------------------------------
def shingle_hashes(text: bytes | None, words: int = SHINGLE_WORDS) -> Iterator[int]:
    w = (text or b"").lower().split()  # ASCII letters and ASCII white space only
    if not w:
        return iter(())
    grams = zip(*(w[i:] for i in range(words))) if len(w) >= words else [w]
    return (xxhash.xxh64_intdigest(b" ".join(g), SEED) for g in grams)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit b is set if it is set in more than half of the hashes; no hashes give 0."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), HASH_CHUNK):
        bits = np.unpackbits(hashes[i:i + HASH_CHUNK].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints_of(texts: list[bytes | None], words: int) -> np.ndarray:
    out = np.zeros(len(texts), np.uint64)
    waiting: list[tuple[int, np.ndarray]] = []
    held = 0

    def flush():
        rows, parts = zip(*waiting)
        sizes = np.array([len(p) for p in parts])
        bits = np.unpackbits(np.concatenate(parts).view(np.uint8), bitorder="little")
        ones = np.add.reduceat(bits.reshape(-1, 64), np.cumsum(sizes) - sizes, axis=0,
                               dtype=np.int32)
        packed = np.packbits(2 * ones > sizes[:, None], axis=1, bitorder="little")
        out[list(rows)] = np.ascontiguousarray(packed).view(np.uint64)[:, 0]
        waiting.clear()

    for i, t in enumerate(texts):
        h = np.fromiter(shingle_hashes(t, words), np.uint64)
        if len(h) > HASH_CHUNK:
            out[i] = fingerprint(h)
        elif len(h):
            waiting.append((i, h))
            held += len(h)
            if held > HASH_CHUNK:
                flush()
                held = 0
    if waiting:
        flush()
    return out


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, fp): one row per document; ``fp`` holds the 64 bits as a long."""
    d = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    schema = T.StructType([d.schema["doc_id"], T.StructField("text_hash", T.LongType()),
                           T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).cast(pa.binary()).to_pylist()
            fp = _fingerprints_of(texts, words).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)],
                                             names=["doc_id", "text_hash", "fp"])

    return d.mapInArrow(run, schema)


# --- bit-sliced comparison ----------------------------------------------------------
class BitPlanes:
    """Bit planes of consecutive fingerprints, ready for comparison at any distance."""

    def __init__(self, fps: np.ndarray):
        n = len(fps)
        bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(n, 8), axis=1,
                             bitorder="little").T
        self.n = n
        # the planes moved by 0 .. 7 lanes, so that any distance is a whole number of bytes
        self.moved = [np.packbits(bits[:, k:], axis=1) for k in range(8)]

    def within(self, s: int, wanted: np.ndarray, radius: int) -> np.ndarray:
        """Lanes i with ``wanted[i]`` whose fingerprints i and i+s differ in at most
        ``radius`` bits."""
        lanes = self.n - s
        alive = np.packbits(wanted[:lanes])
        width = len(alive)
        near, far = self.moved[0][:, :width], self.moved[s % 8][:, s // 8:s // 8 + width]
        k = max(1, radius.bit_length())
        start = (1 << k) - (radius + 1)  # so high that the last counter overflows at radius + 1
        counters = [np.full(width, 255 if start >> j & 1 else 0, np.uint8) for j in range(k)]
        for plane in range(64):
            carry = near[plane] ^ far[plane]
            for c in counters:  # carry-save: every counter bit takes the carry of the one below
                up = c & carry
                c ^= carry
                carry = up
            alive &= ~carry
            if plane % 4 == 3 and not alive.any():
                return np.empty(0, np.int64)
        return np.flatnonzero(np.unpackbits(alive, count=lanes))


def merge_links(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest linked position of each of n positions."""
    root = np.arange(n)
    while True:
        lo, hi = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        open_ = lo != hi
        if not open_.any():
            return root
        np.minimum.at(root, hi[open_], lo[open_])
        while not np.array_equal(up := root[root], root):
            root = up


def stars(keys: np.ndarray, fps: np.ndarray, radius: int) -> np.ndarray:
    """For rows sorted by ``keys``: position of the first row that each is linked to,
    over links of equal keys within ``radius`` bits."""
    n = len(fps)
    planes, a, b = BitPlanes(fps), [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for s in range(1, n):
        wanted = keys[:-s] == keys[s:]
        if not wanted.any():
            break
        i = planes.within(s, wanted, radius)
        a.append(i)
        b.append(i + s)
        if sum(map(len, a)) > MERGE:
            root = merge_links(n, np.concatenate(a), np.concatenate(b))
            a, b = [np.arange(n)], [root]
    return merge_links(n, np.concatenate(a), np.concatenate(b))


def _links_of_sorted(radius: int):
    """Rows (cell, fp) sorted by cell -> star links (a, b). Cells are bounded, so cutting
    between cells keeps a chunk near ``LANES`` rows."""
    def emit(cell, fp):
        root = stars(cell, fp.view(np.uint64), radius)
        linked = np.flatnonzero(root != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[root[linked]])],
                                          names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, fp = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            cell = np.concatenate([cell, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy()])
            if len(fp) >= LANES:
                cut = int(np.searchsorted(cell, cell[-1]))
                if cut:
                    yield emit(cell[:cut], fp[:cut])
                    cell, fp = cell[cut:], fp[cut:]
        if len(fp):
            yield emit(cell, fp)

    return run


def key_masks(radius: int, blocks: int = BLOCKS) -> list[int]:
    """64-bit masks (as signed longs), one for every choice of blocks - radius parts."""
    if blocks <= radius:
        raise ValueError("blocks must exceed the radius")
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    part = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    masks = (sum(part[i] for i in c) for c in combinations(range(blocks), blocks - radius))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(classes: DataFrame, radius: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """Star links (a, b) between the distinct fingerprints ``fp``: their connected
    components are those of all pairs within ``radius`` bits."""
    keyed = classes.select("fp", F.posexplode(F.array(
        *[F.col("fp").bitwiseAND(F.lit(m)) for m in key_masks(radius, blocks)])).alias("t", "key"))
    met = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    sub = F.ceil(F.col("n") / CELL).cast("int")
    mine = F.pmod(F.xxhash64(F.col("fp")), F.col("subs")).cast("int")
    cells = (keyed.join(met, ["t", "key"]).withColumn("subs", sub).withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)))
             .select(F.xxhash64("t", "key", F.least("mine", "other"), F.greatest("mine", "other"))
                     .alias("cell"), "fp"))
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (cells.repartition(parts, "cell").sortWithinPartitions("cell", "fp")
            .mapInArrow(_links_of_sorted(radius), "a long, b long"))


# --- groups ---------------------------------------------------------------------------
def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """(doc_id, text_hash, fp, component_id, component): one row per document. ``component``
    names the group (its smallest linked fingerprint), ``component_id`` is its smallest
    doc_id."""
    marked = saved(fingerprints(docs, words))
    classes = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = connected_components(links(classes, radius))
    linked = roots.join(classes, roots.node == classes.fp).select("fp", "root", "first_id")
    groups = linked.groupBy("root").agg(F.min("first_id").alias("group_id"))
    named = classes.join(linked.join(groups, "root").select("fp", "root", "group_id"), "fp", "left")
    named = named.select("fp", F.coalesce("root", "fp").alias("component"),
                         F.coalesce("group_id", "first_id").alias("component_id"))
    return marked.join(named, "fp").select("doc_id", "text_hash", "fp", "component_id", "component")


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """The documents with one row of each group (its smallest doc_id), all columns kept."""
    groups = near_duplicates(docs, words, radius)
    first = groups.groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("k"))
    id_key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    kept = first.select(id_key("k.doc_id").alias("id"), F.col("k.text_hash").alias("hash"))
    rows = docs.select(F.struct("*").alias("doc")).select(
        "doc", id_key("doc.doc_id").alias("id"), F.xxhash64("doc.text").alias("hash"))
    # repeated rows (same id, same text) are cut to one before and after the shuffle that
    # the join uses as well
    one = Window.partitionBy("id", "hash").orderBy(F.xxhash64("doc"))
    single = rows.withColumn("copy", F.row_number().over(one)).where("copy = 1")
    return single.join(kept, ["id", "hash"], "left_semi").select("doc.*")


def hex_fingerprint(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
