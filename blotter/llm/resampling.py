"""Importance resampling of documents towards a target distribution.

Features are runs of consecutive words, hashed into ``buckets``. The feature counts of the
corpus and of the target texts give every bucket a gain, the log ratio of its smoothed
probabilities in thousandths. A document's weight is the floored mean of the gains of its
features, read from the array of all gains; its score adds Gumbel noise from a hash of its id,
so that drawing the highest scores is drawing by weight without replacement.

The cutoff of the draw is bracketed: a mergeable quantile sketch of the scores names a lower
and an upper bound for the k-th highest score, and exact counts of the rows above and within
tell whether it lies between them; if not, the bracket is widened and counted again. Only the
rows of the bracket are sorted to find the cutoff row. The rows drawn are then range-sorted
for their ranks; the others are never sorted.

Texts are read twice (bucket counts, scores) and never shuffled: a task adds up its counts in an
array and sends one row per bucket. The driver sees the ``buckets`` gains and a few counts. The
scored rows (ids and numbers) and sorted rows are written to the shared folder, so that a
row's place does not depend on a repeated computation.

Defined cases: a null text has no words; a document without features has weight 0; floors go
down; only documents of at least ``min_words`` words are drawn; a null doc_id hashes as the
empty text and sorts after all others; rows of equal score and doc_id are ordered by weight
and number of features, rows that repeat exactly are interchangeable but each has a rank of
its own; an empty corpus gives an empty result, an empty target even gains; other columns
are ignored, whatever their names. Very long texts are cut between words and processed whole.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import scratch_path

BUCKETS, SEED, PERCENT, MIN_WORDS = 10_000, 2024, 10, 20
#: lengths of the word runs that are features: shortest, longest
RUNS = (1, 1)
#: rank error of the quantile sketch is 1 / ACCURACY of the rows
ACCURACY = 10_000
#: bytes of a text that are cut into words at once; features whose bucket a task remembers
PIECE, MEMORY = 4 << 20, 500_000

#: ASCII letters are lower-cased; bytes that are neither ASCII letters, ASCII digits nor part of
#: other characters stand between words
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))
_SPACE = re.compile(b" ")


def words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in pieces that end between words."""
    if len(text) <= PIECE:
        yield text.translate(_TABLE).split()
        return
    text, at = text.translate(_TABLE), 0
    while at < len(text):
        cut = _SPACE.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        yield text[at:end].split()
        at = end


class BucketOf(dict):
    """Bucket of a feature; remembers features within a bound."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        bucket = self[feature] = zlib.crc32(feature) % self.buckets
        return bucket


def features(text: bytes, runs: tuple[int, int], bucket_of: BucketOf) -> tuple[int, Iterator[np.ndarray]]:
    """Number of words, and the buckets of all features (repeats included) in pieces."""
    n, found, tail = 0, [], []
    for piece in words(text):
        n += len(piece)
        for length in range(runs[0], runs[1] + 1):
            # runs that begin in an earlier piece and end in this one
            row = tail[len(tail) - (length - 1):] + piece if length > 1 else piece
            grams = row if length == 1 else [b" ".join(row[i:i + length]) for i in range(len(row) - length + 1)]
            if grams:
                found.append(np.fromiter(map(bucket_of.__getitem__, grams), np.int32, len(grams)))
        if runs[1] > 1:
            tail = (tail + piece)[-(runs[1] - 1):]
    return n, found


def _binary(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def bucket_counts(texts: DataFrame, runs=RUNS, buckets: int = BUCKETS) -> np.ndarray:
    """Occurrences of each bucket over all texts (column ``text``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, bucket_of = np.zeros(buckets, np.int64), BucketOf(buckets)
        for b in batches:
            for text in b.column(0):
                for found in features(text.as_py(), runs, bucket_of)[1]:
                    total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])],
                                         names=["bucket", "n"])

    rows = (texts.select(_binary(F.col("text")).alias("text")).mapInArrow(run, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())  # at most one row per bucket
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of the smoothed probabilities of each bucket, in floored thousandths."""
    k = len(corpus)
    s_all, t_all = float(corpus.sum() + k), float(target.sum() + k)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all)))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, runs=RUNS) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every document."""
    d = docs.select("doc_id", _binary(F.col("text")).alias("text"))
    schema = T.StructType([d.schema["doc_id"], T.StructField("n_words", T.LongType()),
                           T.StructField("n_features", T.LongType()), T.StructField("weight", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket_of = BucketOf(len(gain))
        for b in batches:
            out = []
            for text in b.column(1):
                n, found = features(text.as_py(), runs, bucket_of)
                count = sum(map(len, found))
                out.append((n, count, sum(int(gain[f].sum()) for f in found) // count if count else 0))
            columns = np.array(out, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, columns)], names=schema.names)

    return d.mapInArrow(run, schema)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Noise of a document in floored thousandths, from the first 32 bits of a SHA-256."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def _order() -> list[Column]:
    """Highest score first. Rows that repeat exactly stand in the order of their input, so a
    range border can run between them."""
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight").desc(),
            F.col("n_features").desc(), F.col("_row")]


def ranked(rows: DataFrame) -> DataFrame:
    """Adds ``rank`` (1, 2, 3 ...) in score order: a range sort, then the rows of all ranges
    before are added. The sorted rows are written first, so ranges and places agree."""
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "ranked")
    place = F.monotonically_increasing_id()  # range number and place within the range
    (rows.withColumn("_row", F.monotonically_increasing_id())
     .repartitionByRange(*_order()).sortWithinPartitions(*_order()).drop("_row")
     .withColumns({"_range": F.shiftright(place, 33), "_place": place.bitwiseAND(F.lit((1 << 33) - 1))})
     .write.parquet(path))
    placed = spark.read.parquet(path)
    # one row per range: the sum over all ranges before runs in one task
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = (placed.groupBy("_range").agg(F.count("*").alias("_n"))
             .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))
    return (placed.join(bases, "_range").withColumn("rank", F.col("_base") + F.col("_place") + 1)
            .drop("_range", "_place", "_base"))


def bracket(scored: DataFrame, n: int, k: int, accuracy: int = ACCURACY) -> tuple[int | None, int | None, int]:
    """(lower, upper, above): the k-th highest of the n scores lies in lower..upper (None: no
    bound), and exactly ``above`` < k rows score higher than upper."""
    width = 2.0 / accuracy
    while True:
        at = 1 - k / n
        ends = [max(0.0, at - width), min(1.0, at + width)]
        low, high = scored.agg(F.percentile_approx("score", ends, accuracy)).first()[0]
        low, high = (low if ends[0] > 0 else None), (high if ends[1] < 1 else None)
        over = F.lit(False) if high is None else F.col("score") > high
        under = F.lit(False) if low is None else F.col("score") < low
        counts = scored.agg(F.count_if(over).alias("above"), F.count_if(under).alias("below")).first()
        if counts["above"] < k <= n - counts["below"]:
            return low, high, counts["above"]
        width *= 4


def draw(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Adds ``rank`` to scored rows: 1 .. k for the k = percent / 100 of the eligible rows
    with the highest scores, null for the others."""
    eligible = scored.where(F.col("n_words") >= min_words)
    n = eligible.count()
    k = percent * n // 100
    none = F.lit(None).cast("long")
    if not k:
        return scored.withColumn("rank", none)
    low, high, above = bracket(eligible, n, k)
    within = eligible
    if low is not None:
        within = within.where(F.col("score") >= low)
    if high is not None:
        within = within.where(F.col("score") <= high)
    cut = ranked(within).where(F.col("rank") == k - above).first()
    # the rows from the top down to the cutoff row and any of its id that tie with it
    before_id = (F.lit(True) if cut["doc_id"] is None
                 else F.coalesce(F.col("doc_id") <= F.lit(cut["doc_id"]), F.lit(False)))
    tied = (F.col("score") == cut["score"]) & before_id
    chosen = (F.col("n_words") >= min_words) & ((F.col("score") > cut["score"]) | tied)
    top = ranked(scored.where(chosen)).withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))
    return top.unionByName(scored.where(~chosen).withColumn("rank", none))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
             runs: tuple[int, int] = RUNS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document; ``target`` holds
    texts of the wanted distribution."""
    gain = gains(bucket_counts(docs, runs, buckets), bucket_counts(target, runs, buckets))
    scored = weights(docs, gain, runs).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    path = scratch_path(docs.sparkSession, "scored")
    scored.write.parquet(path)
    return draw(docs.sparkSession.read.parquet(path), percent, min_words)
