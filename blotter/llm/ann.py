"""Approximate nearest neighbours by learned partitions.

Fitting, on a bounded sample (``SAMPLE`` vectors, those of smallest id hash):

1. the exact neighbour graph of the sample;
2. a balanced partitioning of that graph: parts are halved again and again; each half
   follows the second eigenvector of the part's graph and is then refined by swaps that
   cut fewer edges, so all parts have the same size;
3. a small classifier (one hidden layer, softmax) that learns the part of each vector;
4. the number of parts to search: the smallest that finds ``TARGET`` of the true
   neighbours of held-out sample vectors.

Indexing: every row of the table goes to its most probable part. Searching: a query goes
to its most probable parts, where exact inner products rank the candidates; the best of
all parts are merged.

Parts are cut into chunks of about ``CHUNK_ROWS`` rows by a hash of the id, so a part that
takes many rows (a third of them may be copies of one vector) is no single task. A task
holds one chunk and about ``QUERY_ROWS`` of the queries sent to its part. Copies of a
vector are scored once. Scores are summed in component order in double precision, so equal
vectors score equally wherever they stand.

Vectors of different lengths have no inner product, so each length is searched apart: the
most frequent one and every other of more than ``chunk_rows`` rows with an index of its own,
fitted one after another, the rest as one part each, in which every row is ranked.

Defined cases: vectors that are null, empty, zero, or that hold null or non-finite
components take no part, neither as queries nor as candidates; a vector finds only vectors
of its own length; equal scores are ordered by id; a repeated id is one candidate per row, and
no query finds a row of its own id; fewer candidates than asked for are all returned as
found; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, unit_hash

NEIGHBOURS = 20
QUERY_EVERY = 20
SAMPLE = 8_192
PARTS = 32
GRAPH_DEGREE = 10
HIDDEN = 128
TARGET = 0.96
CHUNK_ROWS = 8_192
QUERY_ROWS = 2_048
SEED = 3


# --- fitting on the sample ------------------------------------------------------------
def neighbour_graph(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (i, j) from each vector to its k largest inner products of direction."""
    n = len(x)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    k = min(k, n - 1)
    i, j = [], []
    for a in range(0, n, 1024):
        s = unit[a:a + 1024] @ unit.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        j.append(np.argpartition(-s, k - 1, axis=1)[:, :k].ravel() if k else np.empty(0, int))
        i.append(np.repeat(np.arange(a, a + len(s)), k))
    i, j = np.concatenate(i), np.concatenate(j)
    return np.concatenate([i, j]), np.concatenate([j, i])


def _halves(n: int, i: np.ndarray, j: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Balanced bisection of a graph: the second eigenvector, then swaps that cut less."""
    degree = np.bincount(i, minlength=n) + 1e-9
    v = rng.standard_normal(n)
    for _ in range(60):
        v = v - (v * degree).sum() / degree.sum()  # without the constant vector
        v = 0.5 * v + 0.5 * np.bincount(i, v[j], minlength=n) / degree
        v /= np.linalg.norm(v) + 1e-300
    side = np.zeros(n, bool)
    side[np.argsort(v, kind="stable")[n // 2:]] = True
    for _ in range(20):
        cross = np.where(side[i] != side[j], 1.0, -1.0)
        gain = np.bincount(i, cross, minlength=n)
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left = left[np.argsort(-gain[left], kind="stable")]
        right = right[np.argsort(-gain[right], kind="stable")]
        m = min(len(left), len(right))
        pairs = int((gain[left[:m]] + gain[right[:m]] > 0).sum()) // 2
        if not pairs:
            break
        before = (cross > 0).sum()
        new = side.copy()
        new[left[:pairs]], new[right[:pairs]] = True, False
        if (new[i] != new[j]).sum() >= before:
            break
        side = new
    return side


def balanced_parts(x: np.ndarray, parts: int, degree: int = GRAPH_DEGREE, seed: int = SEED) -> np.ndarray:
    """Part of each vector; ``parts`` is a power of two. Sizes differ by one per halving at most."""
    rng = np.random.default_rng(seed)
    i, j = neighbour_graph(x, degree)
    label = np.zeros(len(x), np.int64)
    for _ in range(parts.bit_length() - 1):
        new = np.zeros(len(x), np.int64)
        for p in np.unique(label):
            here = np.flatnonzero(label == p)
            place = np.full(len(x), -1)
            place[here] = np.arange(len(here))
            inside = (label[i] == p) & (label[j] == p)
            side = _halves(len(here), place[i[inside]], place[j[inside]], rng)
            new[here] = 2 * p + side
        label = new
    return label


class Classifier:
    """One hidden layer and a softmax over the parts, trained with Adam."""

    def __init__(self, dim: int, parts: int, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.w = [rng.standard_normal((dim, HIDDEN)) * np.sqrt(2 / dim), np.zeros(HIDDEN),
                  rng.standard_normal((HIDDEN, parts)) * np.sqrt(1 / HIDDEN), np.zeros(parts)]

    def scores(self, x: np.ndarray) -> np.ndarray:
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        return np.maximum(unit @ self.w[0] * 4 + self.w[1], 0) @ self.w[2] + self.w[3]

    def fit(self, x: np.ndarray, label: np.ndarray, epochs: int = 20, rate: float = 3e-3, seed: int = SEED):
        rng = np.random.default_rng(seed)
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        m, s, step = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for a in range(0, len(x), 256):
                b = order[a:a + 256]
                pre = x[b] @ self.w[0] * 4 + self.w[1]
                hid = np.maximum(pre, 0)
                out = hid @ self.w[2] + self.w[3]
                p = np.exp(out - out.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(len(b)), label[b]] -= 1
                p /= len(b)
                back = (p @ self.w[2].T) * (pre > 0)
                grads = [x[b].T @ back * 4, back.sum(0), hid.T @ p, p.sum(0)]
                step += 1
                for w, g, mi, si in zip(self.w, grads, m, s):
                    mi *= 0.9
                    mi += 0.1 * g
                    si *= 0.999
                    si += 0.001 * g * g
                    w -= rate * (mi / (1 - 0.9 ** step)) / (np.sqrt(si / (1 - 0.999 ** step)) + 1e-8)
        return self

    def ranked(self, x: np.ndarray, count: int) -> np.ndarray:
        """The ``count`` most probable parts of each vector, best first."""
        return np.argsort(-self.scores(x), axis=1, kind="stable")[:, :count]


def parts_to_search(x: np.ndarray, model: Classifier, parts: int, k: int, target: float) -> int:
    """Smallest number of parts that finds ``target`` of the true neighbours of a tenth of
    the sample in the rest of it."""
    held = np.arange(len(x)) % 10 == 0
    queries, base = x[held], x[~held]
    if not len(base):
        return parts
    k = min(k, len(base))
    true = np.argpartition(-(queries @ base.T), k - 1, axis=1)[:, :k]
    home = model.ranked(base, 1)[:, 0]
    rank = np.argsort(model.ranked(queries, parts), axis=1)  # rank of each part for each query
    needed = np.take_along_axis(rank, home[true], axis=1)
    found = np.array([(needed < p).mean() for p in range(1, parts + 1)])
    enough = np.flatnonzero(found >= target)
    return int(enough[0]) + 1 if len(enough) else parts


class Index:
    """What fitting leaves: the classifier and the number of parts to search."""

    def __init__(self, sample: np.ndarray, parts: int = PARTS, k: int = NEIGHBOURS, target: float = TARGET):
        while parts > 1 and len(sample) < 4 * parts:  # a part needs a few sample vectors
            parts //= 2
        self.parts = parts
        self.model = Classifier(sample.shape[1], parts)
        if parts > 1:
            self.model.fit(sample, balanced_parts(sample, parts))
        self.search = parts_to_search(sample, self.model, parts, k, target) if parts > 1 else 1


# --- exact ranking inside a chunk -------------------------------------------------------
def in_order_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed component by component."""
    s = np.zeros(len(a))
    for d in range(a.shape[1]):
        s += a[:, d] * b[:, d]
    return s


def best_in_chunk(qid: np.ndarray, qh: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int) -> pd.DataFrame:
    """The k best candidates of each query, by (score descending, id)."""
    order = np.argsort(cid, kind="stable")
    cid, c = cid[order], np.ascontiguousarray(c[order])
    distinct, at = np.unique(c.view(np.dtype((np.void, c.dtype.itemsize * c.shape[1]))).ravel(), return_inverse=True)
    members = np.argsort(at, kind="stable")
    vectors = c[members[np.searchsorted(at[members], np.arange(len(distinct)))]]
    # repeated rows of one (id, vector) are one member that counts ``times``
    at, ids_at = at[members], cid[members]
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (ids_at[1:] != ids_at[:-1])]))
    times = np.diff(new, append=len(at))
    at, ids_at = at[new], ids_at[new]
    # of the copies of one vector, the k + 1 smallest ids can matter (one may be the query's own)
    starts = np.searchsorted(at, np.arange(len(distinct) + 1))
    single, only = np.diff(starts) == 1, ids_at[starts[:-1]]
    rows, cols = [], []
    for a in range(0, len(q), 256):
        s = q[a:a + 256] @ vectors.T
        m = min(k, s.shape[1])
        slack = 1e-9 * (1 + np.abs(s).max(axis=1))
        s[single & (only == qid[a:a + 256, None])] = -np.inf  # vectors of the query's own id alone
        edge = np.partition(s, s.shape[1] - m, axis=1)[:, s.shape[1] - m]
        r, col = np.nonzero((s >= (edge - slack)[:, None]) & (s > -np.inf))
        rows.append(r + a)
        cols.append(col)
    rows, cols = np.concatenate(rows), np.concatenate(cols)
    score = in_order_products(q[rows], vectors[cols])
    sizes = np.minimum(np.diff(starts), k + 1)[cols]
    pick = np.repeat(starts[:-1][cols], sizes) + (np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes))
    rows, score = np.repeat(rows, sizes), np.repeat(score, sizes)
    keep = ids_at[pick] != qid[rows]
    rows, score, pick = rows[keep], score[keep], pick[keep]
    order = np.lexsort((ids_at[pick], -score, rows))
    rows, score, pick = rows[order], score[order], pick[order]
    # at most k rows of a query, repeated ones each on its own
    count = times[pick]
    before = np.cumsum(count) - count
    first = np.searchsorted(rows, np.arange(len(q)))
    before = before - np.concatenate([before, [0]])[first[rows]]
    best = np.repeat(np.arange(len(rows)), np.clip(k - before, 0, count))
    ids = ids_at[pick]
    return pd.DataFrame({"query_id": qid[rows[best]], "qh": qh[rows[best]], "vec_id": ids[best], "score": score[best]})


# --- the search ---------------------------------------------------------------------------
def valid(table: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    return (table.select("vec_id", v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
            .where(F.expr("forall(v, x -> x is not null and not isnan(x) and abs(x) < double('inf'))")
                   & F.expr("exists(v, x -> x <> 0)")))


def _matrix(column: pd.Series, dim: int) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.empty((0, dim))


def search(table: DataFrame, is_query: Column, k: int = NEIGHBOURS, parts: int = PARTS,
           target: float = TARGET, sample: int = SAMPLE, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best found of every row for which ``is_query``
    holds, against all rows but those of its own id."""
    spark = table.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    rows = valid(table).withColumn("h", unit_hash(F.col("vec_id")))
    counts = saved(rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")))
    most = counts.orderBy(F.desc("n"), F.desc("dim")).first()
    if most is None:
        return spark.createDataFrame([], result)
    large = {r["dim"] for r in counts.where(F.col("n") > chunk_rows).collect()}
    indexes = {}
    for dim in sorted(large | {most["dim"]}):
        fitted = rows.where(F.size("v") == dim).orderBy("h", "vec_id").limit(sample).select("v").toPandas()["v"]
        indexes[dim] = Index(_matrix(fitted, dim), parts, k, target)

    def route(home: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if len(b):
                    dims, ranked = b["v"].map(len).to_numpy(), np.empty(len(b), object)
                    for dim in np.unique(dims).tolist():
                        at, index = np.flatnonzero(dims == dim), indexes.get(dim)
                        found = (index.model.ranked(_matrix(b["v"].iloc[at], dim), 1 if home else index.search)
                                 if index else np.zeros((len(at), 1)))
                        for i, x in zip(at, found.astype(np.int32)):
                            ranked[i] = x
                    b["parts"] = list(ranked)
                    yield b
        return run

    schema = "vec_id long, v array<double>, h long, is_query boolean, parts array<int>"
    marked = rows.withColumn("is_query", F.coalesce(is_query, F.lit(False)))
    homes = saved(marked.mapInPandas(route(True), schema)
                  .select("vec_id", "v", "h", "is_query", F.size("v").alias("dim"), F.get("parts", F.lit(0)).alias("part")))
    # repeated rows are one query; ``qh`` tells different vectors of one id apart
    queries = saved(homes.where("is_query").select("vec_id", "v", "h", "is_query")
                    .mapInPandas(route(False), schema)
                    .select("vec_id", "v", F.size("v").alias("dim"), F.xxhash64("v").alias("qh"), F.explode("parts").alias("part"))
                    .dropDuplicates(["vec_id", "dim", "qh", "part"]))
    # at most ``parts`` rows a length: chunks of candidates and blocks of queries of a part
    grid = F.broadcast(
        homes.groupBy("dim", "part").agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias("chunks")).join(
            queries.groupBy("dim", "part").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("blocks")), ["dim", "part"]))
    dealt = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    c = (homes.join(grid, ["dim", "part"]).withColumn("chunk", dealt("chunks")).withColumn("block", every("blocks"))
         .select("dim", "part", "chunk", "block", "vec_id", "v"))
    q = (queries.join(grid, ["dim", "part"]).withColumn("block", dealt("blocks")).withColumn("chunk", every("chunks"))
         .select("dim", "part", "chunk", "block", "vec_id", "qh", "v"))

    def rank(cs: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        if not len(cs) or not len(qs):
            return pd.DataFrame({"query_id": [], "qh": [], "vec_id": [], "score": []})
        dim = len(qs["v"].iloc[0])
        return best_in_chunk(qs["vec_id"].to_numpy(), qs["qh"].to_numpy(), _matrix(qs["v"], dim),
                             cs["vec_id"].to_numpy(), _matrix(cs["v"], dim), k)

    keys = ["dim", "part", "chunk", "block"]
    near = (c.groupBy(*keys).cogroup(q.groupBy(*keys))
            .applyInPandas(rank, "query_id long, qh long, vec_id long, score double"))
    order = Window.partitionBy("query_id", "qh").orderBy(F.desc("score"), "vec_id")
    return (near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
