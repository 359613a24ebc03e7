"""Exact top-k inner products over a pivot-distance index.

Vectors become integers, floor(1024 * x). An extra component sqrt(M - |x|^2), M the largest squared norm,
puts all of them on one sphere, where the largest inner product with a query is the smallest distance
from it. Each vector is keyed by its nearest pivot and its distance to it; the index is range-split and
sorted by that key, so a run of rows is an annulus around its pivot. A query can have an annulus
[low, high] around pivot p no nearer than ``max(d(q, p) - high, low - d(q, p), 0)``: an annulus whose bound
cannot reach the query's k-th best score is skipped, and so are all beyond it in bound order.

Queries are a stated set. They go to the tasks in blocks of ``QUERY_BLOCK``; each block reads the index
twice, first the annuli nearest to each query for a k-th best score to start with, then the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import stored

SCALE, TOP = 1024, 10
#: Pivots, and the bound of the sample that they are fitted on (the index holds every vector).
PIVOTS, SAMPLE = 64, 4096
ANNULUS, QUERY_BLOCK = 256, 4096
#: Annuli of its nearest pivots that a query is tried on first.
FIRST = 2


def as_integers(vectors: DataFrame) -> DataFrame:
    """``(vec_id, v)`` of the rows that take part: an id, and no null or non-finite component."""
    good = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & good).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    out = np.zeros((len(column), dim), np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    size = np.diff(column.offsets.to_numpy())
    if len(size) and (size == dim).all():
        return flat.astype(np.int64).reshape(-1, dim)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(np.arange(len(size)), size), at] = flat
    return out


class Space:
    """The lifted space and its pivots."""

    def __init__(self, dim: int, norm: float, pivots: np.ndarray) -> None:
        self.dim, self.norm, self.pivots = dim, norm, pivots
        self.exact = norm < 2.0**52  # every inner product is then an exact double

    def lift(self, v: np.ndarray) -> np.ndarray:
        f = v.astype(float)
        rest = np.maximum(self.norm - np.einsum("ij,ij->i", f, f), 0)
        return np.concatenate((f, np.sqrt(rest)[:, None]), axis=1)

    def to_pivots(self, lifted: np.ndarray) -> np.ndarray:
        square = ((lifted**2).sum(axis=1)[:, None] - 2 * lifted @ self.pivots.T + (self.pivots**2).sum(axis=1))
        return np.sqrt(np.maximum(square, 0))

    def products(self, q: np.ndarray, v: np.ndarray) -> np.ndarray:
        return np.rint(q.astype(float) @ v.T.astype(float)).astype(np.int64) if self.exact else q @ v.T


def _fit(base: DataFrame) -> Space:
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, dim, norm = base.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(square)).first()
    dim, norm = dim or 0, norm or 0.0
    share = F.xxhash64("vec_id", F.lit("pivots")) / F.lit(2.0**64) + 0.5
    rows = (base.filter(share * n < SAMPLE).select("v").orderBy(F.xxhash64("v"), "v").limit(2 * SAMPLE).collect())
    sample = np.zeros((len(rows), dim), np.int64)
    for i, r in enumerate(rows):
        sample[i, : len(r["v"])] = r["v"]
    space = Space(dim, norm, np.zeros((1, dim + 1)))
    if len(rows):
        x = np.unique(space.lift(sample), axis=0)
        rng = np.random.default_rng(11)
        centres = x[rng.choice(len(x), min(PIVOTS, len(x)), replace=False)]
        for _ in range(6):
            space.pivots = centres
            near = space.to_pivots(x).argmin(axis=1)
            centres = np.array([x[near == k].mean(axis=0) if (near == k).any() else c for k, c in enumerate(centres)])
        space.pivots = centres
    return space


def build_index(vectors: DataFrame, name: str = "pivot-index") -> tuple[DataFrame, DataFrame, Space]:
    """Integer vectors (stored), the index (stored, split and sorted by pivot, distance, id), the space."""
    base = stored(as_integers(vectors), "vectors")
    space = _fit(base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = space.to_pivots(space.lift(_matrix(b.column(1), space.dim)))
            near = d.argmin(axis=1) if len(d) else np.zeros(0, np.int64)
            yield pa.record_batch([pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near]), b.column(0), b.column(1)],
                                  names=["pivot", "dist", "vec_id", "v"])

    keyed = base.mapInArrow(run, "pivot int, dist double, vec_id long, v array<long>")
    parts = max(1, base.rdd.getNumPartitions())
    index = keyed.repartitionByRange(parts, "pivot", "dist", "vec_id").sortWithinPartitions("pivot", "dist", "vec_id")
    return base, stored(index, name), space


class Search:
    """Best rows so far of a block of queries."""

    def __init__(self, space: Space, ids: np.ndarray, q: np.ndarray, floor: np.ndarray, top: int) -> None:
        self.space, self.ids, self.q, self.top = space, ids, q, top
        f = q.astype(float)
        self.square = np.einsum("ij,ij->i", f, f)
        lifted = np.concatenate((f, np.zeros((len(f), 1))), axis=1)
        self.dist = space.to_pivots(lifted)
        self.floor = floor.copy()
        self.who, self.score, self.vec = (np.zeros(0, np.int64) for _ in range(3))

    def reach(self, pivot: int, low: float, high: float) -> np.ndarray:
        """Largest score that a row of the annulus could have, for each query (never too small)."""
        d = self.dist[:, pivot]
        gap = np.maximum(np.maximum(d - high, low - d), 0)
        gap = np.maximum(gap * (1 - 1e-9) - 1e-6 * (1 + np.sqrt(self.space.norm)), 0)
        return (self.space.norm + self.square - gap * gap) / 2 * (1 + 1e-9) + 1

    def annulus(self, which: np.ndarray, ids: np.ndarray, v: np.ndarray) -> None:
        s = self.space.products(self.q[which], v)
        fit = (s >= self.floor[which][:, None]) & (ids[None, :] != self.ids[which][:, None])
        a, b = np.nonzero(fit)
        if not len(a):
            return
        who = np.concatenate((self.who, which[a]))
        score, vec = np.concatenate((self.score, s[a, b])), np.concatenate((self.vec, ids[b]))
        order = np.lexsort((vec, -score, who))
        who, score, vec = who[order], score[order], vec[order]
        first = np.searchsorted(who, who, side="left")
        place = np.arange(len(who)) - first
        keep = place < self.top
        self.who, self.score, self.vec = who[keep], score[keep], vec[keep]
        full = place == self.top - 1
        self.floor[who[full]] = np.maximum(self.floor[who[full]], score[full])

    def batch(self, pivots: np.ndarray, dist: np.ndarray, ids: np.ndarray, v: np.ndarray, first: bool) -> None:
        """All annuli of some sorted rows, those with the farthest reach first."""
        cuts = np.flatnonzero(np.diff(pivots)) + 1
        runs = [(s, e) for s0, e0 in zip([0, *cuts], [*cuts, len(pivots)]) for s in range(s0, e0, ANNULUS)
                for e in [min(s + ANNULUS, e0)] if e > s]
        reach = [self.reach(int(pivots[s]), dist[s], dist[e - 1]) for s, e in runs]
        near = np.argsort(-np.array(reach), axis=0)[:FIRST] if first and runs else None
        for k in sorted(range(len(runs)), key=lambda k: -reach[k].max()):
            s, e = runs[k]
            which = np.flatnonzero((near == k).any(axis=0)) if first else np.flatnonzero(reach[k] >= self.floor)
            if len(which):
                self.annulus(which, ids[s:e], v[s:e])


FOUND = "q long, score long, vec_id long"


def _scan(index: DataFrame, space: Space, ids: np.ndarray, q: np.ndarray, floor: np.ndarray, top: int, first: bool) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast((space, ids, q, floor))  # at most QUERY_BLOCK queries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(*shared.value, top)
        for b in batches:
            if b.num_rows:
                pivots, dist, vec = (b.column(k).to_numpy(zero_copy_only=False) for k in range(3))
                search.batch(pivots, dist, vec, _matrix(b.column(3), search.space.dim), first)
        yield pa.record_batch([pa.array(search.who), pa.array(search.score), pa.array(search.vec)], names=["q", "score", "vec_id"])

    return index.mapInArrow(run, FOUND)


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def search(vectors: DataFrame, is_query, top: int = TOP) -> DataFrame:
    """Each query's ``top`` rows by integer inner product: query_id, rank (from 1), vec_id, score.

    Queries are the rows for which the column ``is_query`` (over vec_id) holds; candidates all rows with
    another vec_id; ties go to the smaller vec_id; fewer candidates give fewer rows. Rows with a null
    id, vector or component or a non-finite component take no part; shorter vectors count as filled up
    with zeros; a repeated query row is one query; repeated candidates each count; an empty table gives
    an empty result; other columns are ignored. Products of 64-bit size are meant: larger ones wrap.
    """
    base, index, space = build_index(vectors)
    queries = base.filter(is_query).distinct()
    n_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    found = []
    for k in range(n_blocks):
        rows = queries.filter(F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_blocks)) == k).orderBy("vec_id", "v").collect()
        if not rows:
            continue
        ids = np.array([r["vec_id"] for r in rows], np.int64)
        q = np.zeros((len(rows), space.dim), np.int64)
        for i, r in enumerate(rows):
            q[i, : len(r["v"])] = r["v"]
        none = np.full(len(rows), np.iinfo(np.int64).min)
        floor = none.copy()
        for r in _best(_scan(index, space, ids, q, none, top, True), top).filter(F.col("rank") == top).collect():
            floor[r["q"]] = r["score"]
        best = _best(_scan(index, space, ids, q, floor, top, False), top)
        names = index.sparkSession.createDataFrame(list(enumerate(ids.tolist())), "q long, query_id long")
        found.append(best.join(names, "q").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
    if not found:
        return index.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return reduce(DataFrame.unionByName, found)
