"""The k most similar titles of every title (R8), exactly and without the N x N matrix.

Vectors are unit length, so the cosine is the dot product. Terms go from rare to common, in bins: a common term is a bin
of its own, rare ones share one.

1. Floors: titles are sorted by their rarest terms and cut into blocks; a title's k-th best score within its block is a
   floor under its k-th best of all. Of several orders the highest floor counts.
2. Bins: two titles whose first bin in common is b reach at most the product of their norms from b on. So a title asks
   only in the bins from which on its norm is still at its floor or above, and there only titles with norm enough meet it.
   Those that ask in a bin and those that may answer are dealt out into blocks; every two blocks meet in a task, which
   scores them from b on by a matrix product, longest norms first, as far as the product of norms reaches a floor.
3. Of a title's scores with a block only those at its floor or above are looked at, and of them the k + 1 best leave
   the task; so neither the pairs nor the score matrix are ever shuffled or stored.

Terms that many titles of a block have are multiplied as dense columns, the others by their lists. Where the floors are
so low that the bins would make more work than all pairs, all titles meet in one bin: then ten times the titles take a
hundred times as long, in tasks of the same size.

``prefixes`` and ``meeting`` tell what the floors leave for a join over postings: terms go from rare to common; as soon
as what is left of a title's vector is shorter than its floor, the rest alone reaches no result, so only the terms
before that (the prefix) need looking up, and a pair they find is dropped if its partial score and the most the two
rests can add stay below the floor.

Titles with the same term counts have the same vector; they are compared once, through the smallest id, and each
group lists its k + 1 smallest ids, so a large group of copies is never paired with itself. Titles with
fewer than k positive scores are filled up with score 0, smallest ids first. Scores are rounded and ties go by
id, as in the one-title recommendation.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.keys import dense_ids
from shelfwise.operators.recommend import SCORE_DECIMALS
from shelfwise.sources.tables import materialize

#: Titles and postings of a block: about these at most; blocks of titles in order are few enough for ``BLOCKS``, but not below ``SMALL`` titles.
BLOCK, POSTINGS, BLOCKS, SMALL = 32_768, 400_000, 16, 2_048
#: Titles scored against a block at once, and the share of a block from which on a term is a dense column.
CHUNK, DENSE = 256, 1 / 64
#: Scores closer than this may be equal after rounding.
MARGIN = 10.0 ** -SCORE_DECIMALS
#: Postings of a bin of rare terms; orders (by the rarest term, by the second rarest, ...) that give floors; terms of an order.
BIN, ORDERS, ORDERED_BY = 1_024, 2, 6
#: Pairs that a task scores, about; times all pairs from which on the bins are given up.
PAIRS_PER_TASK, TOO_MANY = 1 << 28, 2


def copies(postings: DataFrame) -> DataFrame:
    """(doc_id, rep): the smallest id with the same terms and counts."""
    terms = F.array_sort(F.collect_list(F.concat_ws(":", "term", "tf")))   # bounded by the vocabulary
    keyed = postings.groupBy("doc_id").agg(F.sha2(F.array_join(terms, ","), 256).alias("_key"))
    reps = keyed.groupBy("_key").agg(F.min("doc_id").alias("rep"))
    return keyed.join(reps, "_key").select("doc_id", "rep")


def _n_blocks(postings: DataFrame) -> int:
    n, size = postings.agg(F.count_distinct("doc_id"), F.count(F.lit(1))).first()
    return max(1, -(-n // BLOCK), -(-size // POSTINGS), min(BLOCKS, -(-n // SMALL)))


def _vectors(postings: DataFrame) -> DataFrame:
    """(doc_id, codes, weights, bins): each title's terms as numbers, rare first, and their bins, which are ascending
    stretches of numbers. Stored."""
    df = postings.groupBy("term").agg(F.count(F.lit(1)).alias("_df"))
    level = F.floor(F.log2("_df")).cast("long")
    width = F.greatest(F.lit(1), F.floor(F.lit(BIN) / F.pow(F.lit(2), level + 1))).cast("long")   # terms of a bin
    codes = dense_ids(df, ["_df", "term"], "_code").select(
        "term", F.col("_code").cast("int").alias("code"),
        (F.shiftleft(level, 40) + F.floor(F.col("_code") / width).cast("long")).alias("bin"))
    own = F.array_sort(F.collect_list(F.struct("code", "weight", "bin")))                         # bounded by the vocabulary
    rows = postings.join(codes, "term").groupBy("doc_id").agg(own.alias("v")).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("v.code").alias("codes"), F.col("v.weight").alias("weights"),
        F.col("v.bin").alias("bins"))
    return materialize(rows, "vectors")


def _entered(vectors: DataFrame) -> DataFrame:
    """(doc_id, codes, weights, floor, at): ``vectors`` with where each bin of theirs begins and their norm from there on. Stored."""
    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            size = batch.column(1).value_lengths().to_numpy()
            start = np.cumsum(size) - size
            weight, bins = (batch.column(c).flatten().to_numpy() for c in (2, 4))
            back = np.append(np.cumsum((weight * weight)[::-1])[::-1], 0.0)     # of all rows to the end of the batch
            new = np.append(True, bins[1:] != bins[:-1])
            new[start] = True
            at = np.flatnonzero(new)
            row = np.searchsorted(start, at, side="right") - 1
            # a hair more than the norm, so that rounding never makes the bound too small
            norm = np.sqrt(np.maximum(back[at] - back[start[row] + size[row]], 0.0) + 1e-9) + 1e-9
            entries = pa.StructArray.from_arrays([pa.array(bins[at]), pa.array(norm), pa.array((at - start[row] + 1).astype(np.int32))],
                                                 ["bin", "norm", "first"])
            ends = pa.array(np.append(np.searchsorted(at, start), len(at)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.ListArray.from_arrays(ends, entries)],
                                             ["doc_id", "codes", "weights", "floor", "at"])

    return materialize(vectors.select("doc_id", "codes", "weights", "floor", "bins").mapInArrow(
        norms, "doc_id long, codes array<int>, weights array<double>, floor double, "
               "at array<struct<bin:long,norm:double,first:int>>"), "entered")


class Block(NamedTuple):
    """Titles: ids, the place of each one's first posting (and the end), terms and weights."""

    ids: np.ndarray
    start: np.ndarray
    code: np.ndarray
    weight: np.ndarray


def _block(rows: pa.Table) -> Block:
    codes, weights = (rows.column(c).combine_chunks() for c in ("codes", "weights"))
    start = np.append(0, np.cumsum(codes.value_lengths().to_numpy()))
    return Block(rows.column("doc_id").to_numpy(), start, codes.flatten().to_numpy(), weights.flatten().to_numpy())


def _scores(left: Block, right: Block, reach: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """The scores of the titles of ``left`` with those of ``right``: (first row, matrix) a chunk of ``CHUNK`` rows;
    with ``reach`` only with so many of ``right``, the most that a title of the chunk has there."""
    n, m = len(left.ids), len(right.ids)
    terms, ty = np.unique(right.code, return_inverse=True)
    y, wy = np.repeat(np.arange(m), np.diff(right.start)), right.weight
    tx = np.minimum(np.searchsorted(terms, left.code), len(terms) - 1)
    known = terms[tx] == left.code
    x, tx, wx = np.repeat(np.arange(n), np.diff(left.start))[known], tx[known], left.weight[known]
    count = np.bincount(ty, minlength=len(terms))
    common = count > m * DENSE
    column = np.cumsum(common) - 1
    dense = np.zeros((m, int(common.sum())))
    dense[y[common[ty]], column[ty[common[ty]]]] = wy[common[ty]]
    by_term = np.argsort(ty, kind="stable")                   # the lists of the other terms
    y, wy, at = y[by_term], wy[by_term], np.cumsum(count) - count
    for lo in range(0, n, CHUNK):
        to = m if reach is None else int(reach[lo:lo + CHUNK].max())
        a, b = np.searchsorted(x, (lo, lo + CHUNK))
        r, t, w = x[a:b] - lo, tx[a:b], wx[a:b]
        mine = np.zeros((min(CHUNK, n - lo), dense.shape[1]))
        mine[r[common[t]], column[t[common[t]]]] = w[common[t]]
        s = mine @ dense[:to].T
        r, t, w = r[~common[t]], t[~common[t]], w[~common[t]]
        size = count[t]
        place = np.repeat(at[t] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        r, w, place = (v[y[place] < to] for v in (np.repeat(r, size), np.repeat(w, size), place))
        np.add.at(s.reshape(-1), r * to + y[place], w * wy[place])
        yield lo, s


def _kth(s: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row; 0 where there are fewer."""
    return np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k] if s.shape[1] >= k else np.zeros(len(s))


def _without_self(left: Block, right: Block, lo: int, s: np.ndarray, by_id: np.ndarray) -> None:
    """Scores of titles with themselves become 0; ``by_id``: the order of ``right`` by id."""
    ids = left.ids[lo:lo + len(s)]
    there = by_id[np.minimum(np.searchsorted(right.ids, ids, sorter=by_id), len(by_id) - 1)]
    found = np.flatnonzero((right.ids[there] == ids) & (there < s.shape[1]))
    s[found, there[found]] = 0.0


def _floors(vectors: DataFrame, n_blocks: int, k: int) -> DataFrame:
    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            cuts = np.linspace(0, len(rows), -(-len(rows) // SMALL) + 1).astype(int)
            for lo, hi in zip(cuts, cuts[1:]):
                part = rows.slice(lo, hi - lo)
                # a remnant alone would have few to compare with
                left, right = _block(part), _block(part if before is None or hi - lo >= SMALL // 2 else pa.concat_tables([part, before]))
                by_id, best = np.argsort(right.ids, kind="stable"), np.zeros(hi - lo)
                for at, s in _scores(left, right):
                    _without_self(left, right, at, s, by_id)
                    best[at:at + len(s)] = _kth(s, k)
                before, found = part, best > 0
                yield pa.RecordBatch.from_arrays([pa.array(left.ids[found]), pa.array(best[found] - MARGIN)], ["q", "floor"])

    def by(order: int) -> DataFrame:
        key = [F.slice("codes", order + 1, ORDERED_BY), "doc_id"]
        return (vectors.select("doc_id", "codes", "weights").repartitionByRange(n_blocks, *key).sortWithinPartitions(*key)
                .mapInArrow(own, "q long, floor double"))

    return reduce(DataFrame.unionByName, map(by, range(ORDERS))).groupBy("q").agg(F.max("floor").alias("floor"))


def floors(postings: DataFrame, k: int) -> DataFrame:
    """(q, floor): a lower bound of each title's k-th best score, its k-th best within a block of titles with the same
    rare terms; titles with fewer than k positive scores there are left out."""
    return _floors(_vectors(postings), _n_blocks(postings), k)


def prefixes(postings: DataFrame, floor: DataFrame) -> DataFrame:
    """Every posting with whether it is in its title's prefix, the norm of the title's rest, and its floor."""
    df = postings.groupBy("term").agg(F.count(F.lit(1)).alias("_df"))
    rare_first = Window.partitionBy("doc_id").orderBy("_df", "term").rowsBetween(Window.unboundedPreceding, -1)
    square = F.col("weight") * F.col("weight")
    before = F.coalesce(F.sum(square).over(rare_first), F.lit(0.0))
    # a hair more than the rest's norm, so that rounding never makes the bound too small
    left = F.sqrt(F.greatest(F.lit(0.0), F.lit(1.0) - before)) + 1e-9
    known = floor.select(F.col("q").alias("doc_id"), "floor")
    marked = (postings.join(df, "term").join(known, "doc_id", "left").withColumn("floor", F.coalesce("floor", F.lit(0.0)))
              .withColumn("inside", left >= F.col("floor")))
    rest = F.sum(F.when(~F.col("inside"), square).otherwise(0.0)).over(Window.partitionBy("doc_id"))
    return marked.withColumn("rest", F.sqrt(rest) + 1e-9).drop("_df")


def meeting(marked: DataFrame) -> DataFrame:
    """(q, y, part, most, floor): pairs that a prefix finds, their partial score and the most they can reach."""
    a = marked.filter("inside").select(F.col("doc_id").alias("q"), "term", F.col("weight").alias("_wq"), "rest", "floor")
    b = marked.select(F.col("doc_id").alias("y"), "term", F.col("weight").alias("_wy"))
    met = a.join(b, "term").filter("q <> y").groupBy("q", "y").agg(
        F.sum(F.col("_wq") * F.col("_wy")).alias("part"), F.sum(F.col("_wy") * F.col("_wy")).alias("_used"),
        F.first("rest").alias("rest"), F.first("floor").alias("floor"))
    other = F.sqrt(F.greatest(F.lit(0.0), F.lit(1.0) - F.col("_used"))) + 1e-9
    return met.select("q", "y", "part", (F.col("part") + F.col("rest") * other).alias("most"), "floor")


def _met(vectors: DataFrame, n_blocks: int) -> tuple[DataFrame, DataFrame, int]:
    """The titles that ask and those that answer, each a row for every (bin, i, j) where it meets a block of the others,
    with its terms from that bin on, and the number of tasks. ``vectors`` have a ``floor`` (0: none known)."""
    def placed(titles: DataFrame) -> DataFrame:
        entry = titles.select("doc_id", "codes", "weights", "floor", F.inline("at"))
        return entry.withColumns({c: F.slice(c, F.col("first"), F.size(c)) for c in ("codes", "weights")}).drop("first")

    def counted(titles: DataFrame) -> DataFrame:
        """(bin, least, m, n): the lowest norm that reaches a floor there, the titles that ask, those that answer."""
        entries = placed(titles)
        asked = entries.filter("norm >= floor").groupBy("bin").agg(
            (F.min(F.col("floor") / F.col("norm")) - 1e-9).alias("least"), F.count(F.lit(1)).alias("m"))
        answering = entries.join(F.broadcast(asked), "bin").filter("norm >= least").groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
        return materialize(asked.join(answering, "bin"), "bins")

    size, n = vectors.agg(F.sum(F.size("codes")), F.count(F.lit(1))).first()
    bins = counted(vectors)
    pairs = bins.agg(F.sum(F.col("m").cast("double") * F.col("n"))).first()[0] or 0
    if pairs > TOO_MANY * n * n:
        one = F.array(F.struct(F.lit(0).cast("long").alias("bin"), F.element_at("at", 1)["norm"].alias("norm"),
                               F.lit(1).alias("first")))
        vectors = vectors.withColumn("at", one)
        bins, pairs = counted(vectors), n * n
    block = max(1, min(BLOCK, POSTINGS * n // max(size or 0, 1)))
    # bins have about BIN postings or a term of more: a row for each, and few beside the postings, hence broadcast
    blocks = F.broadcast(bins.select("bin", "least", F.ceil(F.col("m") / block).alias("_m"), F.ceil(F.col("n") / block).alias("_n")))
    entries = placed(vectors).join(blocks, "bin")
    mine = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n))                       # noqa: E731
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    asking = entries.filter("norm >= floor").select("bin", mine("_m").alias("i"), every("_n").alias("j"), "doc_id", "codes", "weights", "norm", "floor")
    answering = entries.filter("norm >= least").select(
        every("_m").alias("i"), mine("_n").alias("j"), *[F.col(c).alias(c) for c in ("bin", "doc_id", "codes", "weights", "norm")])
    return asking, answering, max(n_blocks, -(-int(pairs) // PAIRS_PER_TASK))


def similar_pairs(postings: DataFrame, k: int) -> DataFrame:
    """(q, y, score) of distinct vectors: each title's k + 1 best with a positive score, exact, ties to the smaller id."""
    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(left) and len(right):        # else a block without a title
            needed = left.column("floor").to_numpy() / left.column("norm").to_numpy() - 1e-9
            left, right = left.take(pa.array(np.argsort(needed, kind="stable"))), right.sort_by([("norm", "descending")])
            a, b, floors = _block(left), _block(right), left.column("floor").to_numpy()
            reach = np.searchsorted(-right.column("norm").to_numpy(), -np.sort(needed), side="right")
            by_id = np.argsort(b.ids, kind="stable")
            for lo, s in _scores(a, b, reach):
                _without_self(a, b, lo, s, by_id)
                floor = floors[lo:lo + len(s)].copy()
                at = np.flatnonzero(floor <= 0)
                floor[at] = _kth(s[at], k + 1) - 2 * MARGIN
                r, c = np.nonzero(s >= np.maximum(floor, np.finfo(float).tiny)[:, None])
                score = np.rint(s[r, c] / MARGIN)
                order = np.lexsort((b.ids[c], -score, r))
                r, c, score = r[order], c[order], score[order]
                few = np.arange(len(r)) - np.searchsorted(r, r) <= k
                found.append((a.ids[lo + r[few]], b.ids[c[few]], score[few]))
        q, y, score = (np.concatenate(x) for x in zip(*found))
        return pa.table({"q": q, "y": y, "score": score / round(1 / MARGIN)})

    n = _n_blocks(postings)
    vectors = _vectors(postings)
    known = _floors(vectors, n, k).select(F.col("q").alias("doc_id"), "floor")
    asking, answering, tasks = _met(_entered(vectors.join(known, "doc_id", "left").fillna(0.0, ["floor"])), n)
    unit = ["bin", "i", "j"]
    met = asking.repartition(tasks, *unit).groupBy(*unit).cogroup(answering.repartition(tasks, *unit).groupBy(*unit)).applyInArrow(
        best, "q long, y long, score double")
    # two titles may meet in several bins: in the first with their whole score, in others with what is left of it
    once = met.filter("score > 0").repartition("q").groupBy("q", "y").agg(F.max("score").alias("score"))
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "y")
    return once.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k + 1).select("q", "y", "score")


def most_similar(postings: DataFrame, docs: DataFrame, k: int = 10) -> DataFrame:
    """(doc_id, rank, similar_id, score), the ``k`` most similar other documents of every row of ``docs``.

    ``postings`` are the unit-length (doc_id, term, tf, weight) of ``docs``; a document without postings scores 0
    with all others. With fewer than k + 1 documents each gets all others."""
    ids = docs.select("doc_id")
    same = materialize(copies(postings), "copies")
    distinct = postings.join(same.filter("doc_id = rep").select("doc_id"), "doc_id", "left_semi")
    pairs = similar_pairs(materialize(distinct, "distinct-vectors"), k)
    own = same.filter("doc_id = rep").select(F.col("rep").alias("q"), F.col("rep").alias("y"), F.lit(1.0).alias("score"))
    by_id = Window.partitionBy("rep").orderBy("doc_id")
    members = (same.withColumn("_n", F.row_number().over(by_id)).filter(F.col("_n") <= k + 1)
               .select(F.col("rep").alias("y"), F.col("doc_id").alias("similar_id")))
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), "similar_id")
    lists = (pairs.unionByName(own).filter("score > 0").join(members, "y")
             .withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= k + 1)
             .select(F.col("q").alias("rep"), "similar_id", "score"))
    positive = materialize(same.join(lists, "rep").filter("similar_id <> doc_id")
                           .select("doc_id", "similar_id", "score"), "positive")
    return _ranked(positive.unionByName(_zeros(ids, positive, k)), k)


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("doc_id").orderBy(F.col("score").desc(), "similar_id")
    return (scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("doc_id", "rank", "similar_id", "score"))


def _zeros(ids: DataFrame, positive: DataFrame, k: int) -> DataFrame:
    """Score-0 rows for documents with fewer than ``k`` positive scores. Of the 2k + 1 smallest ids at most k are
    positive and one is the document itself, so they always hold enough."""
    first = [r[0] for r in ids.orderBy("doc_id").limit(2 * k + 1).collect()]
    if not first:
        return positive.limit(0)
    found = positive.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
    short = ids.join(found, "doc_id", "left").filter(F.coalesce("_n", F.lit(0)) < k).select("doc_id")
    offered = short.withColumn("similar_id", F.explode(F.array(*map(F.lit, first)))).filter("similar_id <> doc_id")
    return (offered.join(positive.select("doc_id", "similar_id"), ["doc_id", "similar_id"], "left_anti")
            .withColumn("score", F.lit(0.0)))
