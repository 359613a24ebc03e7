"""Cosine recommendations over TF-IDF postings.

A query vector has at most ``MAX_FEATURES`` non-zero terms (the vocabulary
cap), so it is broadcast; scoring is a broadcast hash join against the
postings plus a partial-aggregated sum per document - one pass over the
postings, no shuffle of them on the term key, so a term found in every
document costs nothing extra. Titles that share no term with the query still
rank (score 0), as in the reference, through a left join from all documents.
Ranking: ``round(score, 6)`` descending, then document id; the top-k is a
``TakeOrderedAndProject`` (k rows per task, then merged), never a global sort.

The reference also precomputes the full N × N similarity matrix and reads a
single row of it; here only that row is computed (one-vs-all), which is
exact and linear in the postings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.sources.tables import materialize

SCORE_DECIMALS = 6
DEFAULT_LENGTH = 10


def title_lookup(docs: DataFrame, id_col: str = "doc_id", name_col: str = "title_name") -> DataFrame:
    """Name → first document id (smallest id among equal names)."""
    return docs.groupBy(name_col).agg(F.min(id_col).alias(id_col))


def mean_vector(postings: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """A5: element-wise mean of the chosen documents' vectors. ``ids`` may
    repeat a document (it then counts twice); missing terms count as 0."""
    n = ids.agg(F.count(F.lit(1))).scalar()
    chosen = ids.groupBy(id_col).agg(F.count(F.lit(1)).alias("_times"))
    return (postings.join(F.broadcast(chosen), id_col)
            .groupBy("term").agg((F.sum(F.col("weight") * F.col("_times")) / n).alias("qw")))


def cosine_one_vs_all(postings: DataFrame, query: DataFrame, docs: DataFrame,
                      id_col: str = "doc_id", normalise_query: bool = True) -> DataFrame:
    """Cosine of one query vector (term, qw) against every document of
    ``docs``; documents without a shared term score 0."""
    q = F.broadcast(query.select("term", "qw"))  # ≤ MAX_FEATURES rows
    dots = postings.join(q, "term").groupBy(id_col).agg(F.sum(F.col("weight") * F.col("qw")).alias("dot"))
    score = F.coalesce(F.col("dot"), F.lit(0.0))
    if normalise_query:
        qnorm = query.agg(F.sqrt(F.sum(F.col("qw") * F.col("qw")))).scalar()
        score = F.when(qnorm > 0, score / qnorm).otherwise(F.lit(0.0))
    return docs.join(dots, id_col, "left").withColumn("score", score).drop("dot")


def top_k(scored: DataFrame, k: int, id_col: str = "doc_id") -> DataFrame:
    """O1: the k best by rounded score, ties by id."""
    ranked = scored.withColumn("score", F.round("score", SCORE_DECIMALS))
    return ranked.orderBy(F.col("score").desc(), F.col(id_col)).limit(k)


def _with_rank(best: DataFrame, id_col: str) -> DataFrame:
    w = Window.orderBy(F.col("score").desc(), F.col(id_col))  # ≤ k rows
    return best.withColumn("rank", F.row_number().over(w))


def top_k_with_zeros(postings: DataFrame, query: DataFrame, candidates: DataFrame, k: int,
                     id_col: str = "doc_id", normalise_query: bool = True) -> DataFrame:
    """R7 + O1 without joining every document to the scores.

    ``candidates`` are the documents allowed in the result (ids only). The
    top-k is taken from the documents that share a term with the query; if
    fewer than k of them score above 0 (after rounding), every positive one
    is already in that top-k, and the rest are the smallest-id candidates
    outside that (< k) positive set, with score 0 - as a full ranking would
    give. Documents are only scanned: the positive set is broadcast."""
    q = F.broadcast(query.select("term", "qw"))  # ≤ MAX_FEATURES rows
    dots = (postings.join(q, "term").groupBy(id_col).agg(F.sum(F.col("weight") * F.col("qw")).alias("score"))
            .join(candidates, id_col, "left_semi"))
    if normalise_query:
        qnorm = query.agg(F.sqrt(F.sum(F.col("qw") * F.col("qw")))).scalar()
        dots = dots.withColumn("score", F.when(qnorm > 0, F.col("score") / qnorm).otherwise(F.lit(0.0)))
    best = materialize(top_k(dots, k, id_col), "top-k")               # ≤ k rows, computed once
    positive = best.filter(F.col("score") > 0)
    n_pos = positive.count()
    if n_pos >= k:
        return best
    fill = (candidates.join(F.broadcast(positive.select(id_col)), id_col, "left_anti")
            .orderBy(id_col).limit(k - n_pos).select(id_col, F.lit(0.0).alias("score")))
    return positive.unionByName(fill)


def _with_names(best: DataFrame, docs: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """Rank the ≤ k best and attach name and synopsis (broadcast of ≤ k rows
    against a scan of the documents)."""
    named = docs.select(id_col, name_col, "synopsis").join(F.broadcast(best), id_col)
    return _with_rank(named, id_col).select("rank", id_col, name_col, "synopsis", "score").orderBy("rank")


def recommend_by_title(postings: DataFrame, docs: DataFrame, title: str, length: int = DEFAULT_LENGTH,
                       id_col: str = "doc_id", name_col: str = "title_name") -> DataFrame:
    """The ``length`` titles most like ``title`` (itself excluded), as
    (rank, doc_id, title_name, synopsis, score). Unknown title → ValueError.

    The lookup is resolved once to a scalar id (one action), so the query
    vector is a pushed-down filter on the postings and the exclusion a plain
    filter. Postings are unit length, so the dot product is the cosine."""
    qid = docs.filter(F.col(name_col) == F.lit(title)).agg(F.min(id_col)).first()[0]
    if qid is None:
        raise ValueError(f"'{title}' does not exist in the data.")
    query = postings.filter(F.col(id_col) == F.lit(qid)).select("term", F.col("weight").alias("qw"))
    candidates = docs.select(id_col).filter(F.col(id_col) != F.lit(qid))
    best = top_k_with_zeros(postings, query, candidates, length, id_col, normalise_query=False)
    return _with_names(best, docs, id_col, name_col)


def recommend_by_list(postings: DataFrame, docs: DataFrame, titles: Sequence[str],
                      length: int = DEFAULT_LENGTH, id_col: str = "doc_id", name_col: str = "title_name") -> DataFrame:
    """Titles most like the mean vector of the listed titles. Unknown
    names are dropped; an empty list, or one where no name is known, raises
    ValueError. Every title whose name is in the list is excluded.

    The list is user input (a handful of names): its names are resolved to
    first ids in one action over the documents that carry them (semi join
    against the broadcast list), and the profile is built from a small
    frame of resolved ids (repeats kept) - the postings are filtered by those
    ids before anything is joined."""
    if not titles:
        raise ValueError("The list of titles must not be empty.")
    spark = docs.sparkSession
    names = F.broadcast(spark.createDataFrame([(t,) for t in dict.fromkeys(titles)],
                                              T.StructType([T.StructField(name_col, T.StringType())])))
    first = dict(title_lookup(docs.join(names, name_col, "left_semi"), id_col, name_col).collect())
    known = [first[t] for t in titles if t in first]   # repeats count, unknown names dropped
    if not known:
        raise ValueError(f"None of the titles is known: {list(titles)[:20]}")
    ids = spark.createDataFrame([(i,) for i in known], T.StructType([T.StructField(id_col, T.LongType())]))
    query = mean_vector(postings.filter(F.col(id_col).isin(sorted(set(known)))), ids, id_col)
    candidates = docs.join(names, name_col, "left_anti").select(id_col)
    best = top_k_with_zeros(postings, query, candidates, length, id_col)
    return _with_names(best, docs, id_col, name_col)


__all__ = ["title_lookup", "mean_vector", "cosine_one_vs_all", "top_k", "recommend_by_title",
           "recommend_by_list"]
