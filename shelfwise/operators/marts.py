"""Dashboard aggregates over the star.

The reference names four dashboards (popular genres, scores, episode counts,
studios) without shipping their formulas; these are the definitions used
here. Means are exact (``exact_mean``). Every one is a join into the
title/statistic rows and a ``groupBy`` with map-side partial aggregation, so
a genre or studio carried by a third of all titles is one partial row per
task before the shuffle. Whole results by default; with ``k`` ``orderBy(...).limit(k)`` - a
per-task top-k merged once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.numeric import exact_mean

# Episode buckets: (label, lowest episode count), ascending.
EPISODE_BUCKETS = (("1", 1), ("2-12", 2), ("13-26", 13), ("27-52", 27), ("53+", 53))


def _title_stats(star: dict[str, DataFrame]) -> DataFrame:
    return (star["title"].join(star["statistic"].select("statistic_id", "score", "members"), "statistic_id", "left")
            .select("title_id", "score", "members", "episodes", "duration_min", "rating_id", "media_type_id"))


def _per_list_value(star, bridge: str, dim: str, id_col: str, name_col: str, k: int | None) -> DataFrame:
    pairs = star[bridge].select("title_id", id_col).distinct()   # a title lists a value once
    per = (pairs.join(_title_stats(star), "title_id")
           .groupBy(id_col)
           .agg(F.count(F.lit(1)).alias("n_titles"),
                exact_mean("score", 2, 4).alias("avg_score"),
                F.sum("members").cast("bigint").alias("sum_members")))
    out = per.join(star[dim], id_col).select(name_col, "n_titles", "avg_score", "sum_members")
    if k is None:
        return out
    return out.orderBy(F.col("n_titles").desc(), F.col(name_col)).limit(k)


def popular_genres(star: dict[str, DataFrame], k: int | None = None) -> DataFrame:
    """B1: titles, mean score and total members per genre; with ``k`` the top k by titles."""
    return _per_list_value(star, "title_genre", "genre", "genre_id", "genre_name", k)


def studio_output(star: dict[str, DataFrame], k: int | None = None) -> DataFrame:
    """Titles, mean score and total members per studio; with ``k`` the top k by titles."""
    return _per_list_value(star, "title_studio", "studio", "studio_id", "studio_name", k)


def score_distribution(star: dict[str, DataFrame]) -> DataFrame:
    """B2: titles per whole-point score bucket and rating (NULL score → NULL
    bucket)."""
    t = _title_stats(star).join(star["rating"], "rating_id", "left")
    return (t.groupBy(F.floor("score").cast("int").alias("score_bucket"), "rating")
            .agg(F.count(F.lit(1)).alias("n_titles")))


def episode_bucket(col: str = "episodes"):
    c = F.col(col)
    expr = None
    for label, low in reversed(EPISODE_BUCKETS):
        expr = F.when(c >= low, F.lit(label)) if expr is None else expr.when(c >= low, F.lit(label))
    return expr


def episode_distribution(star: dict[str, DataFrame]) -> DataFrame:
    """Titles and mean minutes per episode bucket and media type."""
    t = _title_stats(star).join(star["media_type"], "media_type_id", "left")
    return (t.groupBy(episode_bucket().alias("episode_bucket"), "media_type")
            .agg(F.count(F.lit(1)).alias("n_titles"), exact_mean("duration_min", 2, 2).alias("avg_minutes")))
