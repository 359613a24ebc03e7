"""Dashboard marts kept by signed deltas.

A mart row is a set of exact integers over the titles of its key: how many, and the sums behind its means (scores and
minutes in hundredths, members). Integers can be taken back, so a change needs only what a changed title had put in,
negated, and what it puts in now. ``mart_changes`` reads that from a differential of the cleaned table, looking at the
changed titles alone; ``apply_changes`` adds it to the stored sums, and a key whose last title left goes.
``finish`` turns sums into the rows of ``marts``.

All four marts are one table (mart, key, part, n_titles, ...): one grouping of the changed titles feeds all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.numeric import mean_from_sums
from shelfwise.operators.marts import episode_bucket
from shelfwise.operators.normalize import split_values

KEYS = ("mart", "key", "part")
SUMS = ("n_titles", "n_scores", "sum_scores", "sum_members", "n_members", "n_minutes", "sum_minutes")
MARTS = ("popular_genres", "studio_output", "score_distribution", "episode_distribution")


def _hundredths(c: str) -> Column:
    return F.coalesce(F.round(F.col(c) * 100).cast("long"), F.lit(0))


def _known(c: str) -> Column:
    return F.col(c).isNotNull().cast("long")


def contributions(clean: DataFrame, sign: int = 1) -> DataFrame:
    """What each title puts into each mart, times ``sign``: a row a listed genre and studio (once each), one a score
    bucket and rating, one an episode bucket and media type."""
    own = {"n_titles": F.lit(1).cast("long"), "n_scores": _known("score"), "sum_scores": _hundredths("score"),
           "sum_members": F.coalesce(F.col("members").cast("long"), F.lit(0)), "n_members": _known("members"),
           "n_minutes": _known("duration_min"), "sum_minutes": _hundredths("duration_min")}
    sums = [(F.lit(sign) * c).alias(n) for n, c in own.items()]
    none = F.lit(None).cast("string")
    parts = []
    for mart, col in (("popular_genres", "genres"), ("studio_output", "studio")):
        named = split_values(clean, col).select("title_id", F.col("value").alias("key")).distinct()
        parts.append(clean.join(named, "title_id").select(F.lit(mart).alias("mart"), "key", none.alias("part"), *sums))
    bucket = F.floor("score").cast("int").cast("string")
    parts.append(clean.select(F.lit("score_distribution").alias("mart"), bucket.alias("key"), F.col("rating").alias("part"), *sums))
    parts.append(clean.select(F.lit("episode_distribution").alias("mart"), episode_bucket().alias("key"),
                              F.col("media_type").alias("part"), *sums))
    return reduce(DataFrame.unionByName, parts)


def _added(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in SUMS))


def mart_sums(clean: DataFrame) -> DataFrame:
    """The marts' sums over a whole cleaned table (one row a ``title_id``)."""
    return _added(contributions(clean))


def mart_changes(base: DataFrame, diff: DataFrame, key: str = "title_id") -> DataFrame:
    """Signed sums of a differential (``op`` I, U, D or K and the current columns) of the table ``base``: of it only the
    changed and deleted rows are looked at. Keys that cancel out are left out."""
    old = base.join(diff.filter("op <> 'I'").select(key), key, "left_semi")
    new = diff.filter("op <> 'D'").select(*base.columns)
    changes = _added(contributions(old, -1).unionByName(contributions(new)))
    return changes.filter(" OR ".join(f"{c} <> 0" for c in SUMS))


def apply_changes(sums: DataFrame, changes: DataFrame) -> DataFrame:
    """Stored sums with changes added; a key without a title left goes."""
    return _added(sums.unionByName(changes)).filter("n_titles <> 0")


def finish(sums: DataFrame, mart: str) -> DataFrame:
    """One mart with the columns that ``operators.marts`` gives it."""
    rows = sums.filter(F.col("mart") == mart)
    if mart in ("popular_genres", "studio_output"):
        name = "genre_name" if mart == "popular_genres" else "studio_name"
        return rows.select(F.col("key").alias(name), "n_titles", mean_from_sums(F.col("sum_scores"), F.col("n_scores"), 2, 4).alias("avg_score"),
                           F.when(F.col("n_members") > 0, F.col("sum_members")).alias("sum_members"))
    if mart == "score_distribution":
        return rows.select(F.col("key").cast("int").alias("score_bucket"), F.col("part").alias("rating"), "n_titles")
    return rows.select(F.col("key").alias("episode_bucket"), F.col("part").alias("media_type"), "n_titles",
                       mean_from_sums(F.col("sum_minutes"), F.col("n_minutes"), 2, 2).alias("avg_minutes"))
