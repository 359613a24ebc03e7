"""Cleaning operators for the raw wide title table.

Each is ``DataFrame -> DataFrame`` and chains with ``df.transform``. A T-SQL
``UPDATE t SET c = e WHERE p`` becomes ``when(p, e).otherwise(c)`` (UNKNOWN
keeps the old value in both); ``DELETE WHERE p`` becomes
``filter(~coalesce(p, false))``.

Scale notes: no operator here puts a whole key group into one task. The
per-episode mean (C7) is a partial (map-side) aggregate joined back, and the
de-duplication (C9) picks survivors with an aggregate too, so a key that holds
a third of all rows is reduced inside every map task before anything is
shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import parse
from shelfwise.functions.numeric import exact_mean


def drop_blank_rows(df: DataFrame, col: str = "title_name") -> DataFrame:
    """Delete rows whose name is NULL or only spaces."""
    c = F.col(col)
    return df.filter(c.isNotNull() & (F.trim(c) != ""))


def trim_column(df: DataFrame, col: str = "studio") -> DataFrame:
    """LTRIM(RTRIM(col)) on every row (spaces only, as in T-SQL)."""
    return df.withColumn(col, F.trim(F.col(col)))


def _fill(df: DataFrame, col: str, missing: Sequence[str], value: str) -> DataFrame:
    c = F.col(col)
    return df.withColumn(col, F.when(c.isNull() | c.isin(*missing), F.lit(value)).otherwise(c))


def fill_premiered(df: DataFrame, col: str = "premiered") -> DataFrame:
    """NULL or '?' → 'N/A'."""
    return _fill(df, col, parse.PREMIERED_MISSING, parse.NOT_AVAILABLE)


def fill_studio(df: DataFrame, col: str = "studio") -> DataFrame:
    """C4: NULL or 'None found, add some' → 'N/A'."""
    return _fill(df, col, parse.STUDIO_MISSING, parse.NOT_AVAILABLE)


def fill_episodes(df: DataFrame, col: str = "episodes", value: int = 1) -> DataFrame:
    """NULL episodes → 1."""
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(value).cast("int")))


def fill_missing(df: DataFrame) -> DataFrame:
    """C3-C5 together (the row-level trigger body)."""
    return df.transform(fill_premiered).transform(fill_studio).transform(fill_episodes)


def parse_duration(df: DataFrame, col: str = "duration", out: str = "duration_min",
                   strict: bool = False) -> DataFrame:
    """Free-text duration → minutes (first matching shape wins).

    Rows with NULL duration get NULL. A text that has a numeric shape but does
    not parse gives NULL (``strict=True`` raises instead, as the reference
    statement would fail).
    """
    res = df.withColumn(out, parse.duration_minutes(F.col(col)))
    if strict:
        bad = res.filter(parse.duration_shape_matched(F.col(col)) & F.col(out).isNull())
        if not bad.isEmpty():
            sample = [r[col] for r in bad.select(col).limit(5).collect()]
            raise ValueError(f"unparsable duration values, e.g. {sample}")
    return res


def avg_by_key(df: DataFrame, col: str, by: str, out: str, decimals: int = 2) -> DataFrame:
    """A1: ROUND(AVG(col), decimals) per non-NULL ``by`` over non-NULL values
    (partial aggregate, combined map-side). The mean is exact (integer sum of
    values with ≤ ``decimals`` decimals), so a boundary value rounds the same
    way for any partitioning."""
    return (df.filter(F.col(col).isNotNull() & F.col(by).isNotNull())
            .groupBy(by).agg(exact_mean(col, decimals, decimals).alias(out)))


def impute_duration(df: DataFrame, col: str = "duration_min", by: str = "episodes") -> DataFrame:
    """NULL minutes → ROUND(AVG(minutes of rows with equal ``by``), 2).

    Rows whose ``by`` is NULL, or that have no peer with known minutes, stay
    NULL. Written as an aggregate + left join (not a window): the aggregate is
    combined map-side, so a hot ``by`` value never lands whole in one task, and
    AQE broadcasts the (small) per-key means when their real size allows.
    """
    peers = avg_by_key(df, col, by, "_peer_avg")
    return (df.join(peers, on=by, how="left")
            .withColumn(col, F.coalesce(F.col(col), F.col("_peer_avg")))
            .drop("_peer_avg")
            .select(*df.columns))


def collapse_rating(df: DataFrame, col: str = "rating") -> DataFrame:
    """Keep only the rating code where the text carries a '-' comment."""
    return df.withColumn(col, parse.collapse_rating(F.col(col)))


def _survivors(df: DataFrame, keys: list[str], order_by) -> DataFrame:
    others = [c for c in df.columns if c not in keys]
    payload = F.struct(*[F.col(c) for c in others])
    if order_by:
        order = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_by])
        pick = F.min_by(payload, order)
    else:
        pick = F.min(payload)
    return (df.groupBy(*keys).agg(pick.alias("_row"))
            .select(*keys, *[F.col("_row")[c].alias(c) for c in others])
            .select(*df.columns))


def dedupe_by_key(df: DataFrame, key: str | Sequence[str] = "title_id",
                  order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per key; the survivor is the first by ``order_by``.

    Default order is all other columns, so the survivor is deterministic
    (the reference keeps an arbitrary one). ``order_by`` entries are
    ascending column names or expressions (negate a number for descending).
    One aggregate by key with map-side partial combine: copies of a hot key
    collapse inside each map task. NULL keys form one group.
    """
    return _survivors(df, [key] if isinstance(key, str) else list(key), order_by)


def backfill(df: DataFrame, *steps) -> DataFrame:
    """Run row-level steps over the whole table (``UPDATE t SET c = c``
    made the reference's triggers fire on existing rows)."""
    for step in steps:
        df = df.transform(step)
    return df
