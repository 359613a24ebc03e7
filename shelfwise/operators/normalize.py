"""Wide → star normalisation (N1-N10, joins J2-J4).

Dimension ids are dense 1-based ranks by natural value (the reference's
IDENTITY order is unspecified); bridge ids rank by (title, position in the
list). Dimension lookups are plain equi-joins: AQE turns them into broadcast
hash joins from the measured size of the dimension side, and splits a hot
value on the big side (skew join) when the dimension is too large to
broadcast - nothing is broadcast on an unchecked guess.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.keys import dense_ids

CORE_COLS = ("title_id", "title_name", "duration_min", "synopsis", "episodes", "status")
STAT_COLS = ("ranking", "favorites", "score", "popularity", "members")


def project_core(clean: DataFrame) -> DataFrame:
    """The title table's own columns."""
    return clean.select(*CORE_COLS)


def project_stats(clean: DataFrame, key: str = "title_id", id_col: str = "statistic_id") -> DataFrame:
    """One statistic row per input row with a dense id; the row keeps the
    title key (D2) so the title ⇄ statistic link is exact."""
    return dense_ids(clean.select(key, *STAT_COLS), [key], id_col).select(id_col, key, *STAT_COLS)


def distinct_dimension(clean: DataFrame, col: str, id_col: str) -> DataFrame:
    """N3 + N4: distinct non-NULL values of ``col`` with a dense id."""
    values = clean.select(col).where(F.col(col).isNotNull()).distinct()
    return dense_ids(values, [col], id_col).select(id_col, col)


def attach_dimension_key(titles: DataFrame, dim: DataFrame, col: str, id_col: str) -> DataFrame:
    """Replace the raw value ``col`` by its dimension id (left join: a
    NULL value gets a NULL key)."""
    return titles.join(dim, on=col, how="left").drop(col)


def attach_stats_key(titles: DataFrame, stats: DataFrame, id_col: str = "statistic_id",
                     null_safe: bool = False) -> DataFrame:
    """N6 with the reference rule: link by equality of the five measures.

    NULL never equals NULL (``null_safe=False``), so such titles get no key;
    equal measure tuples are ambiguous and take the smallest id. The stats are
    reduced to one id per tuple *before* the join, so a popular tuple never
    multiplies rows.
    """
    per_tuple = stats.groupBy(*STAT_COLS).agg(F.min(id_col).alias(id_col))
    if null_safe:
        cond = [titles[c].eqNullSafe(per_tuple[c]) for c in STAT_COLS]
    else:
        cond = [titles[c] == per_tuple[c] for c in STAT_COLS]
    joined = titles.join(per_tuple, on=cond, how="left")
    return joined.select(*[titles[c] for c in titles.columns], per_tuple[id_col])


def split_values(clean: DataFrame, col: str, key: str = "title_id") -> DataFrame:
    """J4 (CROSS APPLY STRING_SPLIT): (key, pos, value) per list element,
    trimmed. NULL → no rows; '' → one '' row; 'a,' → 'a' and ''."""
    return (clean.select(key, F.posexplode(F.split(F.col(col), ",")).alias("pos", "value"))
            .withColumn("value", F.trim(F.col("value"))))


def split_distinct(clean: DataFrame, col: str, name_col: str, id_col: str) -> DataFrame:
    """Distinct trimmed list elements with a dense id (genres, studios)."""
    names = split_values(clean, col).select(F.col("value").alias(name_col)).distinct()
    return dense_ids(names, [name_col], id_col).select(id_col, name_col)


def bridge(clean: DataFrame, col: str, dim: DataFrame, name_col: str, id_col: str,
           bridge_id: str, key: str = "title_id") -> DataFrame:
    """One (title, dimension) row per list element (not de-duplicated,
    as the reference inserts them), with a dense bridge id by (title, pos)."""
    rows = (split_values(clean, col, key)
            .join(dim, F.col("value") == dim[name_col], "inner")
            .select(key, "pos", id_col))
    return dense_ids(rows, [key, "pos"], bridge_id).select(bridge_id, key, id_col)


def bridge_genres(clean: DataFrame, genres: DataFrame) -> DataFrame:
    """Title × genre bridge."""
    return bridge(clean, "genres", genres, "genre_name", "genre_id", "title_genre_id")


def bridge_studios(clean: DataFrame, studios: DataFrame) -> DataFrame:
    """Title × studio bridge."""
    return bridge(clean, "studio", studios, "studio_name", "studio_id", "title_studio_id")


def add_column(df: DataFrame, name: str, data_type: str) -> DataFrame:
    """``ALTER TABLE ADD name type`` (all NULL until filled)."""
    return df.withColumn(name, F.lit(None).cast(data_type))


__all__: Sequence[str] = [
    "project_core", "project_stats", "distinct_dimension", "attach_dimension_key",
    "attach_stats_key", "split_values", "split_distinct", "bridge", "bridge_genres",
    "bridge_studios", "add_column",
]
