"""Insert-if-absent ingestion.

The reference asks ``SELECT COUNT(*) … WHERE name = ?`` per crawled record
and inserts only when the count is 0, so the first record with a name wins
and a NULL name (``= NULL`` is never true) always inserts. Here a whole batch
is handled at once: first-wins inside the batch is an aggregate (a hot name
collapses map-side), the existence test one ``left_anti`` join on the distinct
stored names; the survivors are appended in one bulk write.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.clean import dedupe_by_key
from shelfwise.sources.tables import materialize, path_exists


def count_matches(target: DataFrame, names: DataFrame, key: str = "title_name") -> DataFrame:
    """A4 for a batch: per arriving name, how many stored rows carry it
    (0 when none). NULL names count 0, as ``= NULL`` matches nothing. One
    aggregate of the stored names (partly combined before its shuffle) and one join."""
    per_name = target.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_stored"))
    return (names.select(key).distinct().join(per_name, key, "left")
            .withColumn("n_stored", F.coalesce(F.col("n_stored"), F.lit(0)).cast("bigint")))


def _collated(key: str, collation: str | None):
    return F.collate(F.col(key), collation) if collation else F.col(key)


def first_per_key(batch: DataFrame, key: str = "title_name", order_by: Sequence[str] = ("title_id",),
                  collation: str | None = None) -> DataFrame:
    """In-batch first-wins by ``order_by`` (arrival order), ties by the other
    columns; names compare under ``collation``; NULL keys all kept."""
    order = [*order_by, *[c for c in batch.columns if c not in order_by]]
    named = batch.filter(F.col(key).isNotNull()).withColumn("_name", _collated(key, collation))
    unnamed = batch.filter(F.col(key).isNull())
    return dedupe_by_key(named, "_name", order).select(*batch.columns).unionByName(unnamed)


def insert_if_absent(batch: DataFrame, target: DataFrame, key: str = "title_name",
                     order_by: Sequence[str] = ("title_id",), collation: str | None = None) -> DataFrame:
    """Rows of ``batch`` to insert - first per name, and only names not
    yet stored. ``collation`` (e.g. ``'utf8_lcase'``) sets how names compare,
    inside the batch and with the stored ones; by default the comparison is
    binary. A plain anti join: adaptive execution picks its form from the
    measured sizes."""
    name = _collated(key, collation)
    stored = target.filter(F.col(key).isNotNull()).select(name.alias("_k")).distinct()
    firsts = first_per_key(batch, key, order_by, collation).withColumn("_k", name)
    return firsts.join(stored, "_k", "left_anti").select(*batch.columns)


def append_new(batch: DataFrame, target_path: str, key: str = "title_name",
               order_by: Sequence[str] = ("title_id",), fmt: str = "parquet") -> DataFrame:
    """S4 as a job: compute the new rows against the stored table and append
    them (bulk). Returns the new rows."""
    spark = batch.sparkSession
    # only a missing path means that nothing is stored yet; a failed read is an error
    target = spark.read.format(fmt).load(target_path) if path_exists(spark, target_path) else batch.limit(0)
    # computed once (and before the append), so the returned rows are exactly
    # the appended ones
    new = materialize(insert_if_absent(batch, target, key, order_by), "append-new")
    new.write.mode("append").format(fmt).save(target_path)
    return new
