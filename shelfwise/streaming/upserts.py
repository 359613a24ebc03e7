"""Micro-batch updates (the UPDATE half of T1-T3).

The reference's triggers also fire when a stored title changes: the changed row is filled and parsed again (T1), its
missing minutes are imputed from the whole table as it is then (T2), and a bad row rejects the statement (T3).
Here a micro-batch of changed and new rows is merged into the target by key:

* the target is stored in hash buckets of the key; only the buckets that a batch touches are read and written;
* the per-episode sums behind T2 are maintained, not recomputed: what replaced rows had put in is taken out,
  what their new versions have is put in, both as exact integers;
* an epoch's buckets are written whole beside the target, then its sums, then the buckets replace the target's. Each
  step counts by its ``_SUCCESS`` mark and reads only what the steps before it have left, so an epoch can be
  replayed from any point and gives the same table and sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise.operators import constraints
from shelfwise.sources.buckets import BUCKETS, BucketTable
from shelfwise.sources.tables import materialize, path_exists, shared_path
from shelfwise.streaming.incremental import _done, clean_stream, duration_sums, impute_from_sums, impute_from_table


def last_per_key(batch: DataFrame, key: str = "title_id", order_by: Sequence[str] = ()) -> DataFrame:
    """The last row of each key by ``order_by``, ties by the other columns; rows with a NULL key are all kept."""
    others = [c for c in batch.columns if c != key]
    order = F.struct(*order_by, *(c for c in others if c not in order_by))
    last = (batch.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*others), order).alias("_row"))
            .select(key, *(F.col("_row")[c].alias(c) for c in others)).select(*batch.columns))
    return last.unionByName(batch.filter(F.col(key).isNull()))


def merge_rows(stored: DataFrame, changed: DataFrame, key: str = "title_id") -> DataFrame:
    """Stored rows without those whose key ``changed`` has, and the changed rows (a NULL key replaces nothing)."""
    return stored.join(changed.select(key), key, "left_anti").select(*changed.columns).unionByName(changed)


class MergeWriter:
    """``foreachBatch`` sink: guard (T3), merge by key, impute (T2) from maintained sums.

    ``order_by`` decides between several rows of a key in one batch (the last wins). Sums are kept as one signed
    delta an epoch under ``<target>_duration_sums``; ``epoch=-1`` are the rows loaded before the stream."""

    def __init__(self, target_path: str, key: str = "title_id", order_by: Sequence[str] = (), guard: bool = True,
                 buckets: int = BUCKETS):
        self.table = BucketTable(target_path, key, buckets)
        self.sums_path = f"{self.table.path}_duration_sums"
        self.key, self.order_by, self.guard = key, tuple(order_by), guard

    def load(self, rows: DataFrame) -> None:
        """Store rows that are there before the stream, and their sums."""
        self.table.replace(self.table.filed(rows))
        duration_sums(rows).write.mode("overwrite").parquet(f"{self.sums_path}/epoch=-1")

    def _sums_before(self, spark: SparkSession, epoch_id: int) -> DataFrame:
        if not path_exists(spark, self.sums_path):
            return spark.createDataFrame([], "episodes int, s bigint, n bigint")
        return (spark.read.schema("episodes int, s bigint, n bigint, epoch int").parquet(self.sums_path)
                .filter(F.col("epoch") < epoch_id).drop("epoch"))

    def _merged(self, batch: DataFrame, epoch_id: int) -> DataFrame:
        spark = batch.sparkSession
        batch = materialize(batch, "merge-batch")
        if self.guard:                                   # T3: reject the whole batch
            constraints.validate(batch, strict=True)
        changed = last_per_key(batch, self.key, self.order_by)
        stored = self.table.read(spark, batch.schema, self.table.touched(changed)).select(*batch.columns)
        replaced = stored.join(changed.select(self.key), self.key, "left_semi").select(*batch.columns)
        sums = (self._sums_before(spark, epoch_id).unionByName(_negated(duration_sums(replaced)))
                .groupBy("episodes").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).filter("n > 0"))
        return merge_rows(stored, impute_from_sums(changed, sums), self.key)   # T2

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        spark, table = batch.sparkSession, self.table
        delta = f"{self.sums_path}/epoch={epoch_id}"
        if not table.staged(spark, epoch_id):
            table.stage(table.filed(self._merged(batch, epoch_id)), epoch_id)
        merged = table.version(spark, batch.schema, epoch_id)
        if not _done(spark, delta):                      # before the target changes
            stored = table.read(spark, batch.schema, table.touched(merged))
            change = duration_sums(merged).unionByName(_negated(duration_sums(stored)))
            (change.groupBy("episodes").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).filter("s <> 0 OR n <> 0")
             .write.mode("overwrite").parquet(delta))
        table.replace(merged)


def _negated(sums: DataFrame) -> DataFrame:
    return sums.select("episodes", (-F.col("s")).alias("s"), (-F.col("n")).alias("n"))


def start_updates(spark: SparkSession, source_dir: str, schema, target_path: str, checkpoint_location: str,
                  guard: bool = True, available_now: bool = True, order_by: Sequence[str] = (), buckets: int = BUCKETS) -> StreamingQuery:
    """Stream parquet files of changed and new rows arriving in ``source_dir`` into ``target_path``."""
    stream = spark.readStream.schema(schema).parquet(source_dir).transform(clean_stream)
    writer = stream.writeStream.foreachBatch(MergeWriter(target_path, guard=guard, order_by=order_by, buckets=buckets)).option(
        "checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def stream_update(stored_raw: DataFrame, arriving: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """T1-T3 for updates, end to end: the stored rows go through the triggers and are filed as the target; the
    arriving rows land as files and an available-now stream merges them; returns the target table."""
    spark = arriving.sparkSession
    work = shared_path(spark, "stream-update")
    MergeWriter(f"{work}/target", buckets=buckets).load(impute_from_table(clean_stream(stored_raw), None))
    arriving.write.parquet(f"{work}/source")
    q = start_updates(spark, f"{work}/source", arriving.schema, f"{work}/target", f"{work}/checkpoint", buckets=buckets)
    q.awaitTermination()   # until all arrived rows are through; a failed batch raises here
    return spark.read.parquet(f"{work}/target").drop("bucket")
