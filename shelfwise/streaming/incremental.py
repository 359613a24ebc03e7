"""Micro-batch ingestion (T1-T4) with Structured Streaming.

The reference reacts to each insert with AFTER INSERT/UPDATE triggers:
sentinel fills (T1: premiered, studio, episodes), duration parsing with
imputation from the whole table (T2), and a guard that rejects the whole
statement on a bad row (T3); the second crawler inserts a record only when its
name is not stored yet (T4). Blank-row removal, trimming, rating collapse and
de-duplication are procedures run by hand, not triggers, so they are not
part of this path (the batch job ``plans.cleaning.clean_titles`` runs them).
Here:

* T1 and the parse half of T2 are the stateless part of the stream
  (``clean_stream``) - the same column functions as the batch job.
* ``foreachBatch`` (``BatchWriter``): validate the micro-batch before anything
  is written (T3; an exception fails the batch and the query, nothing is
  appended), keep the first row per new name (T4), impute missing minutes
  from stored ∪ inserted rows (T2), append in one write.

Re-running a micro-batch after a failure writes nothing twice (see ``BatchWriter``). The per-episode
sums for T2 are kept as small per-batch deltas next to the target, so the stored minutes are not rescanned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise.functions.numeric import mean_from_sums, scaled_sum
from shelfwise.operators import clean, constraints, ingest
from shelfwise.sources.tables import materialize, path_exists, shared_path
from shelfwise.streaming.names import NameIndex


def clean_stream(df: DataFrame) -> DataFrame:
    """T1 + the row-level half of T2: sentinel fills and duration parsing,
    usable on a streaming or a batch frame."""
    return df.transform(clean.fill_missing).transform(clean.parse_duration)


def impute_from_table(batch: DataFrame, stored: DataFrame | None, col: str = "duration_min",
                      by: str = "episodes") -> DataFrame:
    """NULL minutes → round(mean of minutes with equal episodes over the
    stored table and the inserted rows, 2) - exact, see ``avg_by_key``."""
    parts = [batch.select(by, col)]
    if stored is not None:
        parts.append(stored.select(by, col))
    pool = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    peers = clean.avg_by_key(pool, col, by, "_peer")
    return (batch.join(peers, by, "left")
            .withColumn(col, F.coalesce(F.col(col), F.col("_peer")))
            .drop("_peer").select(*batch.columns))


def _done(spark: SparkSession, path: str) -> bool:
    """Whether the write of ``path`` was finished (a folder alone may be half-written)."""
    return path_exists(spark, f"{path}/_SUCCESS")


def duration_sums(df: DataFrame, col: str = "duration_min", by: str = "episodes") -> DataFrame:
    """(episodes, s, n): exact integer sum of minutes (in hundredths) and count
    per episode count, over rows with both known."""
    return (df.filter(F.col(col).isNotNull() & F.col(by).isNotNull())
            .groupBy(by).agg(scaled_sum(col).alias("s"), F.count(F.lit(1)).alias("n")))


def impute_from_sums(batch: DataFrame, sums: DataFrame | None, col: str = "duration_min",
                     by: str = "episodes") -> DataFrame:
    """T2 with the stored table summarised as (episodes, s, n): NULL minutes →
    exact round(mean, 2) over the stored sums plus the batch's own values."""
    pool = duration_sums(batch, col, by)
    if sums is not None:
        pool = pool.unionByName(sums.select(by, "s", "n"))
    means = (pool.groupBy(by).agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
             .select(by, mean_from_sums(F.col("s"), F.col("n")).alias("_peer")))
    return (batch.join(means, by, "left")
            .withColumn(col, F.coalesce(F.col(col), F.col("_peer")))
            .drop("_peer").select(*batch.columns))


class BatchWriter:
    """``foreachBatch`` sink: guard (T3) → insert-if-absent (T4) → impute.

    An epoch's new rows are first written whole to ``<target>_epochs/epoch=N``, then its per-episode sums to
    ``<target>_duration_sums/epoch=N`` (``epoch=-1``: rows stored before the stream), then its files move into the
    target under their own names. Each step counts as done by its ``_SUCCESS`` mark only, so a replayed epoch
    redoes what was left half-written and moves what was not moved yet: it writes nothing twice, rows with a
    NULL name included. The sums spare a rescan of the stored minutes; the existence test (T4) opens only those
    buckets of the name index (``<target>_names``) that may hold a name of the micro-batch."""

    def __init__(self, target_path: str, key: str = "title_name", order_by: tuple[str, ...] = ("title_id",),
                 guard: bool = True, sums_path: str | None = None):
        self.target_path = target_path.rstrip("/")
        self.epochs_path = f"{self.target_path}_epochs"
        self.sums_path = sums_path or f"{self.target_path}_duration_sums"
        self.key = key
        self.order_by = order_by
        self.guard = guard
        self.names = NameIndex(f"{self.target_path}_names", key)

    def _stored(self, spark: SparkSession) -> DataFrame | None:
        return spark.read.parquet(self.target_path) if path_exists(spark, self.target_path) else None

    def _sums_before(self, spark: SparkSession, stored: DataFrame | None, epoch_id: int) -> DataFrame:
        base = f"{self.sums_path}/epoch=-1"
        if not _done(spark, base):   # once, at the first batch
            sums = (spark.createDataFrame([], "episodes int, s bigint, n bigint") if stored is None
                    else duration_sums(stored))
            sums.write.mode("overwrite").parquet(base)
        return spark.read.parquet(self.sums_path).filter(F.col("epoch") < epoch_id).drop("epoch")

    def _new_rows(self, batch: DataFrame, epoch_id: int) -> DataFrame:
        spark = batch.sparkSession
        batch = materialize(batch, "ingest-batch")       # guard, first-wins and imputation read it once computed
        if self.guard:                                   # T3: reject the whole batch
            constraints.validate(batch, strict=True)
        stored = self._stored(spark)
        if not self.names.done(spark, -1):               # once, at the first batch
            self.names.add(batch.limit(0) if stored is None else stored, -1)
        new = ingest.insert_if_absent(batch, self.names.stored(batch, epoch_id), self.key, self.order_by)   # T4
        return impute_from_sums(new, self._sums_before(spark, stored, epoch_id))   # T2

    def _publish(self, spark: SparkSession, epoch: str) -> None:
        jvm = spark.sparkContext._jvm
        source, target = jvm.org.apache.hadoop.fs.Path(epoch), jvm.org.apache.hadoop.fs.Path(self.target_path)
        fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(target)
        for f in fs.listStatus(source):
            name = f.getPath().getName()
            if name.startswith("part-") and not fs.rename(f.getPath(), jvm.org.apache.hadoop.fs.Path(target, name)):
                raise OSError(f"{name} of {epoch} could not be moved to {self.target_path}")

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        epoch, delta = f"{self.epochs_path}/epoch={epoch_id}", f"{self.sums_path}/epoch={epoch_id}"
        if not _done(spark, epoch):
            self._new_rows(batch, epoch_id).write.mode("overwrite").parquet(epoch)
        if not _done(spark, delta):                      # before any file has moved
            duration_sums(spark.read.schema(batch.schema).parquet(epoch)).write.mode("overwrite").parquet(delta)
        if not self.names.done(spark, epoch_id):
            self.names.add(spark.read.schema(batch.schema).parquet(epoch), epoch_id)
        self._publish(spark, epoch)


def start_incremental(spark: SparkSession, source_dir: str, schema, target_path: str,
                      checkpoint_location: str, guard: bool = True, available_now: bool = True) -> StreamingQuery:
    """Stream parquet files arriving in ``source_dir`` into ``target_path``."""
    stream = spark.readStream.schema(schema).parquet(source_dir).transform(clean_stream)
    writer = stream.writeStream.foreachBatch(BatchWriter(target_path, guard=guard)).option(
        "checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def stream_clean(arriving: DataFrame) -> DataFrame:
    """T1 end to end: the arriving rows land as parquet files, an
    available-now stream cleans them into a parquet sink; returns the sink."""
    spark = arriving.sparkSession
    work = shared_path(spark, "stream-clean")
    arriving.write.parquet(f"{work}/source")
    q = (spark.readStream.schema(arriving.schema).parquet(f"{work}/source").transform(clean_stream)
         .writeStream.format("parquet").option("path", f"{work}/sink")
         .option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()   # until all arrived rows are through; a failed batch raises here
    return spark.read.parquet(f"{work}/sink")


def stream_ingest(stored_raw: DataFrame, arriving: DataFrame) -> DataFrame:
    """T1-T4 end to end: the stored rows go through the triggers (fills,
    parse, impute) and are written as the target; the arriving rows land as
    files and an available-now stream runs them through fills + parse →
    guard → insert-if-absent → impute; returns the target table afterwards."""
    spark = arriving.sparkSession
    work = shared_path(spark, "stream-ingest")
    impute_from_table(clean_stream(stored_raw), None).write.parquet(f"{work}/target")
    arriving.write.parquet(f"{work}/source")
    q = start_incremental(spark, f"{work}/source", arriving.schema, f"{work}/target", f"{work}/checkpoint")
    q.awaitTermination()   # until all arrived rows are through; a failed batch raises here
    return spark.read.parquet(f"{work}/target")
