"""The star kept up to date load by load (N3, N4, N7-N9 on changes).

``write_star`` numbers and writes everything anew. Here a load brings the cleaned rows of new and changed titles:

* dimension values and statistics keep their ids; unseen values get new ones (``IdMap``);
* title and statistic rows of the load replace those of the same title, in the hash buckets they touch;
* the bridge rows of a title are replaced only where its list of genres or studios has changed; kept rows keep
  their bridge ids, new rows get ids above all given before.

After loading A and then B the star equals that of A with B over it, up to ids. A load writes its steps under its
number and can be repeated after a failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators import normalize as N
from shelfwise.operators.idmap import IdMap
from shelfwise.operators.keys import dense_ids
from shelfwise.plans import star as S
from shelfwise.sources.buckets import BUCKETS, BucketTable
from shelfwise.sources.tables import path_exists

_VALUES = T.StructType([T.StructField("dim", T.StringType()), T.StructField("value", T.StringType())])
_BRIDGES = "dim string, bridge_id long, title_id long, pos int, ref_id long"


def _schema(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)


class StarStore:
    """Star tables under ``path``: id maps of the dimension values and the statistics, and the title, statistic and
    bridge tables in buckets of ``title_id``."""

    def __init__(self, path: str, buckets: int = BUCKETS):
        self.path = path.rstrip("/")
        self.values = IdMap(f"{self.path}/dimension_ids", ["value"], ["dim"])
        self.statistics = IdMap(f"{self.path}/statistic_ids", ["title_id"], id_col="statistic_id")
        self.titles, self.stats, self.bridges = (BucketTable(f"{self.path}/{n}", "title_id", buckets)
                                                 for n in ("title", "statistic", "title_list"))

    def apply(self, clean: DataFrame, load: int) -> None:
        """Merge the cleaned rows ``clean`` (one a title) as load ``load``; loads are numbered upwards."""
        spark = clean.sparkSession
        batch = self._stored_batch(clean, load)
        dims = S.split_dimensions(self.values.extend(S._tagged_values(batch), load))
        ids = self.statistics.extend(batch.select(F.col("title_id").cast("long").alias("title_id")), load)
        stats = (batch.select("title_id", *N.STAT_COLS).join(ids, "title_id")
                 .select("statistic_id", *N.STAT_COLS, "title_id"))
        title = batch.select(*N.CORE_COLS, *[n for n, _ in S.DIMENSIONS])
        for name, id_col in S.DIMENSIONS:
            title = N.attach_dimension_key(title, dims[name], name, id_col)
        title = title.join(ids, "title_id").select(*N.CORE_COLS, "statistic_id", "premiered_id", "rating_id", "media_type_id")
        for table, rows in ((self.titles, title), (self.stats, stats)):
            if not table.staged(spark, load):
                kept = table.read(spark, rows.schema, table.touched(rows)).join(rows.select("title_id"), "title_id", "left_anti")
                table.stage(kept.select(*rows.columns, "bucket").unionByName(table.filed(rows)), load)
        if not self.bridges.staged(spark, load):
            self._stage_bridges(batch, dims, load)
        (self.bridges.version(spark, _schema(_BRIDGES), load).groupBy("dim").agg(F.max("bridge_id").alias("top"))
         .write.mode("overwrite").parquet(f"{self.path}/bridge_tops/load={load}"))
        for table, schema in ((self.titles, title.schema), (self.stats, stats.schema), (self.bridges, _schema(_BRIDGES))):
            table.replace(table.version(spark, schema, load))

    def _stored_batch(self, clean: DataFrame, load: int) -> DataFrame:
        """The load's rows as first stored, so that a repeated load sees the same."""
        spark, path = clean.sparkSession, f"{self.path}/loads/load={load}"
        if not path_exists(spark, f"{path}/_SUCCESS"):
            clean.write.mode("overwrite").parquet(path)
        return spark.read.schema(clean.schema).parquet(path)

    def _lists(self, batch: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
        parts = []
        for dim, col in S.LIST_DIMS:
            d = dims[dim].select(F.col(f"{dim}_id").alias("ref_id"), F.col(f"{dim}_name").alias("value"))
            parts.append(N.split_values(batch, col).join(d, "value")
                         .select(F.lit(dim).alias("dim"), F.col("title_id").cast("long").alias("title_id"), "pos", "ref_id"))
        return parts[0].unionByName(parts[1])

    def _stage_bridges(self, batch: DataFrame, dims: dict[str, DataFrame], load: int) -> None:
        spark, table = batch.sparkSession, self.bridges
        old = table.read(spark, _schema(_BRIDGES), table.touched(batch.select("title_id")))
        new = self._lists(batch, dims)
        listed = F.array_sort(F.collect_list(F.struct("pos", "ref_id")))   # bounded by one title's list
        before = old.groupBy("dim", "title_id").agg(listed.alias("_old"))
        after = new.groupBy("dim", "title_id").agg(listed.alias("_new"))
        wanted = batch.select(F.col("title_id").cast("long").alias("title_id"),
                              F.explode(F.array(*(F.lit(d) for d, _ in S.LIST_DIMS))).alias("dim"))
        both = wanted.join(before, ["dim", "title_id"], "left").join(after, ["dim", "title_id"], "left")
        changed = both.filter(~F.col("_old").eqNullSafe(F.col("_new"))).select("dim", "title_id")
        kept = old.join(changed, ["dim", "title_id"], "left_anti").select("dim", "bridge_id", "title_id", "pos", "ref_id", "bucket")
        added = dense_ids(new.join(changed, ["dim", "title_id"], "left_semi"), ["title_id", "pos"], "bridge_id", group_cols=["dim"])
        moved = F.col("bridge_id")
        for dim, top in self._tops(spark, load).items():
            moved = F.when(F.col("dim") == dim, F.col("bridge_id") + F.lit(top).cast("long")).otherwise(moved)
        table.stage(kept.unionByName(table.filed(added.withColumn("bridge_id", moved)).select(*kept.columns)), load)

    def _tops(self, spark: SparkSession, load: int) -> dict[str, int]:
        """Highest bridge id given before ``load`` in each list dimension."""
        path = f"{self.path}/bridge_tops"
        if not path_exists(spark, path):
            return {}
        tops = spark.read.schema("dim string, top long, load int").parquet(path).filter(F.col("load") < load)
        return {r[0]: r[1] for r in tops.groupBy("dim").agg(F.max("top")).collect()}

    def star(self, spark: SparkSession) -> dict[str, DataFrame]:
        """The nine logical tables, as ``read_star`` gives them."""
        bridges = self.bridges.read(spark, _schema(_BRIDGES)).drop("bucket", "pos")
        return {**S.split_dimensions(self.values.read(spark, _VALUES)),
                "statistic": spark.read.parquet(self.stats.path).drop("bucket"),
                "title": spark.read.parquet(self.titles.path).drop("bucket"), **S.split_bridges(bridges)}
