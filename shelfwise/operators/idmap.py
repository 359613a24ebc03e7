"""Persistent value-to-id maps: identities that later loads do not change.

``dense_ids`` ranks the values of one load. A map keeps what it has numbered: a load gives ids only to values that
have none, above the highest id of their group and in the order of the values, so ids stay dense, and old ones
stay as they are when new values sort before them or old values disappear.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.keys import dense_ids
from shelfwise.sources.tables import path_exists


class IdMap:
    """Map stored under ``path``, a folder of new ids a load. ``group``: columns within which ids count from 1;
    ``order``: the columns that are numbered. Keys with a NULL group get no id. A load counts by its ``_SUCCESS`` mark and can be repeated."""

    def __init__(self, path: str, order: Sequence[str], group: Sequence[str] = (), id_col: str = "id"):
        self.path, self.order, self.group, self.id_col = path.rstrip("/"), list(order), list(group), id_col

    def read(self, spark: SparkSession, schema: T.StructType, before: int | None = None) -> DataFrame:
        """All ids given (in loads before ``before``); ``schema`` names and types the key columns."""
        keys = [schema[c] for c in (*self.group, *self.order)]
        fields = [*keys, T.StructField(self.id_col, T.LongType()), T.StructField("load", T.IntegerType())]
        if not path_exists(spark, self.path):
            return spark.createDataFrame([], T.StructType(fields)).drop("load")
        df = spark.read.schema(T.StructType(fields)).parquet(self.path)
        return (df if before is None else df.filter(F.col("load") < before)).drop("load")

    def extend(self, values: DataFrame, load: int) -> DataFrame:
        """Give ids to those keys of ``values`` that have none, as load ``load``; returns the whole map."""
        spark, schema = values.sparkSession, values.schema
        where = f"{self.path}/load={load}"
        if not path_exists(spark, f"{where}/_SUCCESS"):
            known = self.read(spark, schema, load)
            keys = [*self.group, *self.order]
            mine = known.select(*(F.col(c).alias(f"_k_{c}") for c in keys))
            same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys])
            new = values.select(*keys).distinct().join(mine, same, "left_anti")
            self._above(dense_ids(new, self.order, self.id_col, group_cols=self.group), known).write.mode("overwrite").parquet(where)
        return self.read(spark, schema, load + 1)

    def _above(self, ranked: DataFrame, known: DataFrame) -> DataFrame:
        """Ranks moved above the highest id of their group."""
        if not self.group:
            top = known.agg(F.max(self.id_col)).first()[0] or 0
            return ranked.withColumn(self.id_col, F.col(self.id_col) + F.lit(top).cast("long"))
        top = known.groupBy(*(F.col(c).alias(f"_g_{c}") for c in self.group)).agg(F.max(self.id_col).alias("_top"))
        same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in self.group])
        moved = F.col(self.id_col) + F.coalesce("_top", F.lit(0).cast("long"))
        return ranked.join(top, same, "left").withColumn(self.id_col, moved).drop("_top", *(f"_g_{c}" for c in self.group))
