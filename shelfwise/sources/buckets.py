"""Tables stored in hash buckets of a key, changed a few buckets at a time.

A bucket is a folder (``bucket=N``). A change is staged whole beside the table, a folder a version, and then takes
the place of the buckets it holds; the others are neither read nor written. A version counts by its ``_SUCCESS`` mark, so
staging and replacing can be repeated after a failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.sources.tables import path_exists

BUCKETS = 64


class BucketTable:
    def __init__(self, path: str, key: str = "title_id", buckets: int = BUCKETS):
        self.path, self.stage_path = path.rstrip("/"), f"{path.rstrip('/')}_epochs"
        self.key, self.buckets = key, buckets

    def filed(self, df: DataFrame) -> DataFrame:
        """``df`` with the bucket of each row."""
        return df.withColumn("bucket", F.pmod(F.xxhash64(self.key), F.lit(self.buckets).cast("long")).cast("int"))

    def touched(self, df: DataFrame) -> list[int]:
        """The buckets of ``df``, at most as many as the table has."""
        return sorted(r[0] for r in self.filed(df).select("bucket").distinct().collect())

    def replace(self, df: DataFrame) -> None:
        """Put the filed rows ``df`` in the place of the buckets they belong to."""
        (df.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket").parquet(self.path))

    def staged(self, spark: SparkSession, version: int) -> bool:
        return path_exists(spark, f"{self.stage_path}/epoch={version}/_SUCCESS")

    def stage(self, df: DataFrame, version: int) -> None:
        """Write filed rows, whole buckets, as a version that is not in the table yet."""
        df.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.stage_path}/epoch={version}")

    def version(self, spark: SparkSession, schema: T.StructType, version: int) -> DataFrame:
        return spark.read.schema(_with_bucket(schema)).parquet(f"{self.stage_path}/epoch={version}")

    def read(self, spark: SparkSession, schema: T.StructType, buckets: list[int] | None = None) -> DataFrame:
        """The filed rows of ``buckets`` (default: all); none where nothing is stored."""
        schema = _with_bucket(schema)
        if buckets == [] or not path_exists(spark, self.path):
            return spark.createDataFrame([], schema)
        df = spark.read.schema(schema).parquet(self.path)
        return df if buckets is None else df.filter(F.col("bucket").isin(buckets))


def _with_bucket(schema: T.StructType) -> T.StructType:
    if "bucket" in schema.names:
        return schema
    return T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
