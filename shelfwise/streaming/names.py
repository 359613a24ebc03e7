"""Index of the stored names for insert-if-absent (T4).

Names are filed in hash buckets (folders), and each bucket has a Bloom filter, kept as its 64-bit words that are not
zero. A micro-batch first asks the filters; a name that misses one of its bits is not stored, and only the buckets
of the other names are opened. So what a batch reads follows the batch and the filters, whose size is fixed, not
the stored names. The answer is exact: a filter only spares a look-up, it never replaces one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.sources.tables import path_exists

#: Name buckets, 64-bit words of a bucket's filter, and bits a name sets.
BUCKETS, WORDS, HASHES = 64, 1 << 12, 4


class NameIndex:
    """Names stored under ``path``, an epoch at a time; ``epoch=-1`` are those stored before the stream.

    Each epoch adds a folder of its new names by bucket and writes the filters anew with their bits, so a batch
    reads one set of filters however many epochs there are. Folders count by their ``_SUCCESS`` mark; adding an epoch
    again writes the same."""

    def __init__(self, path: str, key: str = "title_name", buckets: int = BUCKETS, words: int = WORDS):
        self.names_path, self.filter_path = f"{path}/names", f"{path}/filter"
        self.key, self.buckets, self.words = key, buckets, words

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets).cast("long")).cast("int")

    def _bits(self, names: DataFrame) -> DataFrame:
        """(name, bucket, word, bit): the bits that each name sets."""
        n = F.lit(self.words * 64).cast("long")
        places = F.array(*(F.pmod(F.xxhash64(F.lit(i), F.col(self.key)), n) for i in range(HASHES)))
        place = F.col("_place")
        return (names.select(self.key, self._bucket().alias("bucket"), F.explode(places).alias("_place"))
                .select(self.key, "bucket", F.shiftright(place, 6).cast("int").alias("word"),
                        F.expr("shiftleft(1L, cast(_place & 63 AS int))").alias("bit")))

    def done(self, spark: SparkSession, epoch: int) -> bool:
        return path_exists(spark, f"{self.filter_path}/epoch={epoch}/_SUCCESS")

    def add(self, names: DataFrame, epoch: int) -> None:
        """File the (new) names of an epoch; NULL names are none."""
        spark = names.sparkSession
        names = names.select(self.key).filter(F.col(self.key).isNotNull()).distinct()
        where = f"{self.names_path}/epoch={epoch}"
        names.withColumn("bucket", self._bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(where)
        bits = self._bits(names).groupBy("bucket", "word").agg(F.bit_or("bit").alias("bits"))
        before = self._filter(spark, epoch)
        if before is not None:
            bits = bits.unionByName(before).groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
        bits.coalesce(1).write.mode("overwrite").parquet(f"{self.filter_path}/epoch={epoch}")   # bounded: buckets x words

    def _filter(self, spark: SparkSession, before: int) -> DataFrame | None:
        """The filters as of the last epoch before ``before``."""
        last = next((e for e in range(before - 1, -2, -1) if self.done(spark, e)), None)
        return None if last is None else spark.read.parquet(f"{self.filter_path}/epoch={last}")

    def touched(self, names: DataFrame, epoch: int) -> list[int]:
        """Buckets that may hold a name of ``names`` from before ``epoch``; at most one entry a bucket."""
        bits = self._filter(names.sparkSession, epoch)
        if bits is None:
            return []
        asked = self._bits(names.filter(F.col(self.key).isNotNull()).select(self.key).distinct())
        hit = F.coalesce(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.lit(False))
        maybe = (asked.join(bits, ["bucket", "word"], "left").groupBy(self.key, "bucket")
                 .agg(F.min(hit).alias("maybe")).filter("maybe"))
        return sorted(r[0] for r in maybe.select("bucket").distinct().collect())

    def stored(self, names: DataFrame, epoch: int) -> DataFrame:
        """The stored names of the buckets that ``names`` may meet, as of before ``epoch``."""
        spark = names.sparkSession
        buckets = self.touched(names, epoch)
        schema = f"{self.key} string, epoch int, bucket int"
        if not buckets:
            return spark.createDataFrame([], schema).select(self.key)
        filed = spark.read.schema(schema).parquet(self.names_path)
        return filed.filter(F.col("bucket").isin(buckets) & (F.col("epoch") < epoch)).select(self.key)
