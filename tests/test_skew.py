"""Hot keys: one value holds a third or more of all rows. Results stay whole
and equal to a direct computation."""

from pyspark.sql import functions as F

from shelfwise.operators import clean, ingest
from shelfwise.operators.keys import dense_ids
from shelfwise.plans import star as S

from conftest import rows


def _hot(spark, n=9000):
    # episodes = 12 for every row with id % 3 == 0 (a third), else spread out
    return spark.range(0, n).select(
        F.col("id").alias("title_id"),
        F.when(F.col("id") % 3 == 0, F.lit(12)).otherwise((F.col("id") % 500).cast("int")).alias("episodes"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise((F.col("id") % 60).cast("double")).alias("duration_min"))


def test_impute_hot_key(spark):
    df = _hot(spark)
    out = clean.impute_duration(df)
    assert out.count() == df.count()
    from decimal import ROUND_HALF_UP, Decimal
    vals = [Decimal(str(r[0])) for r in df.filter("episodes = 12 AND duration_min IS NOT NULL")
            .select("duration_min").collect()]
    expect = float((sum(vals) / len(vals)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
    got = {r[0] for r in out.filter("episodes = 12 AND title_id % 7 = 0").select("duration_min").distinct().collect()}
    assert got == {expect}


def test_insert_if_absent_hot_name(spark):
    batch = spark.range(0, 9000).select(
        F.col("id").alias("title_id"),
        F.when(F.col("id") % 2 == 0, F.lit("Same")).otherwise(F.concat(F.lit("t"), F.col("id").cast("string")))
        .alias("title_name"))
    stored = spark.createDataFrame([(10**9, "t1")], "title_id long, title_name string")
    new = ingest.insert_if_absent(batch, stored)
    assert new.count() == 1 + (4500 - 1)           # one 'Same' survivor + odd names except 't1'
    assert rows(new.filter("title_name = 'Same'"), "title_id") == [(0,)]


def test_dense_ids_hot_group(spark):
    df = spark.range(0, 20000).select(F.col("id").alias("k"),
                                      F.when(F.col("id") % 10 < 8, F.lit("big")).otherwise(F.lit("small")).alias("g"))
    out = dense_ids(df, ["k"], "id", group_cols=["g"])
    got = dict(rows(out.groupBy("g").agg(F.max("id")), "g", "max(id)"))
    assert got == {"big": 16000, "small": 4000}


def test_collapse_hot_group(spark):
    # many titles share the same ten keys: one collapsed row, genres listed once each
    n = 3000
    one = F.least(F.col("id"), F.lit(1)).cast("long")   # 1 for every row, but a data column (not folded)
    star = {
        "title": spark.range(1, n + 1).select(
            F.col("id").alias("title_id"), F.lit("Same").alias("title_name"), F.lit(24.0).alias("duration_min"),
            F.lit("s").alias("synopsis"), F.lit(12).alias("episodes"), F.lit("Done").alias("status"),
            one.alias("statistic_id"), one.alias("premiered_id"), one.alias("rating_id"),
            one.alias("media_type_id")),
        "statistic": spark.createDataFrame([(1, 5, 1, 1.0, 3, 10, 1)], "statistic_id long, ranking int, "
                                           "favorites int, score double, popularity int, members int, title_id long"),
        "premiered": spark.createDataFrame([(1, "Fall 1990")], "premiered_id long, premiered string"),
        "rating": spark.createDataFrame([(1, "PG")], "rating_id long, rating string"),
        "media_type": spark.createDataFrame([(1, "TV")], "media_type_id long, media_type string"),
        "genre": spark.createDataFrame([(1, "a"), (2, "b")], "genre_id long, genre_name string"),
        "studio": spark.createDataFrame([(1, "x")], "studio_id long, studio_name string"),
        "title_genre": spark.range(1, n + 1).select((F.col("id") * 2).alias("title_genre_id"), F.col("id").alias("title_id"),
                                                    (F.col("id") % 2 + 1).alias("genre_id")),
        "title_studio": spark.range(1, n + 1).select(F.col("id").alias("title_studio_id"), F.col("id").alias("title_id"),
                                                     one.alias("studio_id")),
    }
    out = rows(S.star_titles(star), "genre_names", "studio_names")
    assert out == [("b, a", "x")]   # title 1 (genre 2 = 'b') comes first by bridge id
