import pytest
from pyspark.sql import functions as F

from shelfwise.functions import parse
from shelfwise.operators import clean
from shelfwise.operators.normalize import split_values
from shelfwise.plans.cleaning import clean_titles
from shelfwise.sources import fixtures as fx

from conftest import SF_SMALL, rows


def test_duration_shapes(spark):
    data = [("1 hr. 55 min.", 115.0), ("24 min. per ep.", 24.0), ("5 min.", 5.0), ("2 hr.", 120.0),
            ("30 sec. per ep.", 0.5), ("Unknown", None), (None, None), ("x min.", None),
            ("1 hr. 12 min. per ep.", 72.0), ("45 sec.", 0.75)]
    df = spark.createDataFrame(data, "duration string, expected double")
    got = rows(df.select("expected", parse.duration_minutes("duration").alias("m")))
    for exp, m in got:
        assert exp == m


def test_duration_strict_raises(spark):
    df = spark.createDataFrame([(1, "x min.")], "title_id long, duration string")
    with pytest.raises(ValueError):
        clean.parse_duration(df, strict=True)
    assert rows(clean.parse_duration(df), "duration_min") == [(None,)]


def test_rating_collapse(spark):
    raw = ["G - All Ages", "PG - Children", "PG-13 - Teens 13 or older", "R - 17+ (violence & profanity)",
           "R+ - Mild", "Rx - Other", "None", "N/A", None]
    want = ["G", "PG", "PG-13", "R-17+", "R+", "R-17+", "None", "N/A", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, rating string")
    got = [r[1] for r in sorted(rows(clean.collapse_rating(df)))]
    assert got == want


def test_numbers(spark):
    df = spark.createDataFrame([("1,234",), ("Unknown",), ("8.5",), ("N/A",), (".5",), ("8.",), (None,), ("1.2.3",)],
                               "v string")
    got = rows(df.select("v", parse.int_with_commas("v"), parse.float_guarded("v"), parse.int_digits("v")))
    by = {r[0]: r[1:] for r in got}
    assert by["1,234"][0] == 1234 and by["1,234"][2] is None
    assert by["Unknown"] == (None, None, None)
    assert by["8.5"][1] == 8.5 and by[".5"][1] == 0.5 and by["8."][1] == 8.0
    assert by["N/A"][1] is None and by["1.2.3"][1] is None
    assert by[None] == (None, None, None)


def test_split_semantics(spark):
    df = spark.createDataFrame([(1, "a, b"), (2, "a,,b"), (3, ""), (4, None), (5, "a,")], "title_id long, g string")
    got = rows(split_values(df, "g"), "title_id", "value")
    per = {}
    for k, v in got:
        per.setdefault(k, []).append(v)
    assert per[1] == ["a", "b"] and per[2] == ["a", "", "b"] and per[3] == [""] and 4 not in per
    assert per[5] == ["a", ""]


def test_fill_and_blank(spark):
    df = spark.createDataFrame(
        [(1, "x", None, "None found, add some", None), (2, "   ", "?", None, 3), (3, None, "Fall 1990", " S ", 2)],
        "title_id long, title_name string, premiered string, studio string, episodes int")
    out = df.transform(clean.drop_blank_rows).transform(clean.trim_column).transform(clean.fill_missing)
    assert rows(out) == [(1, "x", "N/A", "N/A", 1)]
    kept = df.filter("title_id = 3").transform(clean.trim_column).transform(clean.fill_missing)
    assert rows(kept, "studio", "premiered") == [("S", "Fall 1990")]


def test_impute_peers(spark):
    df = spark.createDataFrame(
        [(1, 12, 24.0), (2, 12, 25.0), (3, 12, None), (4, 13, None), (5, None, None), (6, None, 10.0)],
        "title_id long, episodes int, duration_min double")
    got = dict(rows(clean.impute_duration(df), "title_id", "duration_min"))
    assert got[3] == 24.5          # mean of peers with equal episodes
    assert got[4] is None          # no peer with known minutes
    assert got[5] is None          # NULL episodes never match (SQL '=')
    assert got[1] == 24.0


def test_dedupe_deterministic(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 3), (2, "c", 1), (1, "a", 1)], "k long, s string, o int")
    assert sorted(rows(clean.dedupe_by_key(df, "k"))) == [(1, "a", 1), (2, "c", 1)]
    assert sorted(rows(clean.dedupe_by_key(df, "k", order_by=["o"]))) == [(1, "a", 1), (2, "c", 1)]
    assert sorted(rows(clean.dedupe_by_key(df, "k", order_by=[-F.col("o")]))) == [(1, "a", 3), (2, "c", 1)]


def test_dedupe_hot_key(spark):
    # one key holds most rows: still one survivor, whole result kept
    df = spark.range(0, 5000).select((F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))).alias("k"),
                                     F.col("id").alias("v"))
    out = clean.dedupe_by_key(df, "k", order_by=["v"])
    assert out.count() == df.select("k").distinct().count()
    assert rows(out.filter("k = 7"), "v") == [(0,)]


def test_clean_idempotent(spark):
    raw = fx.titles_with_duplicates(spark, SF_SMALL)
    once = clean_titles(raw)
    row_ops = lambda d: (d.transform(clean.drop_blank_rows).transform(clean.trim_column)
                         .transform(clean.fill_missing).transform(clean.collapse_rating)
                         .transform(clean.dedupe_by_key))
    assert sorted(rows(row_ops(once))) == sorted(rows(once))
    assert once.select("title_id").distinct().count() == once.count()


def test_exact_mean_boundaries(spark):
    from shelfwise.functions.numeric import exact_mean
    df = spark.createDataFrame([("a", 36.92), ("a", 36.93), ("b", -0.01), ("b", -0.02), ("c", None),
                                ("d", 0.1), ("d", 0.2), ("d", 0.2)], "k string, v double")
    got = dict(rows(df.groupBy("k").agg(exact_mean("v", 2, 2).alias("m")), "k", "m"))
    assert got == {"a": 36.93, "b": -0.02, "c": None, "d": 0.17}
    got4 = dict(rows(df.groupBy("k").agg(exact_mean("v", 2, 4).alias("m")), "k", "m"))
    assert got4["d"] == 0.1667 and got4["a"] == 36.925


def test_dedupe_ties_and_null_keys(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (None, "x"), (None, "w"), (3, "z"), (3, "z")],
                               "k long, s string")
    want = sorted(rows(clean.dedupe_by_key(df, "k")), key=repr)
    assert want == sorted([(1, "a"), (2, "c"), (None, "w"), (3, "z")], key=repr)
    two = sorted(rows(clean.dedupe_by_key(df.repartition(3), "k")), key=repr)
    assert two == want
    assert rows(clean.dedupe_by_key(df.filter("k = 2"), "k")) == [(2, "c")]
    assert rows(clean.dedupe_by_key(df, "k", ["s"]).filter("k = 1")) == [(1, "a")]
