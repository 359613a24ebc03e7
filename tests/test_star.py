from pyspark.sql import functions as F

from shelfwise.operators import constraints
from shelfwise.operators.keys import dense_ids
from shelfwise.operators.normalize import attach_stats_key, project_stats
from shelfwise.plans import star as S
from shelfwise.plans.cleaning import clean_titles
from shelfwise.sources import fixtures as fx

from conftest import SF_SMALL, rows


def test_dense_ids_are_global_rank(spark):
    df = spark.range(0, 3000).select(((F.col("id") * 7919) % 3001).alias("k")).repartition(13)
    out = dense_ids(df, ["k"], "id", num_partitions=7)
    got = sorted(rows(out, "k", "id"))
    assert [i for _, i in got] == list(range(1, 3001))
    assert [k for k, _ in got] == sorted(k for k, _ in got)


def test_dense_ids_string_keys(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("",)], "v string")
    assert rows(dense_ids(df, ["v"], "id").orderBy("id")) == [("", 1), ("a", 2), ("b", 3), ("c", 4)]


def test_star_invariants(spark, tmp_path):
    clean = clean_titles(fx.titles_with_duplicates(spark, SF_SMALL))
    star = S.write_star(clean, str(tmp_path / "star"))
    # ids are dense 1..n and unique
    for name, id_col in [("premiered", "premiered_id"), ("rating", "rating_id"), ("genre", "genre_id"),
                         ("studio", "studio_id"), ("statistic", "statistic_id"), ("title_genre", "title_genre_id")]:
        t = star[name]
        n = t.count()
        assert rows(t.agg(F.min(id_col), F.max(id_col), F.countDistinct(id_col))) == [(1, n, n)]
        assert constraints.check_primary_key(t, id_col).count() == 0
    assert constraints.check_primary_key(star["title"], "title_id").count() == 0
    # no orphan foreign keys
    for child, fk, parent in [("title", "premiered_id", "premiered"), ("title", "rating_id", "rating"),
                              ("title", "media_type_id", "media_type"), ("title", "statistic_id", "statistic"),
                              ("title_genre", "genre_id", "genre"), ("title_studio", "studio_id", "studio"),
                              ("title_genre", "title_id", "title")]:
        assert constraints.check_foreign_key(star[child], fk, star[parent], fk).count() == 0
    # round trip: genres per title from the star = trimmed split of the cleaned column (as sets)
    back = (star["title_genre"].join(star["genre"], "genre_id").groupBy("title_id")
            .agg(F.array_sort(F.collect_set("genre_name")).alias("g")))
    direct = (clean.select("title_id", F.explode(F.split("genres", ",")).alias("x"))
              .groupBy("title_id").agg(F.array_sort(F.collect_set(F.trim("x"))).alias("g")))
    assert sorted(rows(back)) == sorted(rows(direct))


def test_attach_stats_key_reference_rule(spark):
    df = spark.createDataFrame(
        [(1, 5, 1, 8.0, 3, 10), (2, 5, 1, 8.0, 3, 10), (3, 6, 1, None, 3, 10)],
        "title_id long, ranking int, favorites int, score double, popularity int, members int")
    stats = project_stats(df)
    got = dict(rows(attach_stats_key(df, stats), "title_id", "statistic_id"))
    assert got == {1: 1, 2: 1, 3: None}   # equal tuples share the smallest id; NULL never matches
    got_ns = dict(rows(attach_stats_key(df, stats, null_safe=True), "title_id", "statistic_id"))
    assert got_ns[3] == 3


def test_star_titles_collapse_order(spark):
    clean = clean_titles(fx.titles_with_duplicates(spark, SF_SMALL))
    titles = S.star_titles(S.build_star(clean))
    r = titles.filter(F.col("title_name").isNotNull()).orderBy("title_name").first()
    assert ", " in r["genre_names"] or r["genre_names"] != ""
    # no NULL key survives the collapse
    for k in S.COLLAPSE_KEYS:
        assert titles.filter(F.col(k).isNull()).count() == 0


def test_validate_modes(spark):
    bad = fx.titles_with_violations(spark, SF_SMALL)
    import pytest
    with pytest.raises(ValueError):
        constraints.validate(bad, strict=True)
    good, rejected = constraints.split_valid(bad)
    assert good.count() + rejected.count() == bad.count()
    assert constraints.validate(fx.titles_raw(spark, SF_SMALL), strict=True).count() == 200


def test_dense_ids_with_coalesced_ranges(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5003).alias("k"),
                                         (F.col("id") % 3).cast("string").alias("g")).repartition(9)
        out = dense_ids(df, ["k"], "id", group_cols=["g"])
        got = sorted(rows(out, "g", "k", "id"))
        for g in ("0", "1", "2"):
            part = [(k, i) for gg, k, i in got if gg == g]
            assert [i for _, i in part] == list(range(1, len(part) + 1))
            assert [k for k, _ in part] == sorted(k for k, _ in part)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_standalone_dimension_operators_match_star(spark):
    from shelfwise.operators import normalize as N
    clean = clean_titles(fx.titles_with_duplicates(spark, SF_SMALL))
    star = S.build_star(clean)
    assert sorted(rows(N.distinct_dimension(clean, "premiered", "premiered_id"))) == sorted(rows(star["premiered"]))
    assert sorted(rows(N.split_distinct(clean, "genres", "genre_name", "genre_id"))) == sorted(rows(star["genre"]))
    assert sorted(rows(N.bridge_studios(clean, star["studio"]))) == sorted(rows(star["title_studio"]))
    lazy = S.build_star(clean, stored=False)
    assert sorted(rows(S.star_titles(lazy))) == sorted(rows(S.star_titles(star)))


def test_star_titles_shuffles_the_synopsis_once(spark):
    star = S.build_star(clean_titles(fx.titles_with_duplicates(spark, SF_SMALL)))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = S.star_titles(star)._jdf.queryExecution().executedPlan()
        wide = []

        def walk(node):
            if node.nodeName() == "Exchange" and "synopsis#" in node.output().mkString(",").replace("_synopsis#", ""):
                wide.append(node)
            children = node.children()
            for i in range(children.size()):
                walk(children.apply(i))

        walk(plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert len(wide) == 1


def test_collapse_moves_a_digest_of_its_keys_with_the_list_rows(spark):
    star = S.build_star(clean_titles(fx.titles_with_duplicates(spark, SF_SMALL)))
    plan = S.star_titles(star)._jdf.queryExecution().optimizedPlan().toString()
    groupings = [line for line in plan.splitlines() if "Aggregate [" in line]
    assert groupings and not [line for line in groupings if "synopsis" in line or "popularity" in line]


def test_titles_are_cleaned_by_many_tasks(spark, tmp_path):
    spark.read.parquet(f"{SF_SMALL}/part.parquet").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    titles = fx.titles_with_duplicates(spark, str(tmp_path))
    assert titles.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism     # two branches of a union
    want = fx.titles_with_duplicates(spark, SF_SMALL)
    assert titles.exceptAll(want).isEmpty() and want.exceptAll(titles).isEmpty()
