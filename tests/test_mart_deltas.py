import pytest
from pyspark.sql import functions as F

from shelfwise.operators import mart_deltas as D
from shelfwise.operators import marts
from shelfwise.plans import star as S
from shelfwise.plans.cleaning import clean_titles
from shelfwise.sources import fixtures as fx
from shelfwise.sources import snapshots
from shelfwise.sources.tables import materialize

from conftest import SF_SMALL, rows


@pytest.fixture(scope="module")
def tables(spark):
    clean = materialize(clean_titles(fx.titles_with_duplicates(spark, SF_SMALL)))
    changed = (clean.filter("title_id % 7 <> 0")
               .withColumn("genres", F.when(F.col("title_id") % 5 == 0, F.lit("new one, new one, other")).otherwise(F.col("genres")))
               .withColumn("score", F.when(F.col("title_id") % 6 == 0, F.lit(None)).otherwise(F.col("score")))
               .withColumn("members", F.when(F.col("studio").startswith("N/A"), F.lit(None)).otherwise(F.col("members")))
               .withColumn("duration_min", F.when(F.col("title_id") % 4 == 0, F.col("duration_min") + 1).otherwise(F.col("duration_min")))
               .unionByName(clean.limit(3).withColumn("title_id", F.col("title_id") + 10_000)))
    return clean, materialize(changed)


@pytest.mark.parametrize("mart", D.MARTS)
def test_whole_sums_equal_the_marts_of_the_star(spark, tables, mart):
    want = getattr(marts, mart)(S.build_star(tables[0]))
    got = D.finish(D.mart_sums(tables[0]), mart)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(rows(got, *want.columns), key=repr) == sorted(rows(want), key=repr)


def test_a_delta_gives_the_sums_of_the_new_table(spark, tables):
    base, new = tables
    changes = D.mart_changes(base, snapshots.differential_snapshot(base, new))
    after = D.apply_changes(D.mart_sums(base), changes)
    assert sorted(rows(after, *D.KEYS, *D.SUMS), key=repr) == sorted(rows(D.mart_sums(new), *D.KEYS, *D.SUMS), key=repr)
    back = D.apply_changes(after, D.mart_changes(new, snapshots.differential_snapshot(new, base)))
    assert sorted(rows(back, *D.KEYS, *D.SUMS), key=repr) == sorted(rows(D.mart_sums(base), *D.KEYS, *D.SUMS), key=repr)


def test_no_change_gives_no_delta(spark, tables):
    base = tables[0]
    assert D.mart_changes(base, snapshots.differential_snapshot(base, base)).isEmpty()
