import os

import pytest
from pyspark.sql import functions as F

from shelfwise.streaming import incremental as inc
from shelfwise.streaming import upserts as U
from shelfwise.streaming.names import NameIndex

from conftest import rows

SCHEMA = "title_id long, title_name string, episodes int, duration_min double, score double, ranking int, members int, favorites int"


def frame(spark, *data):
    return spark.createDataFrame([(i, n, e, m, 5.0, 1, 1, 1) for i, n, e, m in data], SCHEMA)


def minutes(spark, target):
    return {r.title_id: (r.title_name, r.episodes, r.duration_min) for r in spark.read.parquet(target).collect()}


def sums(spark, target):
    found = spark.read.parquet(target + "_duration_sums").groupBy("episodes").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    return {r.episodes: (r.s, r.n) for r in found.filter("n <> 0").collect()}


def test_update_takes_back_what_the_old_row_put_in(spark, tmp_path):
    target = str(tmp_path / "t")
    w = U.MergeWriter(target)
    w.load(frame(spark, (1, "a", 12, 24.0), (2, "b", 12, 26.0), (3, "c", 13, 60.0)))
    w(frame(spark, (1, "a", 12, 30.0), (4, "d", 12, None), (3, "c", 12, None)), 0)
    # 12: 26 stored, 30 changed; the old 24 is gone. 13 has nothing left.
    assert minutes(spark, target) == {1: ("a", 12, 30.0), 2: ("b", 12, 26.0), 3: ("c", 12, 28.0), 4: ("d", 12, 28.0)}
    assert sums(spark, target) == {12: (2600 + 3000 + 2800 + 2800, 4)}
    w(frame(spark, (5, "e", 13, None)), 1)                  # no peer with 13 episodes any more
    assert minutes(spark, target)[5] == ("e", 13, None)


@pytest.mark.parametrize("lost", ["nothing", "stage", "sums", "target"])
def test_replay_from_any_point(spark, tmp_path, lost):
    target = str(tmp_path / "t")
    w = U.MergeWriter(target, buckets=4)
    w.load(frame(spark, *[(i, str(i), 12, 20.0 + i) for i in range(20)]))
    batch = frame(spark, (3, "new", 12, None), (30, "x", 12, 1.0), (None, "no id", 12, None), (None, "no id", 12, None))
    w(batch, 0)
    want, total = rows(spark.read.parquet(target)), sums(spark, target)
    if lost == "stage":      # as if the epoch had stopped before its rows were staged: the table is the old one
        w2 = U.MergeWriter(str(tmp_path / "again"), buckets=4)
        w2.load(frame(spark, *[(i, str(i), 12, 20.0 + i) for i in range(20)]))
        os.makedirs(str(tmp_path / "again_epochs/epoch=0/_temporary"))
        w2(batch, 0)
        target = str(tmp_path / "again")
    elif lost == "target":   # stopped between two buckets: some replaced, some not
        w(batch, 0)
    elif lost == "sums":
        w(batch, 0)
        w(batch, 0)
    assert sorted(rows(spark.read.parquet(target)), key=repr) == sorted(want, key=repr)
    assert sums(spark, target) == total


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    target = str(tmp_path / "t")
    w = U.MergeWriter(target, buckets=16)
    w.load(frame(spark, *[(i, str(i), 12, 24.0) for i in range(400)]))
    files = lambda: {d: sorted(os.listdir(f"{target}/{d}")) for d in os.listdir(target) if d.startswith("bucket=")}
    before = files()
    w(frame(spark, (7, "changed", 12, 30.0)), 0)
    after = files()
    assert [d for d in before if before[d] != after[d]] == [f"bucket={w.table.touched(frame(spark, (7, '', 1, 1.0)))[0]}"]
    assert spark.read.parquet(target).count() == 400


def test_last_row_of_a_key_wins_and_bad_rows_reject_all(spark, tmp_path):
    target = str(tmp_path / "t")
    w = U.MergeWriter(target, order_by=("members",))
    w.load(frame(spark, (1, "a", 12, 24.0)))
    batch = spark.createDataFrame([(1, "late", 12, 3.0, 5.0, 1, 9, 1), (1, "early", 12, 2.0, 5.0, 1, 2, 1)], SCHEMA)
    w(batch, 0)
    assert minutes(spark, target) == {1: ("late", 12, 3.0)}
    with pytest.raises(ValueError):
        w(batch.withColumn("score", F.lit(11.0)), 1)
    assert minutes(spark, target) == {1: ("late", 12, 3.0)} and not os.path.exists(target + "_epochs/epoch=1")


def test_name_index_opens_only_buckets_that_may_hold_a_name(spark, tmp_path):
    index = NameIndex(str(tmp_path / "n"), buckets=32, words=256)
    names = lambda *x: spark.createDataFrame([(n,) for n in x], "title_name string")
    index.add(names(*[f"stored {i}" for i in range(300)], None), -1)
    index.add(names("later"), 0)
    assert len(index.touched(names("stored 5"), 1)) == 1 and len(index.touched(names("stored 5", "later", None), 1)) <= 2
    assert index.touched(names("later"), 0) == index.touched(names(*[f"new {i}" for i in range(3)]), 0) == []
    held = index.stored(names("stored 5", "unseen"), 1)
    assert "stored 5" in {r[0] for r in held.collect()}
    assert len(held.inputFiles()) >= 32                     # all files of the index; the filter prunes folders:
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan
    assert held.count() < 60                                # one bucket's names of 301
    index.add(names("later"), 0)                            # again: the same
    assert sorted(r[0] for r in index.stored(names("later"), 1).collect()).count("later") == 1


def test_ingest_through_the_index_equals_a_full_scan(spark, tmp_path):
    target = str(tmp_path / "t")
    w = inc.BatchWriter(target)
    frame(spark, *[(i, f"n{i}", 12, 24.0) for i in range(100)]).write.parquet(target)
    w(frame(spark, (200, "n5", 12, 1.0), (201, "x", 12, 2.0), (202, "x", 12, 3.0), (203, None, 12, 4.0)), 0)
    w(frame(spark, (300, "x", 12, 1.0), (301, "n99", 12, 2.0), (302, "y", 12, None)), 1)
    assert sorted(r.title_id for r in spark.read.parquet(target).filter("title_id >= 200").collect()) == [201, 203, 302]
