import time

from pyspark.sql import functions as F

from shelfwise.sources import fixtures as fx
from shelfwise.streaming import incremental as inc
from shelfwise.operators import ingest

from conftest import SF_SMALL, rows


def test_stream_equals_batch(spark, tmp_path):
    arriving = fx.titles_arriving(spark, SF_SMALL)
    stored = inc.clean_stream(fx.titles_stored(spark, SF_SMALL))
    stored = inc.impute_from_table(stored, None)
    target = str(tmp_path / "target")
    stored.write.parquet(target)
    src = str(tmp_path / "src")
    arriving.repartition(3).write.parquet(src)          # three files: several micro-batches possible
    q = inc.start_incremental(spark, src, arriving.schema, target, str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    assert q.exception() is None
    got = spark.read.parquet(target)
    # batch formulation of the same job: insert-if-absent, then impute from stored ∪ inserted
    new = ingest.insert_if_absent(inc.clean_stream(arriving), stored)
    expect = stored.unionByName(inc.impute_from_table(new, stored))
    assert sorted(rows(got), key=repr) == sorted(rows(expect.select(*got.columns)), key=repr)


def test_stream_guard_rejects_batch(spark, tmp_path):
    bad = fx.titles_with_violations(spark, SF_SMALL)
    src = str(tmp_path / "src")
    bad.write.parquet(src)
    target = str(tmp_path / "target")
    q = inc.start_incremental(spark, src, bad.schema, target, str(tmp_path / "ckpt"))
    try:
        q.awaitTermination(120)
    except Exception:  # noqa: BLE001 - the failed batch surfaces here
        pass
    time.sleep(0.5)
    assert q.exception() is not None
    import os
    assert not os.path.exists(target)           # nothing was written


def test_batch_writer_sums_and_replay(spark, tmp_path):
    schema = "title_id long, title_name string, episodes int, duration_min double, score double, " \
             "ranking int, members int, favorites int"
    b0 = spark.createDataFrame([(1, "a", 12, 24.0, 5.0, 1, 1, 1), (2, "b", 12, 25.0, 5.0, 2, 1, 1)], schema)
    b1 = spark.createDataFrame([(3, "c", 12, None, 5.0, 3, 1, 1), (4, "a", 12, None, 5.0, 4, 1, 1),
                                (5, "d", 13, None, 5.0, 5, 1, 1)], schema)
    target = str(tmp_path / "t")
    w = inc.BatchWriter(target)
    w(b0, 0)
    w(b1, 1)
    got = {r["title_id"]: r["duration_min"] for r in spark.read.parquet(target).collect()}
    assert got == {1: 24.0, 2: 25.0, 3: 24.5, 5: None}     # 'a' again is not inserted; no peer for 13
    w(b1, 1)                                               # replay of epoch 1: nothing new, delta kept
    again = {r["title_id"]: r["duration_min"] for r in spark.read.parquet(target).collect()}
    assert again == got
    sums = {r["episodes"]: (r["s"], r["n"]) for r in
            spark.read.parquet(target + "_duration_sums").groupBy("episodes")
            .agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()}
    assert sums == {12: (2400 + 2500 + 2450, 3)}


BATCH = "title_id long, title_name string, episodes int, duration_min double, score double, ranking int, members int, favorites int"


def test_replay_writes_null_names_once(spark, tmp_path):
    b = spark.createDataFrame([(1, None, 12, 24.0, 5.0, 1, 1, 1), (2, None, 12, None, 5.0, 2, 1, 1), (3, "c", 12, None, 5.0, 3, 1, 1)], BATCH)
    target = str(tmp_path / "t")
    for _ in range(3):
        inc.BatchWriter(target)(b, 0)
    assert spark.read.parquet(target).count() == 3


def test_half_written_folders_are_redone(spark, tmp_path):
    b0 = spark.createDataFrame([(1, "a", 12, 24.0, 5.0, 1, 1, 1)], BATCH)
    b1 = spark.createDataFrame([(2, "b", 12, None, 5.0, 2, 1, 1)], BATCH)
    target = str(tmp_path / "t")
    for kind in ("epochs", "duration_sums"):
        for n in (-1, 0, 1):
            (tmp_path / f"t_{kind}" / f"epoch={n}" / "_temporary").mkdir(parents=True)
    w = inc.BatchWriter(target)
    w(b0, 0)
    w(b1, 1)
    got = {r["title_id"]: r["duration_min"] for r in spark.read.parquet(target).collect()}
    assert got == {1: 24.0, 2: 24.0}


def test_rejected_batch_writes_nothing(spark, tmp_path):
    import os

    import pytest

    bad = spark.createDataFrame([(1, "a", 12, 24.0, 11.0, 1, 1, 1)], BATCH)
    with pytest.raises(ValueError):
        inc.BatchWriter(str(tmp_path / "t"))(bad, 0)
    assert not os.path.exists(tmp_path / "t") and not os.path.exists(tmp_path / "t_epochs")
