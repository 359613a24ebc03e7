import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import exactdedup as D

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_hash_is_minimal_and_perfect(n):
    keys = np.frombuffer(b"".join(hashlib.sha256(b"%d" % i).digest() for i in range(2 * n)), "<u8").reshape(-1, 4)
    h = D.PerfectHash.build(keys[:n])
    assert sorted(h.slots(keys[:n]).tolist()) == list(range(n))
    strangers = h.slots(keys[n:])
    assert ((strangers >= -1) & (strangers < max(n, 1))).all()
    if n:
        with pytest.raises(ValueError):
            D.PerfectHash.build(np.concatenate((keys[:n], keys[:1])))


ROWS = [(1, "Same Text"), (2, "same text"), (7, "SAME TEXT"), (3, None), (4, ""), (5, "ÀÉ x"), (6, "àé x"), (8, " "),
        (9, "y" * 300_000), (10, "Y" * 300_000), (11, "a\x00b"), (12, "İ"), (-5, "same text"), (13, "other")]


@pytest.mark.parametrize("shard", [1 << 15, 3])
@pytest.mark.parametrize("old", ["doc_id <= 6", "doc_id > 6", "false", "true", "doc_id IS NULL"])
def test_equals_brute_force_whatever_the_history(spark, monkeypatch, shard, old):
    monkeypatch.setattr(D, "SHARD", shard)
    df = spark.createDataFrame([(i, t, "z", 0) for i, t in ROWS], "doc_id long, text string, row string, digest int")
    got = D.deduplicate(df.repartition(3), F.expr(old)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == brute(ROWS)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


@pytest.mark.parametrize("hot", [1000, 2])
def test_repeated_rows_null_ids_and_large_groups(spark, monkeypatch, hot):
    monkeypatch.setattr(D, "HOT", hot)
    rng = random.Random(3)
    rows = [(rng.choice([None, rng.randint(0, 300)]), rng.choice(["Hot"] * 6 + ["b", "c", f"u{i}", None])) for i in range(600)]
    rows += [(5, "twice"), (5, "twice"), (None, "no id"), (None, "NO ID")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = D.deduplicate(df, D.older_half(df)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == brute(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_members_go_through_the_index_and_strangers_do_not(spark):
    rows = [(i, f"text {i % 40}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    stored = D.digests(df, F.col("doc_id") < 30)
    old, new = D.groups(stored.filter("old"), 4), D.groups(stored.filter("NOT old"), 4)
    index = D.build(old).cache()
    found = D.probe(index, new).collect()
    assert len(found) == len({bytes(r.digest) for r in found}) == 40
    assert sum(len(r.winner_id) for r in index.collect()) == 30
    # a slot whose digest differs in one byte is no member: its rows then stand in two groups
    spoiled = index.toArrow()
    digests = spoiled["digests"].to_pylist()
    digests[0] = bytes([digests[0][0] ^ 1]) + digests[0][1:]
    spoiled = spoiled.set_column(spoiled.column_names.index("digests"), "digests", pa.array(digests, pa.binary()))
    again = D.probe(spark.createDataFrame(spoiled, D.INDEX), new)
    assert again.count() in (40, 41) and again.filter("group_size = 2").count() <= 20
    # history grows: an index of the result answers for all of it
    grown = D.probe(D.build(spark.createDataFrame(found, D.GROUP)), new).agg(F.sum("group_size"), F.count("*")).first()
    assert tuple(grown) == (60 + 30, 40)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert D.deduplicate(df, D.older_half(df)).collect() == []
