import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import topk as K

SCHEMA = "vec_id long, embedding array<float>, score string, rank int"


def plain(rows, every, top):
    good = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, q in {(i, tuple(v)) for i, v in good if i % every == 0}:
        s = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i)[:top]
        out += [(i, k + 1, j, -n) for k, (n, j) in enumerate(s)]
    return sorted(out)


def got(spark, rows, every=5, top=K.TOP):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return sorted(map(tuple, K.search(df, F.col("vec_id") % every == 0, top).collect()))


@pytest.mark.parametrize("block", [K.QUERY_BLOCK, 7])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(K, "QUERY_BLOCK", block)
    monkeypatch.setattr(K, "ANNULUS", 16)
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = [(i, [c + rng.gauss(0, 0.2) for c in rng.choice(centres)]) for i in range(200)]
    rows += [(200 + i, rows[7][1]) for i in range(60)] + [rows[5], rows[10], rows[10]]
    rows += [(None, [1.0] * 8), (300, None), (305, [1.0, None] + [0.0] * 6), (310, [float("nan")] * 8),
             (315, [float("inf")] * 8), (320, []), (325, [2.0]), (330, [0.0] * 8)]
    assert got(spark, rows) == plain(rows, 5, K.TOP)


def test_few_and_none(spark):
    rows = [(0, [0.5, -0.1]), (1, [0.25, 3.0]), (5, [1.0, 1.0])]
    assert got(spark, rows) == plain(rows, 5, K.TOP)
    assert got(spark, rows[1:2]) == [] and got(spark, []) == []
    huge = [(i, [3e4 * (i + 1), -3e4]) for i in range(30)]
    assert got(spark, huge) == plain(huge, 5, K.TOP)
