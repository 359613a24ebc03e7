import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import merkle as M


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    parts = ("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text))
    return sha("".join(parts))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def steps(levels, i):
    out = []
    for level in levels[:-1]:
        run = i // 8 * 8
        out.append(("".join(level[run:i]), "".join(level[i + 1:run + 8])))
        i //= 8
    return out


def lowered(text):
    return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r[2]].append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for x in langs:
        by_lang[x].sort(key=lambda t: t[:3])
        trees[x] = tree([t[2] for t in by_lang[x]])
    over = tree([trees[x][-1][0] for x in langs])
    root, out = over[-1][0] if rows else None, []
    for k, x in enumerate(langs):
        for i, (_, _, h, r) in enumerate(by_lang[x]):
            path = steps(trees[x], i) + steps(over, k)
            f = leaf(r, lowered(r[1])) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 else h
            for a, b in path:
                f = sha(a + f + b)
            out.append((r[0], h, trees[x][-1][0], root, sha("".join(a + b for a, b in path)), f, f == root))
    return sorted(out, key=repr)


def result(df, levels=M.LEVELS):
    when = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return sorted((tuple(r) for r in M.manifest(df, {"text": low}, when, levels=levels).collect()), key=repr)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g string, total int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("levels", [4, 1, 2])
def test_equals_brute_force(spark, levels):
    rng = random.Random(levels)
    ids = rng.sample(range(-3000, 3000), 300) + [2**63 - 1, -2**63, 2**40, 2**40 + 1, 2**33, -2**50]
    rows = [(i, rng.choice(["Text", "no capitals", "ÀB é", "", None]) if k % 3 else f"Text {k}", rng.choice(["en"] * 5 + ["de", None, "", "é", "z"]),
             rng.choice([None, "src"]), rng.choice([None, 4])) for k, i in enumerate(ids)]
    rows += [(9001, "Alone " * 30_000, "one leaf", "s", 1)]
    got = result(frame(spark, rows), levels)
    assert got == brute(rows)
    assert {r[-1] for r in got} == {True, False}


def test_repeated_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(M, "STRETCH", 4)
    rng = random.Random(6)
    rows = [(rng.choice([None, None, 5, 5, 6, 70, 71, 500, -1, k]), rng.choice(["A", "b", "c", None]), rng.choice(["en", None]), "s", 1)
            for k in range(400)]
    got = result(frame(spark, rows))
    assert got == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 8, 9, 64, 65])
def test_sizes_around_a_run(spark, n):
    rows = [(i, f"T{i}", "en", "s", 1) for i in range(n)]
    assert result(frame(spark, rows)) == brute(rows)


def test_many_groups(spark):
    rows = [(i, f"T{i}", f"l{i % 70}", "s", 1) for i in range(160)]
    assert result(frame(spark, rows), 1) == brute(rows)


def test_directory_counts_smaller_keys(spark):
    rng = random.Random(1)
    keys = [rng.randint(-2**63, 2**63 - 1) for _ in range(200)] + list(range(-40, 40)) + [2**16 * k for k in range(1, 20)] + [None]
    rows = [(g, k, rng.randint(1, 5)) for g in "ab" for k in keys]
    got = M.offsets(spark.createDataFrame(rows, "g string, k long, n long"), ["g"], "k", "n").collect()
    for r in got:
        order = [(k is not None, k or 0, n) for g, k, n in rows if g == r.g]
        assert r.base == sum(n for a, k, n in order if (a, k) < (r.k is not None, r.k or 0))
        assert r.total == sum(n for *_, n in order)
    assert len(got) == len(rows)
