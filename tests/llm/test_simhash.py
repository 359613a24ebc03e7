import random

import numpy as np
import pytest

from shelfwise.llm import simhash as S

SCHEMA = "text string, doc_id long, root string, fp string"


def plain_fingerprint(text):
    from xxhash import xxh64_intdigest

    words, word = [], ""
    for ch in (text or "") + " ":
        if ch in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += ch.lower() if "A" <= ch <= "Z" else ch
    grams = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hs = [xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_groups(fps, d=2):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= d:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def check(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    got = S.near_duplicates(df, **kw).collect()
    assert len(got) == len(rows)
    fps = [plain_fingerprint(r[0]) for r in rows]
    groups = plain_groups(fps)
    least = {}
    for g, r in zip(groups, rows):
        if r[1] is not None:
            least[g] = min(least.get(g, r[1]), r[1])
    want = sorted((repr(r[1]), f"{f:016x}", repr(least.get(g))) for r, f, g in zip(rows, fps, groups))
    assert sorted((repr(x[0]), x[1], repr(x[2])) for x in got) == want


def test_edges_and_copies(spark):
    rng = random.Random(3)
    base = [[rng.choice("abcdefghijklmnop") * rng.randint(1, 4) for _ in range(rng.randint(40, 400))] for _ in range(12)]
    rows = [(None, 1, "x", "y"), ("", 2, "x", "y"), (" \t\n", None, "x", "y"), ("One", 4, "", ""), ("one", 5, "", ""),
            ("É a B c", 6, "", ""), ("x " * 70_000, 7, "", "")]
    n = 100
    for words in base:
        for _ in range(8):
            w = list(words)
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = "zz"
            rows.append((" ".join(w), n, "", ""))
            n += 1
    rows += rows[-5:]
    check(spark, rows)


def test_empty(spark):
    assert S.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("max_group", [4, 40, 1024])
def test_links_match_brute_force(spark, max_group):
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 2**63, 25, dtype=np.uint64)
    fps = {0}
    for s in seeds:
        for _ in range(20):
            x = int(s)
            for _ in range(rng.integers(0, 6)):
                x ^= 1 << int(rng.integers(0, 64))
            fps.add(x)
    fps = sorted(fps)
    nodes = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    edges = [(int(np.int64(a).astype(np.uint64)), int(np.int64(b).astype(np.uint64)))
             for a, b in S.links(nodes, max_group=max_group).collect()]
    at = {f: i for i, f in enumerate(fps)}
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[find(at[a])] = find(at[b])
    want, got = plain_groups(fps), [find(i) for i in range(len(fps))]
    pairs = set(zip(want, got))
    assert len(pairs) == len(set(want)) == len(set(got))


def test_hierarchy_finds_every_pair():
    rng = np.random.default_rng(7)
    x = rng.integers(0, 2**20, 700).astype(np.uint64)
    x = np.unique(x)
    x = x[np.argsort(S.gray_rank(x))]
    got = {(i, j) for a, b in S.linked_pairs(x, 2) for i, j in zip(a.tolist(), b.tolist())}
    want = {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if int(x[i] ^ x[j]).bit_count() <= 2}
    assert got == want


def test_keep_one(spark):
    rows = [("a b c d", 3, "", ""), ("a b c d", 1, "", ""), ("a b c d", 1, "k", ""), ("p q r s t", None, "", ""),
            ("p q r s t", 9, "", ""), ("alone here now", None, "", ""), ("other words entirely", 12, "", "")]
    got = S.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(repr, ((r.text, r.doc_id) for r in got))) == sorted(
        map(repr, [("a b c d", 1), ("p q r s t", 9), ("alone here now", None), ("other words entirely", 12)]))


def test_keep_one_counts_an_id_in_all_its_groups(spark):
    rows = [("a b c d", 3, "", ""), ("a b c d", 5, "", ""), ("p q r s t", 5, "", ""), ("p q r s t", 8, "", ""), ("k l m n", 7, "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    taken = df.selectExpr("*", "1 AS __stay", "2 AS __stay_", "text AS row", "3 AS n", "4 AS stays")
    for docs in (df, taken):
        got = S.keep_one(docs)
        assert got.columns == docs.columns
        assert sorted((r.text, r.doc_id) for r in got.collect()) == [("a b c d", 3), ("k l m n", 7), ("p q r s t", 5)]
