import random
import re

import pytest

from shelfwise.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def plain(text, items, window=10):
    w, hit, got = words(text), set(), set()
    for i, t in items:
        iw = words(t)
        wins = [iw[s:s + window] for s in range(max(len(iw) - window + 1, 1))] if iw else []
        for x in wins:
            for p in range(len(w) - len(x) + 1):
                if w[p:p + len(x)] == x:
                    hit.update(range(p, p + len(x)))
                    got.add(str(i))
    return len(w), len(hit), sorted(got)


def case():
    rng = random.Random(1)
    vocab = ["Alpha", "été", "x9", "the", "of", "Ωmega", "q"] + [f"w{i}" for i in range(12)]
    prose = lambda n: " ".join(rng.choice(vocab) + rng.choice(["", ",", ".\n"]) for _ in range(n))
    items = [(i, prose(rng.randint(8, 40))) for i in range(12)] + [(50, "the of"), (51, ""), (52, None), (53, "...")]
    items.append(items[0])
    docs = [(None, 1), ("", 2), ("...", None), ("the of the of", 3)]
    for k in range(40):
        t = prose(rng.randint(0, 120))
        if k % 3 == 0:
            w = items[k % 12][1].split()
            s = rng.randint(0, max(len(w) - 10, 0))
            t += " " + " ".join(w[s:s + rng.randint(5, 20)]).upper().replace("ÉTÉ", "été").replace("ΩMEGA", "Ωmega") + " " + prose(20)
        docs.append((t, 100 + k))
    docs += docs[-3:]
    docs.append((prose(60_000), 999))
    return docs, items


@pytest.mark.parametrize("block", [D.BLOCK_BYTES, 300])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_BYTES", block)
    monkeypatch.setattr(D, "SEGMENT_BYTES", 4000)
    docs, items = case()
    if block == 300:
        docs = docs[:-1]
    df = spark.createDataFrame([(*d, "x") for d in docs], "text string, doc_id long, item_id string")
    it = spark.createDataFrame(items, "item_id long, text string")
    got = D.contamination(df, it).select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    want = [(i, *plain(t, items)) for t, i in docs]
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((*w, w[2] > 0)) for w in want)
    kept = [r.doc_id for r in D.drop_contaminated(df, it).collect()]
    assert sorted(map(repr, kept)) == sorted(repr(w[0]) for w in want if not w[2])


def test_proximity(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (2, "a b zz c d"), (3, "c a zz zz zz b d"), (4, "a b c"), (5, "d")],
                               "doc_id long, text string")
    it = spark.createDataFrame([(7, "a b c d")], "item_id long, text string")
    got = {r.doc_id: (r["items"], r.near) for r in D.contamination(df, it, slop=1).collect()}
    assert got == {1: (["7"], []), 2: ([], ["7"]), 3: ([], []), 4: ([], []), 5: ([], [])}


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert D.contamination(none, items).collect() == []
    rows = D.contamination(items.withColumnRenamed("item_id", "doc_id"), none.withColumnRenamed("doc_id", "item_id"))
    assert [(r.n_words, r.n_hit, r["items"]) for r in rows.collect()] == [(2, 0, [])]


def test_dropping_copes_with_any_column_name(spark):
    words = [f"w{i}" for i in range(30)]
    docs = spark.createDataFrame([(1, " ".join(words[:20]), 0, 0), (1, "clean text", 0, 0), (2, None, 0, 0)],
                                 "doc_id long, text string, __id int, __hash int")
    items = spark.createDataFrame([(1, " ".join(words[3:14]))], "item_id long, text string")
    assert sorted(map(str, (r.text for r in D.drop_contaminated(docs, items).collect()))) == ["None", "clean text"]


def test_index_files_hold_small_row_groups(spark):
    """Under a hundred segments of megabytes each, all written by one task: no row group (a writer holds one, a reader
    decodes one at once) takes them all."""
    import pyarrow.parquet as pq

    docs = [(k, " ".join(f"{k}x{i}" for i in range(130_000)) + " the end of every text") for k in range(24)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    index = D.build_index(df)
    files = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in index.inputFiles()]
    groups = [m.row_group(i) for m in files for i in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) >= 6
    assert len(groups) > 1 and max(g.total_byte_size for g in groups) < 32 << 20
    items = spark.createDataFrame([("a", "the end of every text")], "item_id string, text string")
    found = D.contamination(df, items).select("doc_id", "n_words", "n_hit").collect()
    assert sorted(map(tuple, found)) == [(k, 130_005, 5) for k in range(24)]


def test_few_rows_at_once(spark, monkeypatch):
    """Index and search hand few rows at once to Python; the session's setting is as before."""
    import pyarrow as pa
    from shelfwise.llm.common import arrow_rows

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    lengths = lambda: [r.n for r in spark.range(20, numPartitions=1).mapInArrow(
        lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long").collect()]
    before = spark.conf.get(key, None)
    with arrow_rows(spark, 6):
        assert lengths() == [6, 6, 6, 2]
    assert spark.conf.get(key, None) == before and lengths() == [20]
    spark.conf.set(key, "5")
    try:
        with arrow_rows(spark, 6):
            assert lengths() == [5, 5, 5, 5]
        with pytest.raises(ZeroDivisionError), arrow_rows(spark, 3):
            1 / 0
        assert spark.conf.get(key) == "5"
        seen, real = [], spark.conf.set
        monkeypatch.setattr(type(spark.conf), "set", lambda self, k, v: (seen.append((k, v)), real(k, v))[1])
        monkeypatch.setattr(D, "DOCS_AT_ONCE", 4)
        docs, items = case()
        df = spark.createDataFrame(docs[:6], "text string, doc_id long")
        assert D.contamination(df, spark.createDataFrame(items, "item_id long, text string")).count() == 6
        assert (key, "4") in seen and (key, str(D.SEGMENTS_AT_ONCE)) in seen and spark.conf.get(key) == "5"
    finally:
        monkeypatch.undo()
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
