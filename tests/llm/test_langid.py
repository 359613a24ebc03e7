import random
import zlib

import numpy as np

from shelfwise.llm import langid as L

SCHEMA = "doc_id long, text string, lang string, lang_pred string"


def plain_phrases(text, sample):
    """Greedy longest-phrase parse by substring search, restarted every LANE letters."""
    n = 0
    for s in range(0, len(text), L.LANE):
        part, i = text[s:s + L.LANE], 0
        while i < len(part):
            j = i + 1
            while j < len(part) and part[i:j + 1] in sample:
                j += 1
            i, n = j, n + 1
    return n


def plain_clean(text):
    out = "".join(c.lower()[0] if c.isalpha() else " " for c in text + " ")
    while "  " in out:
        out = out.replace("  ", " ")
    return out.lstrip(" ")


def test_phrases_match_substring_search():
    rng = random.Random(2)
    a = "".join(rng.choice("abc ") for _ in range(300))
    b = "".join(rng.choice("abcd é") for _ in range(200))
    p = L.Parser({"x": a, "y": b})
    texts = ["", "abc", "ABC dé!", "zz z", "a" * 2500] + [
        "".join(rng.choice("abcdé z.") for _ in range(rng.randint(1, 1500))) for _ in range(20)]
    codes, ends, _ = p.codes(texts)
    got = p.phrases(codes, ends)
    for t, g in zip(texts, got):
        assert list(g) == [plain_phrases(plain_clean(t), plain_clean(s)) for s in (a, b)], t


def test_cases(spark):
    rng = random.Random(4)
    word = {"en": ["the", "and", "of", "thing"], "de": ["der", "und", "schön", "über"]}
    rows = [(i, " ".join(rng.choice(word[k]) for _ in range(30)), k, "clash")
            for i in range(60) for k in ["en" if i % 2 else "de"]]
    rows += [(100, None, "en", ""), (101, "", "de", ""), (102, "12 34 !?", "en", ""), (None, "the and of the", None, ""),
             (103, "der und über " * 20_000, None, ""), (103, "der und über " * 20_000, None, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, L.predict(df).collect()), key=repr)
    assert len(got) == len(rows)
    for i, held, lang, score in got:
        assert held == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= score <= 1
    pred = {i: lang for i, _, lang, _ in got}
    assert all(pred[i] == ("en" if i % 2 else "de") for i in range(60))
    assert [pred[i] for i in (100, 101, 102, None, 103)] == ["und", "und", "und", "en", "de"]
    out = L.identify(df, L.Parser({}))
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "lang_pred_", "score"]
    assert {r.lang_pred_ for r in out.collect()} == {"und"}
    assert L.predict(df.limit(0)).collect() == []


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = L.predict(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.98


def test_recognised_keeps_what_reads_as_a_language(spark):
    rng = random.Random(4)
    word = {"en": ["the", "and", "of", "thing"], "zh": ["的是不", "我一有", "大在人", "了中到"]}
    text = lambda k, n: (" " if k == "en" else "").join(rng.choice(word[k]) for _ in range(n))
    rows = [(i, text("en" if i % 2 else "zh", 30), "en" if i % 2 else "zh", "") for i in range(40)]
    rows += [(100, "ничего не понятно совсем ни слова", None, ""), (101, "12 !", None, ""), (102, None, None, ""), (103, "да", None, ""),
             (104, "thing of the thing 99 и", None, ""), (105, "的是我大不一在人有了" * 3, None, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id for r in L.recognised(df, L.train(df)).collect()}
    assert got == {*range(40), 103, 104, 105}
    unlabelled = df.selectExpr("doc_id", "text", "cast(null AS string) AS lang", "lang_pred")
    assert L.recognised(unlabelled, L.train(unlabelled)).count() == len(rows)
