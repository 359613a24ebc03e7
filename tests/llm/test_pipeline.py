import random

import corpus_pipeline as P
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from test_decontaminate import plain
from test_simhash import plain_fingerprint, plain_groups

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def write(spark, path, docs, labels, items):
    spark.createDataFrame([(i, t, k, "s", len(t or "")) for i, t, k in docs], DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


def test_run_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    words = ["the", "house", "tree", "walks", "green", "under", "river", "stone", "early", "light", "cloud", "paper"]
    prose = lambda n: " ".join(rng.choice(words) + str(rng.randint(0, 99)) for _ in range(n))
    docs, labels = [], []
    for i in range(160):
        text = prose(rng.randint(20, 90))
        bad = i % 4 == 0
        if bad:
            text = text.replace("house", "idiot scum")[:2000] + " idiot scum moron"
        docs.append((i, text, "en"))
        labels.append((i, int(bad)))
    items = [(1, prose(30)), (2, prose(12))]
    docs += [(200, None, "en"), (201, "12 34", "en"), (202, "", None)]
    docs += [(300 + i, docs[4 * i + 1][1], "en") for i in range(6)] + [docs[9]]
    docs += [(400, prose(10) + " " + items[0][1] + " " + prose(10), None), (401, items[1][1].upper(), None)]
    docs += [(500, " ".join([prose(50)] * 40), None)]
    write(spark, str(tmp_path), docs, labels, items)
    got = P.run(spark, str(tmp_path)).collect()
    toxic = {i for i, y in labels if y}
    kept = [(i, t) for i, t, _ in docs if t and any(c.isalpha() for c in t) and i not in toxic]
    groups, seen, one = plain_groups([plain_fingerprint(t) for _, t in kept]), {}, []
    for g, (i, t) in sorted(zip(groups, kept), key=lambda x: x[1][0]):
        if g not in seen:
            seen[g] = i
            one.append((i, t))
    clean = {i: t for i, t in one if not plain(t, items)[1]}
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        ids.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert ids == {i: tok.encode(t, add_special_tokens=False).ids + [2] for i, t in clean.items()}
    assert [n for n, _ in P.STAGES][0] == "language" and P.ORACLE_SQL is None


def test_empty_tables(spark, tmp_path):
    write(spark, str(tmp_path), [], [], [])
    assert P.run(spark, str(tmp_path)).collect() == []
