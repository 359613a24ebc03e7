import random
import zlib

import numpy as np
import pytest

from shelfwise.llm import toxicity as X


def corpus(n, seed):
    rng = random.Random(seed)
    plain = ["la", "mente", "house", "Über", "tree", "walk", "café", "x1"]
    bad = ["idiot", "scum", "vequ" + rng.choice(["aire", "mo"])]
    out = []
    for i in range(n):
        w = [rng.choice(plain) + rng.choice(["", "ing", "s"]) for _ in range(rng.randint(1, 120))]
        y = i % 4 == 0
        if y:
            for _ in range(3):
                w.insert(rng.randrange(len(w) + 1), rng.choice(bad))
        out.append((" ".join(w).encode(), int(y)))
    return out


def test_gradients_match_differences():
    net = X.Network(1)
    for k in net.w:
        net.w[k] = net.w[k].astype(np.float64) + 0.01
    rng = np.random.default_rng(2)
    x = rng.standard_normal((9, X.WORD_DIM + X.GRAM_DIM))
    x[-1] = 0
    idx = rng.integers(0, 9, (5, X.WINDOW))
    idx[0, 4:] = 8
    y = np.array([1, 0, 1, 0, 1.0])
    net._run = lambda g, i, s, k, f=net._run: f(g, i, s, k)
    grad, d_x, _ = net.gradients(x, idx, y)

    def loss():
        p = X._sigmoid(net.forward(x, idx).astype(float))
        return -np.mean(np.log(np.where(y > 0, p, 1 - p)))

    eps = 1e-2
    for a, g in [*((net.w[k], grad[k]) for k in net.w), (x, d_x)]:
        for _ in range(4):
            at = tuple(int(rng.integers(0, n)) for n in a.shape)
            if a is x and at[0] == 8:
                continue
            was = a[at]
            a[at] = was + eps
            up = loss()
            a[at] = was - eps
            down = loss()
            a[at] = was
            assert (up - down) / (2 * eps) == pytest.approx(g[at], abs=2e-3)


def test_windows_cover_every_word():
    for n in (0, 1, 23, 24, 25, 40, 41, 1000):
        w = X.Words([b" ".join(b"w%d" % i for i in range(n)), b"other"])
        idx, of = w.windows()
        mine = idx[of == 0]
        assert set(mine.ravel().tolist()) - {len(w.rows)} == set(w.word[:n].tolist())
        assert (n <= 24) == (len(mine) == 1)


def test_learns_words_and_beginnings():
    data = corpus(600, 1)
    net = X.train([t for t, _ in data], [y for _, y in data])
    test = corpus(200, 9)
    p = net.scores([t for t, _ in test]) >= 0.5
    assert np.mean(p == [y for _, y in test]) > 0.95
    long = b"walking tree " * 30_000
    s = net.scores([long, long + b"idiot scum idiot " + long, None, b"", b"..."])
    assert s[0] < 0.5 < s[1] and s[2] == s[3] == s[4] and (0 <= s).all() and (s <= 1).all()


def test_query_and_edges(spark):
    data = corpus(400, 3)
    rows = [(i, t.decode(), "en", 2.0) for i, (t, _) in enumerate(data)]
    rows += [(None, "an idiot", "x", 0.0), (900, None, "", 0.0), (901, "", "", 0.0), rows[7], rows[7]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(data)] + [(900, 1), (None, 1), (901, None)],
                                   "doc_id long, toxic int")
    got = X.predict(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r.predicted == data[r.doc_id][1] for r in got if r.held_out and r.doc_id < 400]
    assert np.mean(held) > 0.9
    net = X.train([], [])
    assert X.score(docs, net).columns == ["doc_id", "text", "lang", "score", "score_", "predicted"]
    assert {r.predicted for r in X.score(docs, net).collect()} == {0}
    assert X.predict(docs.limit(0), labels).collect() == []
    assert X.predict(docs, labels.limit(0)).count() == len(rows)


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = X.predict(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in got]) > 0.95


def test_the_lean_pass_gives_the_forward_pass():
    rng = np.random.default_rng(4)
    net = X.Network(3)
    for k in ("xf", "xb", "a", "v", "out"):
        net.w[k] = rng.standard_normal(net.w[k].shape).astype(np.float32)
    texts = [b"", b"one", b" ".join(b"w%d" % i for i in rng.integers(0, 99, 200)), None]
    words = X.Words(texts)
    idx, of = words.windows()
    x = net.inputs(words, np.arange(len(words.rows)))
    gates = {s: x @ net.w[f"x{s}"] + net.w[f"o{s}"] for s in "fb"}
    want = net.forward(x, idx)
    assert np.allclose(net.scored(x, gates, idx), want, atol=1e-5)
    best = [max(want[of == k]) for k in range(len(texts))]
    assert np.allclose(net.document_logits(texts), best, atol=1e-5)
    # every word begins or stands near the beginning of a window
    starts = {int(i[0]) for i in words.windows(1)[0]}
    assert {int(i[0]) for i in idx} <= starts and len(words.windows(1)[1]) >= 4 * len(idx) - 40
