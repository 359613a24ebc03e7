import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import features as R
from shelfwise.operators import neighbours as N
from shelfwise.plans import recommender as RP
from shelfwise.plans import star as S
from shelfwise.plans.cleaning import clean_titles
from shelfwise.sources import fixtures as fx

from conftest import SF_SMALL


def brute(texts, k):
    docs = {i: Counter(t.split()) for i, t in texts if t}
    df = Counter(w for d in docs.values() for w in d)
    vec = {}
    for i, d in docs.items():
        w = {t: n * (math.log((1 + len(texts)) / (1 + df[t])) + 1) for t, n in d.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        vec[i] = {t: x / norm for t, x in w.items()}
    out = {}
    for i, _ in texts:
        mine = vec.get(i, {})
        scored = [(-round(sum(x * vec.get(j, {}).get(t, 0.0) for t, x in mine.items()), 6), j) for j, _ in texts if j != i]
        out[i] = [(j, -s) for s, j in sorted(scored)[:k]]
    return out


def result(spark, texts, k):
    docs = spark.createDataFrame(texts, "doc_id long, description string")
    postings = R.tfidf(docs, "doc_id", "description", None, stop_words=())
    got = {i: [] for i, _ in texts}
    for r in sorted(N.most_similar(postings, docs, k).collect(), key=lambda r: (r.doc_id, r.rank)):
        got[r.doc_id].append((r.similar_id, r.score))
    return got


@pytest.mark.parametrize("k", [1, 4])
def test_equals_brute_force(spark, k):
    rng = random.Random(k)
    words = [f"w{i}" for i in range(40)]
    texts = [(i, " ".join(["common"] * rng.randint(0, 2) + rng.choices(words, k=rng.randint(1, 8)))) for i in range(60)]
    texts += [(100 + i, "copies of one text w1 w2") for i in range(12)] + [(200, ""), (201, None), (202, "alone here")]
    got, want = result(spark, texts, k), brute(texts, k)
    for i in want:
        assert [s for _, s in got[i]] == pytest.approx([s for _, s in want[i]], abs=2e-6), i
        assert [j for j, _ in got[i]] == [j for j, _ in want[i]], i


def test_fewer_documents_than_k_and_none(spark):
    texts = [(1, "aa bb"), (2, "aa cc"), (3, "dd dd")]
    assert {i: [j for j, _ in x] for i, x in result(spark, texts, 10).items()} == {1: [2, 3], 2: [1, 3], 3: [1, 2]}
    empty = spark.createDataFrame([], "doc_id long, description string")
    assert N.most_similar(R.tfidf(empty, "doc_id", "description", None, stop_words=()), empty, 3).collect() == []


def test_bounds_skip_pairs_of_the_title_corpus(spark):
    corpus = RP.title_corpus(S.build_star(clean_titles(fx.titles_with_duplicates(spark, SF_SMALL))))
    marked = N.prefixes(corpus.postings, N.floors(corpus.postings, 10)).cache()
    met = N.meeting(marked).cache()
    n = corpus.docs.count()
    found, kept = met.count(), met.filter("most >= floor").count()
    assert kept <= found < 0.9 * n * (n - 1) and kept < 0.7 * n * (n - 1)   # ten of 189 titles are many; 0.37 at 1,920
    print(f"pairs {n * (n - 1)}, met by a prefix {found}, scored {kept}")
    # the pairs are pruned by the floors, and the floors are below what is found
    best = N.similar_pairs(corpus.postings, 10)
    low = best.join(N.floors(corpus.postings, 10), "q").groupBy("q").agg(
        F.sum((F.col("score") >= F.col("floor")).cast("int")).alias("n"))
    assert low.filter("n < 10").isEmpty()


def test_blocks_equal_brute_force(spark, monkeypatch):
    """Titles of many blocks, with terms that are dense columns and terms that are not."""
    monkeypatch.setattr(N, "SMALL", 12)
    rng = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    texts = [(i, " ".join(["common"] * rng.randint(0, 2) + rng.choices(words, k=rng.randint(1, 6)))) for i in range(180)]
    docs = spark.createDataFrame(texts, "doc_id long, description string")
    postings = R.tfidf(docs, "doc_id", "description", None, stop_words=())
    assert N._n_blocks(postings) > 8
    got, want = result(spark, texts, 3), brute(texts, 3)
    for i in want:
        assert [s for _, s in got[i]] == pytest.approx([s for _, s in want[i]], abs=2e-6), i
        assert [j for j, _ in got[i]] == [j for j, _ in want[i]], i
    leaving = N.similar_pairs(postings, 3).groupBy("q").count()     # no more than k + 1 a title, not every pair above a floor
    assert leaving.filter("count > 4").isEmpty()


def topics(n, seed):
    """Texts that share rare words with a few others and common words with many."""
    rng = random.Random(seed)
    return [(i, f"t{rng.randrange(n // 12)} r{rng.randrange(n // 6)} c{rng.randrange(9)} "
             + " ".join(rng.choices([f"m{j}" for j in range(12)] + ["common"] * 3, k=rng.randint(0, 3)))) for i in range(n)]


@pytest.mark.parametrize("too_many", [1e9, 0])
def test_bins_equal_brute_force(spark, monkeypatch, too_many):
    """Bins of one term and of several, blocks of a few titles each; and all titles in one bin."""
    for name, value in (("BIN", 8), ("SMALL", 20), ("BLOCK", 30), ("PAIRS_PER_TASK", 2_000), ("TOO_MANY", too_many)):
        monkeypatch.setattr(N, name, value)
    texts = topics(240, 3) + [(300, "alone"), (301, "t1"), (302, ""), (303, None), (304, "common"), (305, "common common c1")]
    got, want = result(spark, texts, 5), brute(texts, 5)
    for i in want:
        assert [s for _, s in got[i]] == pytest.approx([s for _, s in want[i]], abs=2e-6), i
        assert [j for j, _ in got[i]] == [j for j, _ in want[i]], i


def test_few_of_all_pairs_meet(spark, monkeypatch):
    """Titles meet those that can reach their floor, not every block of titles."""
    monkeypatch.setattr(N, "BIN", 8)
    met, tasks = {}, []
    real = N._met

    def seen(vectors, n_blocks):
        asking, answering, n = real(vectors, n_blocks)
        for side, rows in (("asking", asking), ("answering", answering)):
            met[side] = {tuple(r)[:3]: r["count"] for r in rows.groupBy("bin", "i", "j").count().collect()}
        tasks.append(n)
        return asking, answering, n

    monkeypatch.setattr(N, "_met", seen)
    texts = topics(1_200, 5)
    docs = spark.createDataFrame(texts, "doc_id long, description string")
    postings = R.tfidf(docs, "doc_id", "description", None, stop_words=())
    assert N.similar_pairs(postings, 3).groupBy("q").count().filter("count >= 3").count() == len(texts)
    pairs = sum(n * met["answering"].get(unit, 0) for unit, n in met["asking"].items())
    assert len(met["asking"]) > 100 and pairs < 0.1 * len(texts) ** 2
    assert tasks and tasks[0] >= 1
