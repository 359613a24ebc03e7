import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import features as R
from shelfwise.operators import recommend as REC
from shelfwise.plans import recommender as RP
from shelfwise.sources import fixtures as fx

from conftest import SF_SMALL, rows


def _docs(spark, texts):
    return spark.createDataFrame([(i + 1, t) for i, t in enumerate(texts)], "doc_id long, description string")


def test_tfidf_hand_worked(spark):
    # doc1: "apple banana apple", doc2: "banana cherry", doc3: "" (empty), N = 3
    post = R.tfidf(_docs(spark, ["apple banana apple", "banana cherry", ""]), stop_words=[])
    got = {(d, t): w for d, t, _, w in rows(post)}
    idf = lambda df: math.log((1 + 3) / (1 + df)) + 1
    a, b = 2 * idf(1), 1 * idf(2)
    n1 = math.hypot(a, b)
    assert got[(1, "apple")] == pytest.approx(a / n1)
    assert got[(1, "banana")] == pytest.approx(b / n1)
    c, b2 = idf(1), idf(2)
    assert got[(2, "cherry")] == pytest.approx(c / math.hypot(c, b2))
    assert not any(d == 3 for d, _ in got)          # empty document: no postings


def test_tfidf_equal_documents_and_norm(spark):
    post = R.tfidf(_docs(spark, ["red fox jumps", "red fox jumps", "blue whale"]), stop_words=[])
    v1 = {t: w for d, t, _, w in rows(post) if d == 1}
    v2 = {t: w for d, t, _, w in rows(post) if d == 2}
    assert v1 == pytest.approx(v2)
    for _, n in rows(R.doc_norms(post)):
        assert n == pytest.approx(1.0)


def test_tokens_and_stop_words(spark):
    df = _docs(spark, ["The Fox, the ouèan and a  x 24.0 TV"])
    got = sorted(t for _, t, _ in rows(R.tokenize(df)))
    assert got == ["24", "fox", "ouèan", "tv"]   # 'the', 'and', 'a' stopped; 1-char dropped


def test_vocabulary_cap(spark):
    post = R.tfidf(_docs(spark, ["aa bb cc aa", "aa bb dd"]), max_features=2, stop_words=[])
    assert sorted({t for _, t, _, _ in rows(post)}) == ["aa", "bb"]


def test_describe_null_propagates(spark):
    df = spark.createDataFrame([("s", None, 1, "g", 2, "st", 24.0, 3, "PG")],
                               "studio_names string, premiered string, ranking int, genre_names string, "
                               "episodes int, status string, duration_min double, popularity int, rating string")
    assert rows(R.describe(df), "description") == [(None,)]
    df2 = df.fillna({"premiered": "Fall 1990"})
    assert rows(R.describe(df2), "description") == [("s Fall 1990 1 g 2 st 24.0 3 PG",)]


@pytest.fixture(scope="module")
def doc_corpus(spark):
    return RP.document_corpus(fx.table(spark, SF_SMALL, "documents"))


def test_one_vs_all_matches_brute_force(spark, doc_corpus):
    post = doc_corpus.postings.toPandas()
    ids = sorted(r[0] for r in rows(doc_corpus.docs, "doc_id"))
    terms = sorted(post.term.unique())
    m = np.zeros((len(ids), len(terms)))
    ii = {d: i for i, d in enumerate(ids)}
    tt = {t: j for j, t in enumerate(terms)}
    for d, t, w in zip(post.doc_id, post.term, post.weight):
        m[ii[d], tt[t]] = w
    sims = m @ m.T
    q = ids[0]
    query = doc_corpus.postings.filter(F.col("doc_id") == q).select("term", F.col("weight").alias("qw"))
    got = dict(rows(REC.cosine_one_vs_all(doc_corpus.postings, query, doc_corpus.docs.select("doc_id"),
                                          normalise_query=False), "doc_id", "score"))
    assert len(got) == len(ids)
    for d in ids:
        assert got[d] == pytest.approx(sims[ii[q], ii[d]], abs=1e-9)


def test_recommend_contracts(spark):
    post = R.tfidf(_docs(spark, ["aa bb", "aa cc", "dd ee", "aa bb"]), stop_words=[])
    docs = spark.createDataFrame([(1, "One", "s1"), (2, "Two", "s2"), (3, "Three", "s3"), (4, "One", "s4")],
                                 "doc_id long, title_name string, synopsis string")
    with pytest.raises(ValueError):
        REC.recommend_by_title(post, docs, "Nope")
    top = rows(REC.recommend_by_title(post, docs, "One", 10), "doc_id", "score")
    # repeated name: the first id is the query; the other copy ranks first; no-overlap doc scores 0
    assert top[0] == (4, 1.0) and [d for d, _ in top] == [4, 2, 3] and top[-1][1] == 0.0
    with pytest.raises(ValueError):
        REC.recommend_by_list(post, docs, [])
    with pytest.raises(ValueError):
        REC.recommend_by_list(post, docs, ["Drangon Ball"])
    got = rows(REC.recommend_by_list(post, docs, ["One", "Drangon Ball"], 10), "title_name")
    assert ("One",) not in got and len(got) == 2


def test_cosine_symmetric(spark, doc_corpus):
    ids = [r[0] for r in doc_corpus.docs.select("doc_id").orderBy("doc_id").limit(3).collect()]

    def row(q):
        query = doc_corpus.postings.filter(F.col("doc_id") == q).select("term", F.col("weight").alias("qw"))
        return dict(rows(REC.cosine_one_vs_all(doc_corpus.postings, query, doc_corpus.docs.select("doc_id"),
                                               normalise_query=False), "doc_id", "score"))

    sims = {q: row(q) for q in ids}
    for a in ids:
        for b in ids:
            assert sims[a][b] == pytest.approx(sims[b][a], abs=1e-12)


def test_term_counts_are_read_for_the_vocabulary_and_for_the_weights_alone(spark):
    post = R.tfidf(_docs(spark, ["aa bb", "aa cc", "dd ee", "aa bb"]), max_features=3, stop_words=[])
    plan = post._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2     # not once more, twice over, for the document frequencies
