"""Recommender corpus: star → collapsed titles → descriptions → postings.

The document id is the title's position in the collapsed table ordered by
its ten keys (the order the reference's group-by produces), so "first row
with this name" means the same thing here. The postings table is written
once (``materialize``): every recommendation reads it several times (query
vector, scores), and storing it cuts the TF-IDF lineage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from shelfwise.operators import features as R
from shelfwise.operators.keys import dense_ids
from shelfwise.plans import star as S
from shelfwise.sources.tables import materialize


@dataclass
class Corpus:
    docs: DataFrame       # doc_id, title_name, description, synopsis
    postings: DataFrame   # doc_id, term, tf, weight


def title_docs(star: dict[str, DataFrame]) -> DataFrame:
    """R1-R3 over the collapsed star titles."""
    titles = S.star_titles(star)
    ided = dense_ids(titles, list(S.COLLAPSE_KEYS), "doc_id")
    return (ided.transform(R.normalise_list_text).transform(R.describe)
            .transform(R.project_docs))


def title_corpus(star: dict[str, DataFrame], max_features: int | None = R.MAX_FEATURES,
                 persist: bool = True) -> Corpus:
    docs = title_docs(star)
    postings = R.tfidf(docs, "doc_id", "description", max_features)
    if persist:
        postings = materialize(postings, "postings")
    return Corpus(docs, postings)


def document_corpus(documents: DataFrame, max_features: int | None = R.MAX_FEATURES,
                    persist: bool = True) -> Corpus:
    """TF-IDF over a free-text table (doc_id, text) - the volume corpus."""
    docs = documents.select("doc_id", "text")
    postings = R.tfidf(docs, "doc_id", "text", max_features)
    if persist:
        postings = materialize(postings, "postings")
    return Corpus(docs, postings)
