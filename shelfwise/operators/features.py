"""Text features: list normalisation, descriptions, tokens, TF-IDF.

Vectors are kept in long form - one posting ``(doc_id, term, tf, weight)``
per non-zero entry - so every step is a join or an aggregate that Spark
partitions and combines map-side:

* term counts: ``groupBy(doc_id, term)``; a document never spans tasks at the
  scan, so the partial aggregate already emits final counts per task. The
  counts are written once, so the text is read and tokenised in one pass.
* vocabulary: ``groupBy(term).sum`` (a term found in every document is one
  row per map task after the partial combine), then a top-n of at most
  ``max_features`` rows - a proven bound, hence broadcast.
* idf: the document frequency comes with the vocabulary, from the same
  aggregate (≤ ``max_features`` rows, broadcast); the corpus size N is a scalar subquery, not a cross join.
* L2 norm: a window per document; a document has at most ``max_features``
  postings, so no window group is unbounded.

Weighting is the smooth-idf form: ``w = tf * (ln((1 + N) / (1 + df)) + 1)``,
then divided by the document's L2 norm (documents without kept terms have no
postings). Spark ML's ``IDF`` omits the ``+ 1`` and is not used as is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import text
from shelfwise.sources.tables import materialize

# --- fixed values that must equal the reference's -----------------------
MAX_FEATURES = 1500          # vocabulary cap
DESCRIPTION_FIELDS = ("studio_names", "premiered", "ranking", "genre_names", "episodes", "status",
                      "duration_min", "popularity", "rating")   # joined by ' ' in this order
# -------------------------------------------------------------------------


def normalise_list_text(df: DataFrame, cols: Sequence[str] = ("genre_names", "studio_names")) -> DataFrame:
    """Lower-case, ',' → ' ', NULL → ''."""
    return df.withColumns({c: text.normalise_list_text(F.col(c)) for c in cols})


def describe(df: DataFrame, out: str = "description") -> DataFrame:
    """R2: the nine fields joined by single spaces. ``concat`` propagates
    NULL like the reference's string ``+`` does; numbers are cast to text."""
    parts = []
    for i, c in enumerate(DESCRIPTION_FIELDS):
        if i:
            parts.append(F.lit(" "))
        parts.append(F.col(c).cast("string"))
    return df.withColumn(out, F.concat(*parts))


def project_docs(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc id, name, description, synopsis)."""
    return df.select(id_col, "title_name", "description", "synopsis")


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "description",
             stop_words: Sequence[str] | None = None) -> DataFrame:
    """(doc_id, term, tf) - lower-cased word runs of ≥ 2 word characters,
    stop words removed (an in-set filter, no join), counted per document."""
    stops = list(text.default_stop_words() if stop_words is None else stop_words)
    docs = docs.select(id_col, text_col)
    toks = docs.select(id_col, F.explode(text.tokens(F.col(text_col))).alias("term"))
    if stops:
        toks = toks.filter(~F.col("term").isin(stops))
    return toks.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary_topn(counts: DataFrame, max_features: int | None = MAX_FEATURES, with_df: bool = False) -> DataFrame:
    """Terms with the highest corpus count (ties: term order), as
    (term, total). ``None`` keeps every term. ``with_df`` adds the document
    frequency ``df`` from the same aggregate."""
    df = [F.count(F.lit(1)).alias("df")] if with_df else []
    totals = counts.groupBy("term").agg(F.sum("tf").alias("total"), *df)
    if max_features is None:
        return totals
    return totals.orderBy(F.col("total").desc(), F.col("term")).limit(max_features)


def tfidf(docs: DataFrame, id_col: str = "doc_id", text_col: str = "description",
          max_features: int | None = MAX_FEATURES, stop_words: Sequence[str] | None = None) -> DataFrame:
    """Unit-length TF-IDF postings (doc_id, term, tf, weight)."""
    # The text is tokenised once: the compact (doc, term, tf) counts are
    # written to the checkpoint folder and every later step (vocabulary,
    # document frequency, weights) reads them, instead of re-scanning and
    # re-tokenising the text in each branch of the plan.
    counts = materialize(tokenize(docs, id_col, text_col, stop_words), "term_counts")
    vocab = vocabulary_topn(counts, max_features, with_df=True).select("term", "df")
    if max_features is not None:
        vocab = F.broadcast(vocab)  # at most max_features rows
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    raw = counts.join(vocab, "term").withColumn("w", F.col("tf") * idf)
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return raw.select(id_col, "term", "tf", (F.col("w") / norm).alias("weight"))


def doc_norms(postings: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per-document L2 norm of a postings table (1.0 after ``tfidf``)."""
    return postings.groupBy(id_col).agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"))
