"""Raw title rows from both crawl variants, and their union.

The two crawlers fill the same wide table from different page shapes:

* crawl 1 reads the listing row (name, score, rank text) and, per label,
  the first block containing it (text after the label, or its digits);
  missing text fields are 'N/A', numbers that are not all digits are NULL;
* crawl 2 splits every block on ':' (last key wins), merges genre-like
  keys, strips '#' from rank/popularity and parses '1,234'-style numbers.

Both become the raw schema (numbers cast, D15) with a ``source`` tag, and
``union_crawls`` stacks them by column name. Each record is one ``groupBy``
over the label blocks joined 1:1 to the listing rows by title key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import parse
from shelfwise.functions.text import html_text
from shelfwise.operators import extract as X
from shelfwise.sources.tables import materialize

RAW_COLUMNS = ("title_id", "title_name", "score", "ranking", "genres", "media_type", "studio", "premiered",
               "synopsis", "episodes", "status", "duration", "popularity", "rating", "members", "favorites")


def listing_rows(titles: DataFrame) -> DataFrame:
    """The listing-page view of titles: name, score and rank as page text."""
    return titles.select("title_id", "title_name", F.col("score").cast("string").alias("score_text"),
                         F.col("ranking").cast("string").alias("rank_text"), "genres", "synopsis")


# --- fixed values: where the detail page keeps its fields ------------------
NAME_CLASS, SCORE_CLASS, RANK_CLASS, BLOCK_CLASS = "title-name", "score-label", "top-anime-rank-text", "spaceit_pad"
GENRE_ATTRS, SYNOPSIS_ATTRS = {"itemprop": "genre"}, {"itemprop": "description"}
# ---------------------------------------------------------------------------


def page_listing(pages: DataFrame) -> DataFrame:
    """The listing fields of stored detail pages (page_id, html): name, score,
    rank, genre spans and synopsis, each picked by class or attribute (X3, X4)."""
    return pages.select(
        F.col("page_id").alias("title_id"),
        X.first_text("html", "h1", cls=NAME_CLASS).alias("title_name"),
        X.first_text("html", "div", cls=SCORE_CLASS).alias("score_text"),
        X.first_text("html", "span", cls=RANK_CLASS).alias("rank_text"),
        F.nullif(X.joined_matches("html", "span", attrs=GENRE_ATTRS), F.lit("")).alias("genres"),
        X.first_text("html", "p", attrs=SYNOPSIS_ATTRS).alias("synopsis"))


def page_blocks(pages: DataFrame) -> DataFrame:
    """The label blocks of stored detail pages: (title_id, pos, text)."""
    blocks = X.rows_of_page(pages, "div", BLOCK_CLASS)
    return blocks.select(F.col("page_id").alias("title_id"), "pos", html_text("block").alias("text"))


def crawl_pages(pages: DataFrame) -> DataFrame:
    """Stored detail pages to raw title rows, by both crawlers' rules (U1). The fields and blocks of a page are
    stored, as both crawlers read them."""
    listing, blocks = materialize(page_listing(pages), "page-listing"), materialize(page_blocks(pages), "page-blocks")
    return union_crawls(crawl1_records(listing, blocks), crawl2_records(listing, blocks))


def crawl1_records(listing: DataFrame, blocks: DataFrame) -> DataFrame:
    rec = listing.join(X.label_fields(blocks).drop(*X.DIGIT_LABELS), "title_id", "left")
    rec = rec.fillna(X.MISSING_TEXT, list(X.TEXT_LABELS))   # a page without any block
    return rec.select(
        "title_id", "title_name",
        parse.float_guarded("score_text").alias("score"),
        parse.int_digits("rank_text").alias("ranking"),
        "genres", "media_type", "studio", "premiered",
        F.coalesce("synopsis", F.lit(X.MISSING_TEXT)).alias("synopsis"),
        F.col("episodes_int").alias("episodes"), "status", "duration",
        F.col("popularity_int").alias("popularity"), "rating",
        F.col("members_int").alias("members"), F.col("favorites_int").alias("favorites"),
        F.lit(1).alias("source"))


def crawl2_records(listing: DataFrame, blocks: DataFrame) -> DataFrame:
    rec = X.convert_counts(X.pivot_blocks(X.kv_blocks(blocks)))
    joined = listing.select("title_id", "title_name", "score_text", "synopsis").join(rec, "title_id", "left")
    ints = {c: F.col(c).try_cast("int") for c in X.COMMA_INT_FIELDS}
    return joined.withColumns(ints).select(
        "title_id", "title_name", parse.float_guarded("score_text").alias("score"), "ranking", "genres",
        "media_type", "studio", "premiered", "synopsis", "episodes", "status", "duration", "popularity",
        "rating", "members", "favorites", F.lit(2).alias("source"))


def union_crawls(*records: DataFrame) -> DataFrame:
    """Stack crawl outputs by column name."""
    out = records[0]
    for r in records[1:]:
        out = out.unionByName(r)
    return out
