"""

``(spark, sf_dir) -> DataFrame``; ``oracle_sql()`` gives the DuckDB SQL that
must return the same rows (same column names). Every query reads the driver's
tables (or fixture views Spark derives from them), whole.
"""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfwise.functions import parse  # noqa: E402
from shelfwise.functions.text import html_text  # noqa: E402
from shelfwise.operators import clean, constraints  # noqa: E402
from shelfwise.operators import normalize as N  # noqa: E402
from shelfwise.operators.keys import dense_ids  # noqa: E402
from shelfwise.operators import extract as X  # noqa: E402
from shelfwise.operators import features as R  # noqa: E402
from shelfwise.operators import ingest, marts, neighbours  # noqa: E402
from shelfwise.operators import recommend as REC  # noqa: E402
from shelfwise.plans import crawl  # noqa: E402
from shelfwise.plans import recommender as RP  # noqa: E402
from shelfwise.plans import star as S  # noqa: E402
from shelfwise.plans.cleaning import clean_titles  # noqa: E402
from shelfwise.plans.star_delta import StarStore  # noqa: E402
from shelfwise.sources import fixtures as fx  # noqa: E402
from shelfwise.sources import snapshots, tables  # noqa: E402
from shelfwise.streaming import incremental, upserts  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


def _q_clean_titles(spark, d):
    return clean_titles(fx.titles_with_duplicates(spark, d))


def _q_drop_blank_rows(spark, d):
    return clean.drop_blank_rows(fx.titles_raw(spark, d))


def _q_fill_missing(spark, d):
    return fx.titles_raw(spark, d).transform(clean.trim_column).transform(clean.fill_missing)


def _q_parse_duration(spark, d):
    return clean.parse_duration(fx.titles_raw(spark, d)).select("title_id", "duration", "duration_min")


def _q_impute_duration(spark, d):
    df = (fx.titles_with_duplicates(spark, d).transform(clean.drop_blank_rows)
          .transform(clean.trim_column).transform(clean.fill_missing)
          .transform(clean.parse_duration).transform(clean.impute_duration))
    return df.select("title_id", "episodes", "duration", "duration_min")


def _q_collapse_rating(spark, d):
    return clean.collapse_rating(fx.titles_raw(spark, d)).select("title_id", "rating")


def _q_dedupe_by_key(spark, d):
    return clean.dedupe_by_key(fx.titles_with_duplicates(spark, d))


def _clean(spark, d):
    return clean_titles(fx.titles_with_duplicates(spark, d))


def _star(spark, d):
    return S.build_star(_clean(spark, d))


def _star_table(name):
    return lambda spark, d: _star(spark, d)[name]


def _q_attach_stats_key(spark, d):
    c = _clean(spark, d)
    stats = N.project_stats(c)
    return N.attach_stats_key(c.select("title_id", *N.STAT_COLS), stats).select("title_id", "statistic_id")


def _q_check_length(spark, d):
    st = _star(spark, d)
    g = constraints.check_length(st["genre"], "genre_name", constraints.GENRE_NAME_MAX)
    s = constraints.check_length(st["studio"], "studio_name", constraints.STUDIO_NAME_MAX)
    return (g.select(F.lit("genre").alias("kind"), F.col("genre_name").alias("name"))
            .unionByName(s.select(F.lit("studio").alias("kind"), F.col("studio_name").alias("name")))
            .withColumn("len", F.length("name")))


def _title_docs_norm(spark, d):
    titles = S.star_titles(_star(spark, d))
    return dense_ids(titles, list(S.COLLAPSE_KEYS), "doc_id").transform(R.normalise_list_text)


def _corpus(spark, d):
    return RP.title_corpus(_star(spark, d))


def _doc_corpus(spark, d):
    return RP.document_corpus(_documents(spark, d))


def _round_weight(df, col="weight"):
    return df.withColumn(col, F.round(col, 6))


def _q_recommend_by_title(spark, d):
    c = _corpus(spark, d)
    title = c.docs.filter(F.col("doc_id") == 1).select("title_name").first()[0]
    return REC.recommend_by_title(c.postings, c.docs, title, 10)


def _list_names(c):
    rows = c.docs.filter(F.col("doc_id").isin(1, 2, 3)).orderBy("doc_id").select("title_name").collect()
    names = [r[0] for r in rows]
    return names[:2] + names[1:2] + names[2:] + ["no such title"]


def _q_recommend_by_list(spark, d):
    c = _corpus(spark, d)
    return REC.recommend_by_list(c.postings, c.docs, _list_names(c), 10)


def _q_mean_vector(spark, d):
    c = _corpus(spark, d)
    wanted = spark.createDataFrame([(n,) for n in _list_names(c)], "title_name string")
    ids = wanted.join(REC.title_lookup(c.docs), "title_name").select("doc_id")
    return _round_weight(REC.mean_vector(c.postings, ids), "qw")


def _q_cosine_one_vs_all(spark, d):
    c = _doc_corpus(spark, d)
    first = c.docs.agg(F.min("doc_id").alias("doc_id"))
    query = c.postings.join(first, "doc_id").select("term", F.col("weight").alias("qw"))
    scored = REC.cosine_one_vs_all(c.postings, query, c.docs.select("doc_id"), normalise_query=False)
    return _round_weight(scored, "score")


def _pages(spark, d):
    return tables.spread(fx.table(spark, d, "pages"), spark.sparkContext.defaultParallelism)


def _documents(spark, d):
    return tables.spread(fx.table(spark, d, "documents"), spark.sparkContext.defaultParallelism)


def _kv(spark, d):
    return X.kv_blocks(fx.info_blocks(spark, d))


def _q_to_float_guarded(spark, d):
    return _kv(spark, d).select("title_id", "pos", "value", parse.float_guarded("value").alias("as_float"),
                                parse.int_digits("value").alias("as_int"))


def _q_union_crawls(spark, d):
    listing = crawl.listing_rows(fx.titles_raw(spark, d))
    blocks = fx.info_blocks(spark, d)
    return crawl.union_crawls(crawl.crawl1_records(listing, blocks), crawl.crawl2_records(listing, blocks))


def _q_avg_by_key(spark, d):
    df = (fx.titles_with_duplicates(spark, d).transform(clean.drop_blank_rows).transform(clean.trim_column)
          .transform(clean.fill_missing).transform(clean.parse_duration))
    return clean.avg_by_key(df, "duration_min", "episodes", "avg_minutes")


def _q_profile(spark, d):
    return tables.profile_frame(fx.titles_raw(spark, d)).drop("data_type")


def _q_append_rows(spark, d):
    path = tables.shared_path(spark, "append")
    tables.append_rows(fx.titles_stored(spark, d), path)
    tables.append_rows(fx.titles_arriving(spark, d), path)
    return spark.read.parquet(path)


def _q_csv_export(spark, d):
    df = fx.titles_raw(spark, d)
    path = tables.shared_path(spark, "csv")
    tables.csv_export(df, path)
    return spark.read.options(**tables.CSV_OPTIONS).schema(df.schema).csv(path)


def _q_select_into(spark, d):
    return tables.select_into(fx.titles_raw(spark, d).filter("score IS NOT NULL"),
                              tables.shared_path(spark, "into"))


def _q_insert_select(spark, d):
    path = tables.shared_path(spark, "insert")
    tables.select_into(fx.titles_stored(spark, d).select("title_name", "title_id"), path)
    tables.insert_select(fx.titles_arriving(spark, d), path)
    return spark.read.parquet(path)


def _q_similar_titles(spark, d):
    c = _corpus(spark, d)
    return neighbours.most_similar(c.postings, c.docs, 10)


def _two_loads(spark, d):
    """A star store after the first and the second load."""
    store = StarStore(tables.shared_path(spark, "star-store"), buckets=8)
    clean = tables.materialize(_clean(spark, d), "clean")
    for load, sql in enumerate((fx.CLEAN_FIRST_SQL, fx.CLEAN_SECOND_SQL)):
        store.apply(spark.sql(sql, clean=clean), load)
    return store.star(spark)


def _q_stable_ids(spark, d):
    star = _two_loads(spark, d)
    parts = [star[name].select(F.lit(name).alias("dim"), F.col(id_col).alias("id"), F.col(name).alias("value"))
             for name, id_col in S.DIMENSIONS]
    parts += [star[dim].select(F.lit(dim).alias("dim"), F.col(f"{dim}_id").alias("id"), F.col(f"{dim}_name").alias("value"))
              for dim, _ in S.LIST_DIMS]
    parts.append(star["statistic"].select(F.lit("statistic").alias("dim"), F.col("statistic_id").alias("id"),
                                          F.col("title_id").cast("string").alias("value")))
    return reduce(DataFrame.unionByName, parts)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_titles": _q_clean_titles,
    "drop_blank_rows": _q_drop_blank_rows,
    "fill_missing": _q_fill_missing,
    "parse_duration": _q_parse_duration,
    "impute_duration": _q_impute_duration,
    "collapse_rating": _q_collapse_rating,
    "dedupe_by_key": _q_dedupe_by_key,
    # normalisation (star)
    "project_core": lambda spark, d: N.project_core(_clean(spark, d)),
    "project_stats": _star_table("statistic"),
    "surrogate_key": lambda spark, d: dense_ids(_clean(spark, d).select("title_id"), ["title_id"], "id"),
    "distinct_dimension": _star_table("premiered"),
    "star_rating": _star_table("rating"),
    "star_media_type": _star_table("media_type"),
    "attach_dimension_key": _star_table("title"),
    "split_distinct": _star_table("genre"),
    "star_studio": _star_table("studio"),
    "bridge_genres": _star_table("title_genre"),
    "bridge_studios": _star_table("title_studio"),
    "attach_stats_key": _q_attach_stats_key,
    "star_titles": lambda spark, d: S.star_titles(_star(spark, d)),
    # constraints
    "check_score": lambda spark, d: constraints.check_score(fx.titles_with_violations(spark, d)),
    "check_ranking": lambda spark, d: constraints.check_ranking(fx.titles_with_violations(spark, d)),
    "check_counts": lambda spark, d: constraints.check_counts(fx.titles_with_violations(spark, d)),
    "violations": lambda spark, d: constraints.violations(fx.titles_with_violations(spark, d)),
    "check_primary_key": lambda spark, d: constraints.check_primary_key(
        fx.titles_with_duplicates(spark, d), "title_id"),
    "check_foreign_key": lambda spark, d: constraints.check_foreign_key(
        fx.titles_changed(spark, d), "title_id", fx.titles_raw(spark, d), "title_id"),
    "check_length": _q_check_length,
    # text features and recommendations
    "normalise_list_text": lambda spark, d: _title_docs_norm(spark, d).select(
        "doc_id", "genre_names", "studio_names"),
    "describe": lambda spark, d: RP.title_docs(_star(spark, d)),
    "tfidf": lambda spark, d: _round_weight(_corpus(spark, d).postings),
    "title_lookup": lambda spark, d: REC.title_lookup(RP.title_docs(_star(spark, d))),
    "tokenize": lambda spark, d: R.tokenize(_documents(spark, d), text_col="text"),
    "vocabulary_topn": lambda spark, d: R.vocabulary_topn(
        R.tokenize(_documents(spark, d), text_col="text")),
    "tfidf_documents": lambda spark, d: _round_weight(_doc_corpus(spark, d).postings),
    "cosine_one_vs_all": _q_cosine_one_vs_all,
    "recommend_by_title": _q_recommend_by_title,
    "recommend_by_list": _q_recommend_by_list,
    "mean_vector": _q_mean_vector,
    # dashboard marts
    "popular_genres": lambda spark, d: marts.popular_genres(_star(spark, d)),
    "studio_output": lambda spark, d: marts.studio_output(_star(spark, d)),
    "score_distribution": lambda spark, d: marts.score_distribution(_star(spark, d)),
    "episode_distribution": lambda spark, d: marts.episode_distribution(_star(spark, d)),
    # page extraction
    "rows_of_page": lambda spark, d: X.rows_of_page(_pages(spark, d)),
    "links_of_page": lambda spark, d: X.links_of_page(_pages(spark, d)),
    "listing_links": lambda spark, d: X.listing_links(_pages(spark, d)),
    "first_text": lambda spark, d: X.page_fields(_pages(spark, d)),
    "text_after_label": lambda spark, d: X.text_after_label(fx.info_blocks(spark, d)),
    "digits_only": lambda spark, d: X.digits_after_label(fx.info_blocks(spark, d)),
    "kv_blocks": _kv,
    "pivot_blocks": lambda spark, d: X.pivot_blocks(_kv(spark, d)),
    "to_int_commas": lambda spark, d: X.convert_counts(X.pivot_blocks(_kv(spark, d))),
    "to_float_guarded": _q_to_float_guarded,
    # ingestion, snapshots, profile
    "insert_if_absent": lambda spark, d: ingest.insert_if_absent(
        fx.titles_arriving(spark, d), fx.titles_stored(spark, d)),
    "count_matches": lambda spark, d: ingest.count_matches(
        fx.titles_stored(spark, d), fx.titles_arriving(spark, d)),
    "differential_snapshot": lambda spark, d: snapshots.differential_snapshot(
        fx.titles_raw(spark, d), fx.titles_changed(spark, d)).filter("op <> 'K'"),   # the changes alone
    "profile_frame": _q_profile,
    # single operators
    "scan_table": lambda spark, d: tables.scan_table(spark, f"{d}/part.parquet")
    .select("p_partkey", "p_name", "p_size"),
    "trim_column": lambda spark, d: clean.trim_column(fx.titles_raw(spark, d)).select("title_id", "studio"),
    "avg_by_key": _q_avg_by_key,
    "union_crawls": _q_union_crawls,
    "crawl_pages": lambda spark, d: crawl.crawl_pages(fx.detail_pages(spark, d)),
    "apply_differential": lambda spark, d: snapshots.apply_differential(
        fx.titles_raw(spark, d), snapshots.differential_snapshot(fx.titles_raw(spark, d), fx.titles_changed(spark, d))),
    # sinks: written, then read back
    "append_rows": _q_append_rows,
    "csv_export": _q_csv_export,
    "select_into": _q_select_into,
    "insert_select": _q_insert_select,
    "backfill": lambda spark, d: clean.backfill(fx.titles_raw(spark, d), clean.fill_missing, clean.parse_duration),
    "add_column": lambda spark, d: N.add_column(fx.titles_raw(spark, d), "note", "string"),
    # inputs that reach rules the plain titles do not
    "listing_links_stop": lambda spark, d: X.listing_links(fx.listing_pages(spark, d)),
    "nested_blocks": lambda spark, d: X.rows_of_page(fx.nested_pages(spark, d), "div", "spaceit_pad").select(
        "page_id", "pos", html_text("block").alias("text")),
    "nested_fields": lambda spark, d: fx.nested_pages(spark, d).select(
        "page_id", X.first_text("html", "div", attrs={"id": "w"}).alias("first"), X.joined_matches("html", "li").alias("joined")),
    "links_by_class": lambda spark, d: X.links_of_page(fx.nested_pages(spark, d), cls="hover"),
    "nested_listing_links": lambda spark, d: X.listing_links(fx.nested_pages(spark, d)),
    "check_length_long": lambda spark, d: constraints.check_length(
        fx.long_names(spark, d), "name", constraints.STUDIO_NAME_MAX),
    "check_primary_key_null": lambda spark, d: constraints.check_primary_key(
        fx.titles_raw(spark, d), "title_name"),
    # micro-batch streaming, run to completion (available-now)
    "incremental_clean": lambda spark, d: incremental.stream_clean(fx.titles_raw(spark, d)),
    "incremental_ingest": lambda spark, d: incremental.stream_ingest(
        fx.titles_stored(spark, d), fx.titles_arriving(spark, d)),
    "incremental_update": lambda spark, d: upserts.stream_update(
        fx.titles_raw(spark, d), fx.titles_updates(spark, d), buckets=8),
    # changes over several loads
    "stable_ids": _q_stable_ids,
    "incremental_star": lambda spark, d: S.star_titles(_two_loads(spark, d), by_id=True),
    # every title's most similar ones
    "similar_titles": _q_similar_titles,
}


def entry(spark: SparkSession) -> DataFrame:
    return _q_clean_titles(spark, SMOKE_DIR)


def _has_llm() -> bool:
    """Whether the optional subpackage and its pipeline are there (both can be deleted)."""
    return bool(importlib.util.find_spec("shelfwise.llm") and importlib.util.find_spec("corpus_pipeline"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = dict(_QUERIES)
    if _has_llm():
        import corpus_pipeline
        from shelfwise.llm.queries import QUERIES

        found |= QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    from oracle_queries import ORACLE

    found = {k: v for k, v in ORACLE.items() if k in _QUERIES}
    if _has_llm():
        from shelfwise.llm.queries import ORACLE_SQL

        found |= ORACLE_SQL
    return found


__all__ = ["entry", "queries", "oracle_sql"]
