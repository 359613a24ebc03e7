"""Build the normalised star from the cleaned wide table, and read it back.

``write_star`` is the batch job: the cleaned table is written once (lineage
cut, executor loss only recomputes from that table), the dimensions are
written and read back before the title and bridge tables join them, so every
foreign key refers to ids that exist on storage. ``build_star`` does the same
under the session's checkpoint folder (or returns lazy plans on request) and
``read_star`` gives the nine logical tables of a stored star.

``star_titles`` is the star join (J1) followed by the per-title collapse (A2)
the recommender reads. The reference's join fans out genres × studios per
title and then groups it back; here both lists are aggregated in one tagged
pass and folded into two columns, so no per-title cross product is formed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import normalize as N
from shelfwise.operators.keys import dense_ids
from shelfwise.session import ensure_checkpoint_dir
from shelfwise.sources.tables import materialize

STAR_TABLES = ("title", "statistic", "premiered", "rating", "media_type",
               "genre", "title_genre", "studio", "title_studio")

DIMENSIONS = (("premiered", "premiered_id"), ("rating", "rating_id"), ("media_type", "media_type_id"))
LIST_DIMS = (("genre", "genres"), ("studio", "studio"))   # (dimension, comma-list column)

# The ten grouping keys of the collapse (A2), in the reference's order.
COLLAPSE_KEYS = ("title_name", "synopsis", "episodes", "status", "duration_min", "rating",
                 "premiered", "media_type", "ranking", "popularity")


def _tagged_values(clean: DataFrame) -> DataFrame:
    """(dim, value) for every dimension: plain columns and split lists."""
    parts = [clean.select(F.lit(name).alias("dim"), F.col(name).alias("value")).where(F.col(name).isNotNull())
             for name, _ in DIMENSIONS]
    parts += [N.split_values(clean, col).select(F.lit(dim).alias("dim"), "value") for dim, col in LIST_DIMS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dimension_table(clean: DataFrame) -> DataFrame:
    """(dim, id, value) for all five dimensions from one distinct + one
    dense-id pass; ids restart per dimension, ordered by value."""
    return dense_ids(_tagged_values(clean).distinct(), ["value"], "id", group_cols=["dim"]).select(
        "dim", "id", "value")


def split_dimensions(dimension: DataFrame) -> dict[str, DataFrame]:
    """The five logical dimension tables of a (dim, id, value) table (a
    partition filter each when the table is stored partitioned by dim)."""
    dims = {}
    for name, id_col in DIMENSIONS:
        dims[name] = dimension.filter(F.col("dim") == name).select(F.col("id").alias(id_col),
                                                                   F.col("value").alias(name))
    for dim, _ in LIST_DIMS:
        dims[dim] = dimension.filter(F.col("dim") == dim).select(F.col("id").alias(f"{dim}_id"),
                                                                 F.col("value").alias(f"{dim}_name"))
    return dims


def build_dimensions(clean: DataFrame) -> dict[str, DataFrame]:
    return split_dimensions(dimension_table(clean))


def bridge_table(clean: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """(dim, bridge_id, title_id, ref_id) for both title × list bridges in one
    dense-id pass; ids restart per bridge, ordered by title and position."""
    parts = []
    for dim, col in LIST_DIMS:
        d = dims[dim].select(F.col(f"{dim}_id").alias("ref_id"), F.col(f"{dim}_name").alias("value"))
        parts.append(N.split_values(clean, col).join(d, "value").select(F.lit(dim).alias("dim"), "title_id",
                                                                         "pos", "ref_id"))
    ided = dense_ids(parts[0].unionByName(parts[1]), ["title_id", "pos"], "bridge_id", group_cols=["dim"])
    return ided.select("dim", "bridge_id", "title_id", "ref_id")


def split_bridges(bridges: DataFrame) -> dict[str, DataFrame]:
    out = {}
    for dim, _ in LIST_DIMS:
        out[f"title_{dim}"] = bridges.filter(F.col("dim") == dim).select(
            F.col("bridge_id").alias(f"title_{dim}_id"), "title_id", F.col("ref_id").alias(f"{dim}_id"))
    return out


def build_bridges(clean: DataFrame, dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return split_bridges(bridge_table(clean, dims))


def build_title_stats(clean: DataFrame, dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    stats = N.project_stats(clean)
    title = clean.select(*N.CORE_COLS, *[n for n, _ in DIMENSIONS])
    for name, id_col in DIMENSIONS:
        title = N.attach_dimension_key(title, dims[name], name, id_col)
    title = title.join(stats.select("title_id", "statistic_id"), "title_id", "left")
    return {
        "statistic": stats.select("statistic_id", *N.STAT_COLS, "title_id"),
        "title": title.select(*N.CORE_COLS, "statistic_id", "premiered_id", "rating_id", "media_type_id"),
    }


def build_facts(clean: DataFrame, dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {**build_title_stats(clean, dims), **build_bridges(clean, dims)}


def build_star(clean: DataFrame, stored: bool = True) -> dict[str, DataFrame]:
    """The nine star tables.

    By default the star is written under the session's checkpoint folder
    (``write_star``) and read back: every table then is a plain scan, so a
    query over the star plans and runs on stored tables instead of
    re-expanding the id-assignment subtrees at each reference (one star
    query went from 62 shuffles in its plan to a handful). ``stored=False``
    gives the lazy plans (the cleaned input is still materialised once)."""
    if stored:
        base = ensure_checkpoint_dir(clean.sparkSession).rstrip("/")
        return write_star(clean, f"{base}/shelfwise/star-{uuid.uuid4().hex}")
    clean = materialize(clean, "clean")
    dims = build_dimensions(clean)
    return {**dims, **build_facts(clean, dims)}


STORED = ("clean", "dimension", "statistic", "title", "title_list")


def write_star(clean: DataFrame, out_dir: str, mode: str = "overwrite") -> dict[str, DataFrame]:
    """Materialise the star under ``out_dir`` (S6) and return its nine tables.

    Stored as five parquet tables: the cleaned input, one dimension table
    partitioned by ``dim`` (premiered, rating, media_type, genre, studio),
    statistic, title, and one bridge table partitioned by ``dim`` (genre,
    studio). Dimensions are written and read back before the title and
    bridge tables join them, so every foreign key refers to stored ids."""
    spark = clean.sparkSession
    clean.write.mode(mode).parquet(f"{out_dir}/clean")
    clean = spark.read.parquet(f"{out_dir}/clean")
    dimension_table(clean).write.mode(mode).partitionBy("dim").parquet(f"{out_dir}/dimension")
    dims = split_dimensions(spark.read.parquet(f"{out_dir}/dimension"))
    for name, df in build_title_stats(clean, dims).items():
        df.write.mode(mode).parquet(f"{out_dir}/{name}")
    bridge_table(clean, dims).write.mode(mode).partitionBy("dim").parquet(f"{out_dir}/title_list")
    return read_star(spark, out_dir)


def read_star(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The nine logical star tables of a stored star."""
    return {**split_dimensions(spark.read.parquet(f"{out_dir}/dimension")),
            "statistic": spark.read.parquet(f"{out_dir}/statistic"),
            "title": spark.read.parquet(f"{out_dir}/title"),
            **split_bridges(spark.read.parquet(f"{out_dir}/title_list"))}


def star_core(star: dict[str, DataFrame]) -> DataFrame:
    """Title rows with their dimension values; inner joins, so a title with a
    NULL or dangling foreign key drops out (as in the reference's query). Rows
    with a NULL collapse key are left out too. The synopsis comes as its SHA-256
    (``_synopsis``): grouping needs its identity alone, and no shuffle its text."""
    t = (star["title"].dropna(subset=["title_name", "synopsis", "episodes", "status", "duration_min"])
         .withColumn("_synopsis", F.sha2("synopsis", 256)).drop("synopsis"))
    return (t.join(star["rating"], "rating_id")
            .join(star["statistic"].select("statistic_id", "ranking", "popularity")
                  .dropna(subset=["ranking", "popularity"]), "statistic_id")
            .join(star["premiered"], "premiered_id")
            .join(star["media_type"], "media_type_id")
            .dropna(subset=["rating", "premiered", "media_type"])
            .select("title_id", *["_synopsis" if k == "synopsis" else k for k in COLLAPSE_KEYS]))


def star_titles(star: dict[str, DataFrame], by_id: bool = False) -> DataFrame:
    """J1 + A2: one row per distinct 10-key tuple with its genre and studio
    names joined by ', '. Rows with a NULL key vanish (the reference's group-by
    default); titles without any genre or studio drop out (inner joins).
    ``by_id=True`` adds ``title_id`` to the keys, so equal-looking titles with
    different ids are not merged (the reference merges them).

    Plan: both lists as one tagged (kind, title, bridge id, name) frame; the
    titles that have both kinds (the inner-join rule) from one small per-title
    aggregate. A group is its keys' SHA-256 (``_group``), so the two passes over
    the list rows move a digest and not ten keys a row: per (group, kind, name)
    the first bridge id (partial aggregate, so a list is bounded by the distinct
    names), then both ordered lists per group. The keys and the synopsis join last,
    from one title of the group, so they are shuffled once at most.
    The genre × studio product is never formed."""
    keys = ["_synopsis" if k == "synopsis" else k for k in COLLAPSE_KEYS]
    pairs = None
    for dim, _ in LIST_DIMS:
        p = (star[f"title_{dim}"].join(star[dim], f"{dim}_id")
             .select(F.lit(dim).alias("kind"), "title_id", F.col(f"title_{dim}_id").alias("bid"),
                     F.col(f"{dim}_name").alias("name")))
        pairs = p if pairs is None else pairs.unionByName(p)
    has = [F.max((F.col("kind") == dim).cast("int")).alias(f"_has_{dim}") for dim, _ in LIST_DIMS]
    both = (pairs.groupBy("title_id").agg(*has)
            .filter(" AND ".join(f"_has_{dim} = 1" for dim, _ in LIST_DIMS)).select("title_id"))
    core = (star_core(star).join(both, "title_id", "left_semi")
            .withColumn("_group", _digest(keys + (["title_id"] if by_id else []))))
    first = pairs.join(core.select("title_id", "_group"), "title_id").groupBy("_group", "kind", "name").agg(
        F.min("bid").alias("bid"), F.min("title_id").alias("title_id"))
    lists = first.groupBy("_group").agg(
        F.min("title_id").alias("title_id"),
        *[_ordered_names(F.col("kind") == dim).alias(f"{dim}_names") for dim, _ in LIST_DIMS])
    texts = star["title"].select("title_id", "synopsis")
    return lists.join(core, ["title_id", "_group"]).join(texts, "title_id").select(
        *(["title_id"] if by_id else []), *COLLAPSE_KEYS, *[f"{dim}_names" for dim, _ in LIST_DIMS])


def _digest(keys: list[str]) -> Column:
    """SHA-256 of non-NULL key columns (-0.0 as 0.0, as grouping has them)."""
    plain = [(F.when(F.col(k) == 0, F.lit(0)).otherwise(F.col(k)) if k == "duration_min" else F.col(k)).alias(k) for k in keys]
    return F.unhex(F.sha2(F.to_json(F.struct(*plain)), 256))


def _ordered_names(mine) -> Column:
    """The names of the rows where ``mine`` holds, by first bridge id, joined by ', '."""
    ordered = F.array_sort(F.collect_list(F.when(mine, F.struct("bid", "name"))))
    return F.array_join(F.transform(ordered, lambda x: x["name"]), ", ")
