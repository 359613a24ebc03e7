"""Table sources and sinks (S1-S9) and lineage cuts.

Readers return lazy DataFrames (Catalyst pushes filters and column pruning
into the scan); writers are bulk DataFrame writes, never row-at-a-time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.session import ensure_checkpoint_dir


def scan_table(spark: SparkSession, source: str, fmt: str = "parquet", **options) -> DataFrame:
    """A table as a DataFrame. ``source`` is a path, a catalog table name
    (``fmt="table"``), a SQL text (``fmt="sql"``), or a JDBC query
    (``fmt="jdbc"`` with ``url`` etc. in ``options``)."""
    if fmt == "table":
        return spark.read.table(source)
    if fmt == "sql":
        return spark.sql(source)
    if fmt == "jdbc":
        return spark.read.format("jdbc").option("query", source).options(**options).load()
    return spark.read.format(fmt).options(**options).load(source)


def reflect_schema(df: DataFrame) -> DataFrame:
    """(position, column, type, nullable) of a frame, as a small frame."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    schema = T.StructType([T.StructField("position", T.IntegerType()), T.StructField("column", T.StringType()),
                           T.StructField("type", T.StringType()), T.StructField("nullable", T.BooleanType())])
    return df.sparkSession.createDataFrame(rows, schema)


def append_rows(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """S3: unconditional append (one bulk write per batch)."""
    df.write.mode("append").format(fmt).save(path)


CSV_OPTIONS = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def csv_export(df: DataFrame, path: str) -> None:
    """CSV with a header and no index column. Blanks at the edges stay, quotes
    inside a value are doubled; read it back with the same ``CSV_OPTIONS``. An
    empty text and NULL are the same, empty, field and read back as NULL."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def select_into(df: DataFrame, target: str, fmt: str = "parquet", mode: str = "errorifexists") -> DataFrame:
    """Create a table from a query (CTAS); ``target`` is a path, or a
    catalog name when ``fmt == "table"``. Returns the stored table."""
    spark = df.sparkSession
    if fmt == "table":
        df.write.mode(mode).saveAsTable(target)
        return spark.read.table(target)
    df.write.mode(mode).format(fmt).save(target)
    return spark.read.format(fmt).load(target)


def insert_select(df: DataFrame, target: str, fmt: str = "parquet") -> None:
    """INSERT INTO target SELECT ... (by column name)."""
    spark = df.sparkSession
    if fmt == "table":
        cols = spark.read.table(target).columns
        df.select(*cols).write.insertInto(target)
        return
    cols = spark.read.format(fmt).load(target).columns
    df.select(*cols).write.mode("append").format(fmt).save(target)


def preview(df: DataFrame, n: int = 20) -> None:
    """Show the first rows (an action, for people, not for pipelines)."""
    df.show(n, truncate=False)


def profile_frame(df: DataFrame) -> DataFrame:
    """A6 (``df.info()``): per column its type, non-NULL count and the row
    count, computed in one distributed aggregate."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count(F.col(c)).alias(f"__nn_{i}") for i, c in enumerate(cols)])
    types = dict(df.dtypes)
    stack = F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"),
                 F.col(f"__nn_{i}").alias("non_null"))
        for i, c in enumerate(cols)]))
    return agg.select(F.col("__rows").alias("rows"), stack.alias("s")).select("s.*", "rows")


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread rows over ``partitions`` tasks before CPU-heavy per-row work, where the caller knows that the
    scan yields few splits (e.g. one large parquet row group). ``None`` leaves the frame as it is."""
    return df.repartition(partitions) if partitions else df


#: Rows of a narrow table that one task turns into texts or pages.
ROWS_PER_TASK = 25_000


def spread_rows(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Spread the rows of a stored narrow table for CPU-heavy work on each: at least one task a core, and tasks that grow
    in number, not in size. Counting a parquet table reads its footers. Rows go by the hash of all their columns,
    so a retried task sends each to the same place."""
    partitions = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows_per_task))
    return df.repartition(partitions, *df.columns)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and
    read it back: the lineage is cut, the input is computed once, and a lost
    executor re-reads stored files instead of recomputing upstream stages."""
    path = shared_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the driver's JVM ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/shelfwise/{name}-{uuid.uuid4().hex}"
    delete_at_end(spark, path)
    return path


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Have the file system delete ``path`` when the driver's JVM ends."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the file system has ``path``; errors of the file system rise."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def listing_urls(spark: SparkSession, base_url: str, start: int, end: int, step: int = 1,
                 offset_per_page: int = 1) -> DataFrame:
    """Listing-page URLs for ``page in range(start, end, step)``: the
    page-0 URL has no query string, the others ``?limit=<page * offset_per_page>``
    (crawl 1 uses pages 80-119 with 50 per page; crawl 2 steps the offset by 50
    directly)."""
    page = F.col("id")
    limit = page * F.lit(offset_per_page)
    url = F.when(page == 0, F.lit(base_url)).otherwise(F.format_string("%s?limit=%d", F.lit(base_url), limit))
    return spark.range(start, end, step).select(page.alias("page"), url.alias("url"))
