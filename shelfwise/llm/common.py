"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import ensure_checkpoint_dir


#: Of files whose rows are megabytes each: sizes are looked at from the first row on, not from the hundredth, so a task
#: holds about a row group and no more, however many rows it writes; a reader decodes a row group at once.
LARGE_ROWS = {"parquet.block.size": 16 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}


def stored(df: DataFrame, name: str, codec: str = "zstd", options: dict | None = None) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Lineage is cut and a lost executor re-reads files instead of recomputing. The folder is
    marked for deletion when the driver's JVM ends. ``options`` are the writer's.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/shelfwise-llm/{name}-{uuid.uuid4().hex}"
    df.write.options(compression=codec, **(options or {})).parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark, most: int) -> Iterator[None]:
    """Within it, Python stages that run get at most ``most`` rows at once (by the session's own setting 10,000 rows or
    64 MB, which each task then holds in the JVM's buffers and once more in Python)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    if before is None or not 0 < int(before) <= most:
        spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables. Column chunks come in pieces: a vectored read takes a whole one at once, through a
    buffer of its size outside the heap."""
    return spark.read.option("parquet.hadoop.vectored.io.enabled", "false").parquet(f"{sf_dir}/{name}.parquet")


def bucket(col, n: int):
    """crc32 of an id as text, mod ``n`` (null ids: null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


def slices(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds at most ``max_bytes`` of the ``text`` column.

    A single longer row forms a slice of its own, so a task's memory follows ``max_bytes`` and
    its longest text, not the number of rows that happen to arrive together.
    """
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, base + max_bytes, side="right")), start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def free_name(columns: list[str], wanted: str) -> str:
    """``wanted``, lengthened until no column of the input has that name (case aside)."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
