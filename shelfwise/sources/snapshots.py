"""Full and differential snapshots.

A full snapshot is a plain table write. A differential snapshot lists the
rows inserted, updated or deleted since a base snapshot: one full outer join
on the key (both sides shuffle once on it) with a NULL-safe comparison of
every other column - NULL equals NULL here, unlike a plain ``=``. Keys are
unique in a base snapshot; the current rows may repeat them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def full_snapshot(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that stand on several rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys)


def _null_safe(df: DataFrame, other: DataFrame, cols: list[str], how: str) -> DataFrame:
    """The rows of ``df`` by whether ``other`` has their ``cols``, where NULL equals NULL."""
    theirs = other.select(*[F.col(c).alias(f"_k_{c}") for c in cols])
    return df.join(theirs, reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in cols]), how)


def differential_snapshot(base: DataFrame, current: DataFrame, key: str | Sequence[str] = "title_id") -> DataFrame:
    """(key..., op, current columns): op 'I' inserted, 'U' updated, 'D'
    deleted (current columns NULL); unchanged rows are left out, but for those
    of a key that ``current`` repeats: they come as 'K' (kept), so that the rows of such
    a key can be restored one by one. Keys compare NULL-safe (a NULL key is one
    key); a repeated key in ``base`` raises ``ValueError``."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = [c for c in current.columns if c not in keys]
    if not _repeated(base, keys).isEmpty():
        raise ValueError(f"the base snapshot repeats values of {keys}; remove the copies first")
    b = base.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_b_{c}") for c in cols], F.lit(True).alias("_in_b"))
    c = current.select(*keys, *cols, F.lit(True).alias("_in_c"))
    j = b.join(c, reduce(lambda x, y: x & y, [F.col(f"_k_{k}").eqNullSafe(F.col(k)) for k in keys]), "full_outer")
    same = reduce(lambda x, y: x & y, [F.col(f"_b_{n}").eqNullSafe(F.col(n)) for n in cols], F.lit(True))
    op = (F.when(F.col("_in_b").isNull(), F.lit("I"))
          .when(F.col("_in_c").isNull(), F.lit("D"))
          .when(~same, F.lit("U")))
    key = [F.when(F.col("_in_c").isNull(), F.col(f"_k_{k}")).otherwise(F.col(k)).alias(k) for k in keys]
    changed = j.withColumn("op", op).filter(F.col("op").isNotNull()).select(*key, "op", *cols)
    kept = _null_safe(current, _repeated(current, keys), keys, "left_semi")
    kept = _null_safe(kept, base.select(*keys, *cols), [*keys, *cols], "left_semi")
    return changed.unionByName(kept.select(*keys, F.lit("K").alias("op"), *cols))


def apply_differential(base: DataFrame, diff: DataFrame, key: str | Sequence[str] = "title_id") -> DataFrame:
    """Restore the current state from a base snapshot and a differential (with
    the kept rows of repeated keys, as ``differential_snapshot`` gives it)."""
    keys = [key] if isinstance(key, str) else list(key)
    kept = _null_safe(base, diff, keys, "left_anti")
    changed = diff.filter(F.col("op") != "D").drop("op")
    return kept.unionByName(changed.select(*base.columns))
