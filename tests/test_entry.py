import duckdb
import pytest

import __spark_entry__ as entry
from shelfwise.sources.fixtures import DRIVER_TABLES

from conftest import SF_SMALL


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == entry.entry(spark).columns


def test_every_query_has_oracle():
    assert set(entry._QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


DUCK_TO_SPARK = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string",
                 "BOOLEAN": "boolean"}


def _norm(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("key", sorted(entry._QUERIES))
def test_oracle_small(spark, duck, key):
    sdf = entry.queries()[key](spark, SF_SMALL)
    rel = duck.sql(entry.oracle_sql()[key])
    types = {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert dict(sdf.dtypes) == types
    res = duck.execute(entry.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    order = sorted(dcols)
    a = sorted((tuple(_norm(r[c]) for c in order) for r in sdf.collect()), key=repr)
    b = sorted((tuple(_norm(r[dcols.index(c)]) for c in order) for r in res.fetchall()), key=repr)
    assert a == b
