import pytest
from pyspark.sql import functions as F

from shelfwise.operators.idmap import IdMap
from shelfwise.plans import star as S
from shelfwise.plans.cleaning import clean_titles
from shelfwise.plans.star_delta import StarStore
from shelfwise.sources import fixtures as fx

from conftest import SF_SMALL, rows


def values(spark, *data):
    return spark.createDataFrame(list(data), "dim string, value string")


def test_ids_of_earlier_loads_stay(spark, tmp_path):
    m = IdMap(str(tmp_path / "m"), ["value"], ["dim"])
    first = {tuple(r) for r in m.extend(values(spark, ("g", "m"), ("g", "z"), ("s", "a"), ("g", "m"), (None, "q")), 0).collect()}
    assert first == {("g", "m", 1), ("g", "z", 2), ("s", "a", 1)}
    second = {tuple(r) for r in m.extend(values(spark, ("g", "a"), ("g", "z"), ("s", "b"), ("t", "x"), (None, "b")), 1).collect()}
    assert second == first | {("g", "a", 3), ("s", "b", 2), ("t", "x", 1)}
    again = {tuple(r) for r in m.extend(values(spark, ("g", "other")), 1).collect()}       # load 1 is done
    assert again == second
    ids = sorted(r.id for r in m.extend(values(spark), 2).filter("dim = 'g'").collect())
    assert ids == list(range(1, len(ids) + 1))


def content(star):
    """A star without its ids."""
    title = star["title"]
    for name, id_col in S.DIMENSIONS:
        title = title.join(star[name], id_col, "left").drop(id_col)
    title = title.join(star["statistic"].drop("title_id"), "statistic_id", "left").drop("statistic_id")
    out = [sorted(rows(title.select(sorted(title.columns))), key=repr)]
    for dim, _ in S.LIST_DIMS:
        b = star[f"title_{dim}"].join(star[dim], f"{dim}_id")
        lists = b.groupBy("title_id").agg(F.array_sort(F.collect_list(F.struct(f"title_{dim}_id", f"{dim}_name"))).alias("l"))
        out.append(sorted((r.title_id, [x[1] for x in r.l]) for r in lists.collect()))
    return out


@pytest.fixture(scope="module")
def loads(spark):
    clean = clean_titles(fx.titles_with_duplicates(spark, SF_SMALL)).cache()
    return clean, *(spark.sql(q, clean=clean) for q in (fx.CLEAN_FIRST_SQL, fx.CLEAN_SECOND_SQL))


def test_two_loads_equal_one_star(spark, tmp_path, loads):
    clean, first, second = loads
    store = StarStore(str(tmp_path / "s"), buckets=8)
    store.apply(first, 0)
    ids = {n: {tuple(r) for r in store.star(spark)[n].collect()} for n in ("genre", "statistic", "title_genre", "title_studio")}
    assert content(store.star(spark)) == content(S.write_star(first, str(tmp_path / "a")))
    store.apply(second, 1)
    star = store.star(spark)
    assert content(star) == content(S.write_star(clean, str(tmp_path / "b")))
    # old ids stay; bridge rows of titles whose list did not change stay as they are
    assert ids["genre"] <= {tuple(r) for r in star["genre"].collect()}
    assert {(r[0], r[-1]) for r in ids["statistic"]} <= {(r.statistic_id, r.title_id) for r in star["statistic"].collect()}
    kept = {r for r in ids["title_genre"] if r[1] % 14}
    now = {tuple(r) for r in star["title_genre"].collect()}
    assert kept <= now and not (ids["title_genre"] - kept) & now
    assert ids["title_studio"] <= {tuple(r) for r in star["title_studio"].collect()}
    for name in ("title_genre", "title_studio"):
        found = [r[0] for r in star[name].collect()]
        assert len(found) == len(set(found))
    store.apply(second, 1)                                  # a load that is done again changes nothing
    assert {tuple(r) for r in store.star(spark)["title_genre"].collect()} == now


def test_a_title_can_lose_its_list(spark, tmp_path, loads):
    clean = loads[0]
    store = StarStore(str(tmp_path / "s"), buckets=2)
    store.apply(clean, 0)
    emptied = clean.withColumn("genres", F.when(F.col("title_id") % 3 == 0, F.lit(None)).otherwise(F.col("genres")))
    store.apply(emptied, 1)
    assert content(store.star(spark)) == content(S.write_star(emptied, str(tmp_path / "b")))
