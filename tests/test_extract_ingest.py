from pyspark.sql import functions as F

from shelfwise.operators import extract as X
from shelfwise.functions.text import html_text
from shelfwise.operators import ingest
from shelfwise.sources import fixtures as fx
from shelfwise.sources import snapshots, tables

from conftest import SF_SMALL, rows


def _blocks(spark, data):
    return spark.createDataFrame(data, "title_id long, pos int, text string")


def test_kv_rules(spark):
    b = _blocks(spark, [(1, 1, "Type: TV"), (1, 2, "Source: a: b: c"), (1, 3, "no colon here"),
                        (1, 4, "Type: Special"), (1, 5, "Ranked: #12"), (1, 6, "Members: 1,234"),
                        (1, 7, "Episodes: Unknown")])
    kv = rows(X.kv_blocks(b), "pos", "key", "value")
    assert (2, "Source", "a") in kv and all(p != 3 for p, _, _ in kv)
    rec = X.convert_counts(X.pivot_blocks(X.kv_blocks(b))).first()
    assert rec["media_type"] == "Special"          # repeated key: last wins
    assert rec["ranking"] == 12 and rec["members"] == 1234 and rec["episodes"] is None
    assert rec["genres"] is None                   # no genre-like block at all


def test_genre_fold(spark):
    b = _blocks(spark, [(1, 1, "Genres: "), (1, 2, "Theme: TV"), (1, 3, "Demographic: Shounen"),
                        (2, 1, "Genres: Action, Drama"), (2, 2, "Themes: "), (3, 1, "Genres: ")])
    got = dict(rows(X.pivot_blocks(X.kv_blocks(b)), "title_id", "genres"))
    assert got == {1: "TV, Shounen", 2: "Action, Drama, ", 3: ""}


def test_first_block_label_rules(spark):
    b = _blocks(spark, [(1, 2, "Type: Special"), (1, 1, "Type: TV"), (1, 3, "Popularity: #1,234")])
    t = X.text_after_label(b).first()
    assert t["media_type"] == "TV" and t["studio"] == "N/A"
    d = X.digits_after_label(b).first()
    assert d["popularity"] == "1234" and d["popularity_int"] == 1234 and d["episodes"] == "N/A"
    assert d["episodes_int"] is None


def test_page_fields(spark):
    pages = spark.createDataFrame(
        [(1, "u", "<html><title> T &amp; x </title><h1>A <b>b</b></h1><a href=\"/x\">one</a><a href='y'>two</a></html>"),
         (2, "u", "<p>no heading</p>")], "page_id long, url string, html string")
    f = {r["page_id"]: r for r in X.page_fields(pages).collect()}
    assert f[1]["heading"] == "A b" and f[1]["title"] == "T & x" and f[1]["link_texts"] == "one, two"
    assert f[2]["heading"] is None and f[2]["title"] == "N/A" and f[2]["link_texts"] == ""
    assert rows(X.links_of_page(pages), "pos", "href") == [(0, "/x"), (1, "y")]   # either kind of quotes


def test_insert_if_absent(spark):
    stored = spark.createDataFrame([(1, "A"), (2, None)], "title_id long, title_name string")
    batch = spark.createDataFrame([(5, "B"), (3, "B"), (4, "A"), (6, None), (7, None), (8, "a")],
                                  "title_id long, title_name string")
    got = sorted(rows(ingest.insert_if_absent(batch, stored)), key=repr)
    assert got == sorted([(3, "B"), (6, None), (7, None), (8, "a")], key=repr)   # first B wins; NULL names always insert
    got_ci = rows(ingest.insert_if_absent(batch, stored, collation="utf8_lcase"))
    assert (8, "a") not in got_ci


def test_insert_if_absent_matches_fixture(spark):
    arr, sto = fx.titles_arriving(spark, SF_SMALL), fx.titles_stored(spark, SF_SMALL)
    new = ingest.insert_if_absent(arr, sto)
    assert new.filter(F.col("title_id") >= 1000000).count() == 0      # re-sends lose to first arrival
    assert new.join(sto, "title_name", "left_semi").count() == 0


def test_differential_roundtrip(spark):
    base, cur = fx.titles_raw(spark, SF_SMALL), fx.titles_changed(spark, SF_SMALL)
    diff = snapshots.differential_snapshot(base, cur)
    ops = dict(rows(diff.groupBy("op").count()))
    assert set(ops) <= {"I", "U", "D"} and ops.get("D", 0) > 0 and ops.get("I", 0) > 0
    restored = snapshots.apply_differential(base, diff)
    assert sorted(rows(restored), key=repr) == sorted(rows(cur.select(*base.columns)), key=repr)


def test_profile_and_schema(spark):
    raw = fx.titles_raw(spark, SF_SMALL)
    prof = {r["column_name"]: r for r in tables.profile_frame(raw).collect()}
    assert prof["title_id"]["non_null"] == 200 and prof["title_name"]["non_null"] < 200
    sch = rows(tables.reflect_schema(raw), "column", "type")
    assert sch[0] == ("title_id", "bigint") and len(sch) == 16


def test_csv_and_append(spark, tmp_path):
    raw = fx.titles_raw(spark, SF_SMALL).select("title_id", "title_name")
    tables.csv_export(raw, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.columns == ["title_id", "title_name"] and back.count() == 200
    p = str(tmp_path / "t")
    tables.append_rows(raw, p)
    tables.append_rows(raw, p)
    assert spark.read.parquet(p).count() == 400


def test_listing_urls(spark):
    got = rows(tables.listing_urls(spark, "https://x.test/top", 0, 3, offset_per_page=50))
    assert got == [(0, "https://x.test/top"), (1, "https://x.test/top?limit=50"), (2, "https://x.test/top?limit=100")]
    got2 = rows(tables.listing_urls(spark, "https://x.test/top", 8900, 8950, step=50), "url")
    assert got2 == [("https://x.test/top?limit=8900",)]


def test_select_into_and_insert_select(spark, tmp_path):
    from shelfwise.operators import clean, normalize
    raw = fx.titles_raw(spark, SF_SMALL)
    p = str(tmp_path / "t")
    t = tables.select_into(raw.select("title_id", "title_name"), p)
    tables.insert_select(raw.select("title_name", "title_id").filter("title_id < 10"), p)
    assert spark.read.parquet(p).count() == 210 and t.columns == ["title_id", "title_name"]
    full = clean.backfill(raw, clean.trim_column, clean.fill_missing)
    assert full.filter("studio IS NULL OR premiered IS NULL OR episodes IS NULL").count() == 0
    assert normalize.add_column(raw, "duration_min", "double").schema["duration_min"].dataType.simpleString() == "double"
    snap = snapshots.full_snapshot(raw, str(tmp_path / "snap"))
    assert snapshots.differential_snapshot(raw, snap).count() == 0


def test_crawl_shapes_differ_as_the_reference(spark):
    from shelfwise.plans import crawl
    listing = crawl.listing_rows(fx.titles_raw(spark, SF_SMALL))
    blocks = fx.info_blocks(spark, SF_SMALL)
    c1 = {r["title_id"]: r for r in crawl.crawl1_records(listing, blocks).collect()}
    c2 = {r["title_id"]: r for r in crawl.crawl2_records(listing, blocks).collect()}
    # id 31 has 'Type: <x>' first and 'Type: Special' later: crawl 1 takes the first, crawl 2 the last
    assert c2[31]["media_type"] == "Special" and c1[31]["media_type"] != "Special"
    # members with a thousands comma: crawl 1 keeps digits only, crawl 2 parses the comma form
    assert c1[100]["members"] == 1300 and c2[100]["members"] == 1300
    # episodes 'Unknown' (id 17: NULL episodes): both NULL
    assert c1[17]["episodes"] is None and c2[17]["episodes"] is None
    u = crawl.union_crawls(crawl.crawl1_records(listing, blocks), crawl.crawl2_records(listing, blocks))
    assert u.count() == 400 and set(r[0] for r in u.select("source").distinct().collect()) == {1, 2}


def test_star_titles_by_id(spark):
    from shelfwise.plans import star as S
    from shelfwise.plans.cleaning import clean_titles
    st = S.build_star(clean_titles(fx.titles_with_duplicates(spark, SF_SMALL)))
    a, b = S.star_titles(st), S.star_titles(st, by_id=True)
    assert "title_id" in b.columns and b.count() >= a.count()
    assert b.select("title_id").distinct().count() == b.count()


def test_listing_links_stop_rule(spark):
    pages = spark.createDataFrame(
        [(1, "u", '<ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li><li>no link</li>'
                  '<li><a href="/c">C</a></li></ul>'),
         (2, "u", '<li>first has none</li><li><a href="/x">X</a></li>'),
         (3, "u", "<p>no rows</p>")], "page_id long, url string, html string")
    got = rows(X.listing_links(pages), "page_id", "pos", "href")
    assert got == [(1, 0, "/a"), (1, 1, "/b")]


def test_clean_chain_guard_modes(spark):
    import pytest
    from shelfwise.plans.cleaning import clean_titles
    bad = fx.titles_with_violations(spark, SF_SMALL)
    with pytest.raises(ValueError):
        clean_titles(bad, guard="strict")
    kept = clean_titles(bad, guard="drop")
    assert kept.filter("score > 10 OR ranking <= 0 OR favorites < 0").count() == 0
    assert kept.count() < clean_titles(bad).count()


def test_append_new_job(spark, tmp_path):
    arr, sto = fx.titles_arriving(spark, SF_SMALL), fx.titles_stored(spark, SF_SMALL)
    target = str(tmp_path / "target")
    first = ingest.append_new(sto, target)                 # empty target: first per name
    assert first.count() == spark.read.parquet(target).count()
    n0 = spark.read.parquet(target).count()
    ingest.append_new(arr, target)
    ingest.append_new(arr, target)                         # replay: nothing new except NULL names
    names = spark.read.parquet(target).filter("title_name IS NOT NULL")
    assert names.select("title_name").distinct().count() == names.count()
    assert spark.read.parquet(target).count() > n0


def test_insert_compares_under_the_collation(spark):
    schema = "title_id long, title_name string, n int"
    arr = spark.createDataFrame([(2, "abc", 1), (1, "Abc", 2), (1, "ABC", 1), (3, "Old", 0), (4, None, 0), (5, None, 0)], schema)
    sto = spark.createDataFrame([(9, "OLD", 0)], schema)
    got = sorted(rows(ingest.insert_if_absent(arr, sto, collation="utf8_lcase")), key=repr)
    assert got == sorted([(1, "ABC", 1), (4, None, 0), (5, None, 0)], key=repr)
    assert len(rows(ingest.insert_if_absent(arr, sto))) == 6


def test_append_lets_read_errors_rise(spark, tmp_path):
    import pytest

    arr = spark.createDataFrame([(1, "a")], "title_id long, title_name string")
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        ingest.append_new(arr, str(tmp_path / "t"))
    assert [x.name for x in (tmp_path / "t").iterdir() if x.suffix == ".parquet" and not x.name.startswith("_")] == ["part-0.parquet"]


def test_numbers_do_not_accept_a_newline(spark):
    from shelfwise.functions import parse

    df = spark.createDataFrame([("12\n",), ("12",)], "s string")
    assert rows(df.select(parse.int_digits("s"), parse.float_guarded("s"), parse.int_with_commas("s"))) == [
        (None, None, None), (12, 12.0, 12)]


def test_snapshots_with_null_and_repeated_keys(spark):
    import pytest
    from shelfwise.sources import snapshots as S

    schema = "title_id long, v string"
    a = spark.createDataFrame([(None, "x"), (1, "y"), (2, "z")], schema)
    b = spark.createDataFrame([(None, "x"), (1, "w"), (3, "q")], schema)
    diff = S.differential_snapshot(a, b)
    assert sorted(rows(diff), key=repr) == sorted([(1, "U", "w"), (2, "D", None), (3, "I", "q")], key=repr)
    assert sorted(rows(S.apply_differential(a, diff)), key=repr) == sorted(rows(b), key=repr)
    c = spark.createDataFrame([(None, "changed"), (1, "y"), (2, "z")], schema)
    assert rows(S.differential_snapshot(a, c)) == [(None, "U", "changed")]
    with pytest.raises(ValueError):
        S.differential_snapshot(a.union(a), b)


def test_differential_of_rows_that_repeat_keys(spark):
    from shelfwise.sources import snapshots as S

    schema = "title_id long, v string"
    a = spark.createDataFrame([(None, "n"), (1, "y"), (2, "z"), (3, "p"), (4, None), (5, "s")], schema)
    b = spark.createDataFrame([(None, "n"), (None, "m"), (1, "y"), (1, "w"), (2, "z"), (4, None), (4, None),
                               (6, "i"), (6, "i"), (5, "t"), (5, "u")], schema)
    diff = S.differential_snapshot(a, b)
    changes = [(None, "U", "m"), (1, "U", "w"), (3, "D", None), (6, "I", "i"), (6, "I", "i"), (5, "U", "t"), (5, "U", "u")]
    kept = [(None, "K", "n"), (1, "K", "y"), (4, "K", None), (4, "K", None)]
    assert sorted(rows(diff), key=repr) == sorted(changes + kept, key=repr)
    assert sorted(rows(S.apply_differential(a, diff)), key=repr) == sorted(rows(b), key=repr)


def test_differential_queries_where_new_ids_meet_old_ones(spark, tmp_path):
    """Ids + 100000 of the changed table meet ids of a part table of more than 100,000 rows."""
    import __spark_entry__ as e

    part = spark.range(100200).filter("id < 200 OR id >= 100000").selectExpr(
        "id AS p_partkey", "'blue ring' AS p_name", "'SMALL' AS p_type", "'Brand#7' AS p_brand", "CAST(id % 50 AS INT) AS p_size",
        "1.0D AS p_retailprice")
    part.write.parquet(str(tmp_path / "part.parquet"))
    d, q = str(tmp_path), e.queries()
    changed = fx.titles_changed(spark, d)
    assert changed.count() > changed.select("title_id").distinct().count()
    assert sorted(rows(q["apply_differential"](spark, d)), key=repr) == sorted(rows(changed), key=repr)
    ops = dict(rows(q["differential_snapshot"](spark, d).groupBy("op").count()))
    assert set(ops) == {"U", "D", "I"}


def test_character_references_are_decoded_once(spark):
    cases = [("Tom&#039;s&nbsp;x", "Tom's x"), ("&#x27;q&#X27;", "'q'"), ("&amp;lt;&lt;", "&lt;<"),
             ("caf&eacute; &#128512;", "café \U0001F600"), ("a & b &nosuch; &;", "a & b &nosuch; &;"),
             ("&#0;&#xD800;&#99999999999;", "�" * 3), ("<b>&nbsp; x </b>&nbsp;", "x"), ("", ""), (None, None)]
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)], "i int, t string")
    got = dict(rows(df.select("i", html_text("t"))))
    assert [got[i] for i in range(len(cases))] == [b for _, b in cases]


def test_elements_by_class_and_attribute(spark):
    html = ("<div class='score-label-x'>no</div><div id=a class=\"fl score-label r1\">\n 8.5 </div>"
            "<divx class=\"score-label\">no</divx><p itemprop='other'>no</p><p x=1 itemprop='description'>A &amp; B</p>"
            "<span itemprop=\"genre\">G1</span><span>no</span><span class=\"c\" itemprop=\"genre\">G2</span>")
    df = spark.createDataFrame([(html,), ("",), (None,)], "html string")
    got = rows(df.select(
        X.first_text("html", "div", "N/A", cls="score-label"),
        X.first_text("html", "div", cls="r1 fl"),
        X.first_text("html", "p", attrs={"itemprop": "description"}),
        X.joined_matches("html", "span", attrs={"itemprop": "genre"})))
    assert got == [("8.5", "8.5", "A & B", "G1, G2"), ("N/A", None, None, ""), ("N/A", None, None, None)]


def test_blocks_without_a_title_make_no_record(spark):
    kv = X.kv_blocks(_blocks(spark, [(None, 1, "Genres: A"), (1, 1, "Genres: B"), (None, 2, "Type: TV")]))
    assert rows(X.pivot_blocks(kv), "title_id", "genres") == [(1, "B")]
    assert X.pivot_blocks(kv.limit(0)).count() == 0


def test_pages_to_raw_rows_with_missing_parts(spark):
    from shelfwise.plans import crawl

    html = ('<h1 class="title-name">A</h1><div class="score-label">7.5</div>'
            '<div class="spaceit_pad"><span>Type:</span> TV</div><div class="spaceit_pad">Ranked: #3</div>')
    pages = spark.createDataFrame([(1, html), (2, ""), (3, None)], "page_id long, html string")
    got = {(r.title_id, r.source): r for r in crawl.crawl_pages(pages).collect()}
    assert len(got) == 6
    assert (got[1, 2].title_name, got[1, 2].score, got[1, 2].ranking, got[1, 2].media_type) == ("A", 7.5, 3, "TV")
    assert (got[1, 1].studio, got[1, 1].synopsis, got[1, 2].studio) == ("N/A", "N/A", None)
    assert got[2, 1].title_name is None and got[3, 2].media_type is None
    assert got[2, 1].media_type == got[3, 1].studio == "N/A"


def test_pages_are_built_by_many_tasks_of_bounded_size(spark, tmp_path):
    path = str(tmp_path / "part.parquet")
    spark.read.parquet(f"{SF_SMALL}/part.parquet").coalesce(1).write.parquet(path)
    part = spark.read.parquet(path)
    assert part.rdd.getNumPartitions() == 1
    cores = spark.sparkContext.defaultParallelism
    for pages in (fx.nested_pages, fx.detail_pages, fx.listing_pages):
        assert pages(spark, str(tmp_path)).rdd.getNumPartitions() == cores
    tasks = tables.spread_rows(part, 10)     # 200 rows
    assert tasks.rdd.getNumPartitions() == 20
    assert sorted(rows(tasks)) == sorted(rows(part))
    assert tables.spread_rows(part.limit(0), 10).count() == 0


DIV_TAGS = r"(?s)<div(?=[\s>])(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>|</div\s*>"


def plain_elements(html, cls):
    """Contents of matching divs by a stack of open ones."""
    import re

    out, stack = [], []
    for m in re.finditer(DIV_TAGS, html):
        if m[0].startswith("</"):
            place = stack.pop()
            if place is not None:
                out[place[0]] = html[place[1]:m.start()]
        else:
            classes = re.search(r"\sclass\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", m[0])
            names = " ".join(g or "" for g in classes.groups()).split() if classes else []
            stack.append((len(out), m.end()) if cls is None or cls in names else None)
            if stack[-1] is not None:
                out.append(None)
    for place in stack:
        if place is not None:
            out[place[0]] = html[place[1]:]
    return out


def closes_only_open_ones(html):
    """No closing tag without an open element before it (browsers drop such tags, here they are not counted on)."""
    import re

    depth = 0
    for t in re.findall(DIV_TAGS, html):
        depth += -1 if t.startswith("</") else 1
        if depth < 0:
            return False
    return True


def test_nested_elements_against_a_stack(spark):
    import random

    rng = random.Random(4)
    parts = ["<div>", "</div>", "<div class='k x'>", '<div id=1 class="k">', "<div class=k>", "text ", "<b>b</b>", "<divx>", "</div >"]
    pages = ["<div class='k'>a</div>", "", "no tag", "<div class='k'>open", '<div class="spaceit_pad"><div>Type: TV</div> more</div>']
    pages += ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(200)]
    pages = [p for p in pages if closes_only_open_ones(p)]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "page_id long, html string")
    for cls in (None, "k"):
        got = {r.page_id: r.e for r in df.select("page_id", X.elements("html", "div", cls).alias("e")).collect()}
        for i, p in enumerate(pages):
            assert got[i] == plain_elements(p, cls), p


def test_links_by_class_and_any_quotes(spark):
    html = ("<a data-href=\"/no\">0</a><a class='t hoverinfo' href='/one'>1</a><a href=/two class=hoverinfo>2</a>"
            "<abbr href='/x'>x</abbr><a title=\"a > b\" href=\"/three\">3</a><a name='n'>4</a><a href=''>5</a>")
    pages = spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")
    assert [r.href for r in X.links_of_page(pages).collect()] == ["/one", "/two", "/three", ""]
    assert [r.href for r in X.links_of_page(pages, cls="hoverinfo").collect()] == ["/one", "/two"]
