from shelfwise.llm import extract as X

SCHEMA = "page_id long, url string, html string, text string"
PAGE = ('<!DOCTYPE html><html lang="en"><head><title>t &amp</title><style>p{margin:0}</style><script>var t="</p>";</script>'
        '</head><body><nav><ul><li><a href="/a">a</a></li>%s</ul></nav><!-- ad --><div class="ad">Buy <b>now</b></div>'
        '<div id="sidebar">side</div><%s><h1>Title &eacute;</h1><p><b>One  two\n three.<br><p>4 &lt; 5 &amp;&amp; 6</p>'
        '<div class="notice">note</div><form>name <input></form><p>x%d</p></%s><div class="reader-comments"><p>me too</p></div>'
        '<footer>&copy; host</footer>')
TEXT = "Title é\nOne two three.\n4 < 5 && 6\nx%d"


def test_main_text(spark):
    rows = [(i, f"http://h{i % 3}.org/{i}", PAGE % ("<li>b</li>" * (i % 4), tag, i, tag), "clash")
            for i in range(30) for tag in ["article" if i % 3 else "div"]]
    want = {i: TEXT % i for i in range(30)}
    rows += [(100, "http://h1.org/x", None, ""), (101, None, "", ""), (102, "nourl", "plain <b>text</b> only", ""),
             (None, "http://h1.org/y", PAGE % ("", "article", 7, "article"), ""),
             (103, "http://h1.org/z", "<html><body><article>" + "<p>w w</p>" * 50_000, ""),
             (104, "http://q.org", "<script>x", ""), (105, "http://q.org", "a<!-- open", ""), (106, "http://q.org", "<p a='", "")]
    want |= {100: "", 101: "", 102: "plain text only", None: TEXT % 7, 103: "\n".join(["w w"] * 50_000), 104: "", 105: "a", 106: ""}
    rows.append(rows[4])
    got = X.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text == want[r.page_id] and r.n_chars == len(r.text), r.page_id
    assert X.extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_classes_nest():
    rows = [{"path": p, "n": n, "digest": d, "chars": c} for p, n, d, c in [
        ("", 10, 1, 0), ("/html", 10, 1, 0), ("/html/body", 10, 1, 5), ("/html/body/div.x", 8, 2, 90),
        ("/html/body/div.x/div.y", 8, 2, 10), ("/html/body/div.rare", 2, 3, 500), ("/html/body/nav", 10, 1, 900)]]
    paths, main = X.main_slot(rows)
    assert main == "/html/body/div.x" and "/html/body/div.rare" not in paths and "/html/body/div.x/div.y" in paths


def texts(spark, pages):
    rows = [(i, f"http://h.org/{i}", p, "") for i, p in enumerate(pages)]
    return [r.text for r in sorted(X.extract(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: r.page_id)]


def test_slot_by_text_inside(spark):
    items = "".join(f"<li>item {k} of the long list" for k in range(40))
    listed = "\n".join(f"item {k} of the long list" for k in range(40))
    for page, want in [
        (f"<body><div class=content><h1>T%d</h1><p>A</p><ul>{items}</ul><p>B</p></div></body>", f"T%d\nA\n{listed}\nB"),
        ("<body><div class=intro><p>The intro %d</p></div><div class=body><p>" + "w " * 40 + "</p></div></body>",
         "The intro %d\n" + "w " * 39 + "w"),
        ("<body><main><p>" + "w " * 40 + "%d</p><article><p>teaser</p></article></main></body>", "w " * 40 + "%d\nteaser"),
        ("<body><main><p>x</p><article><p>" + "w " * 40 + "%d</p></article></main></body>", "w " * 40 + "%d"),
        ("<body>x<div class=c><p>" + "w " * 40 + "%d</p></div></body>", "w " * 40 + "%d"),
    ]:
        assert texts(spark, [page % i for i in range(6)]) == [want % i for i in range(6)]


def test_slot_counts_text_in_paths_of_one_page(spark):
    page = "<body><div class=top>site</div><div class=content><div class=post-%d><p>" + "w " * 200 + "</p></div></div></body>"
    assert texts(spark, [page % i for i in range(6)]) == [("w " * 200).strip()] * 6


def test_cue_words_by_element():
    long = "w " * 60 + "end"
    for page, want in [
        (f"<body class='has-sidebar'><article><p>{long}</article>", long),
        (f"<body><div class='page with-menu'><article><p>{long}</article></div>", long),
        (f"<body><div class='page with-menu'><p>{long}</p></div>", long),
        (f"<body><article class='post social'><p>{long}</article>", long),
        (f"<body><main id='related-work'><p>{long}</main>", long),
        (f"<body><div class=box><p>{long}</p></div><div class=comments><p>{long} {long}</p></div>", long),
        (f"<body><article><p>{long}<p class='ad'>buy<p>a</p><ul><li class='comment'>me <ul><li>too</ul> yes<li>b</ul>"
         "<blockquote class='reader-comment'><p>c</p><blockquote>d</blockquote>e</blockquote><p class='notice'>n</p>"
         "<table><tr class=ad><td>1<td>2<tr><td>f</table>z</article>", f"{long}\na\nb\nf\nz"),
    ]:
        assert X.article(page, None) == want


LINES = ("<html><body><div>The Daily Example, since 1901</div><div><p>%s</p><p>%s</p></div><div>Copyright by the publisher</div>"
         "</body></html>")


def test_repeated_lines_in_plain_elements_go(spark):
    pages = [LINES % (f"Story number {i} " + "of many words " * (5 + i), f"It ends in its own way, {i * 7}.") for i in range(20)]
    want = [(f"Story number {i} " + "of many words " * (5 + i)).strip() + f"\nIt ends in its own way, {i * 7}." for i in range(20)]
    assert texts(spark, pages) == want
    # two pages are no host's template, and a host of copies keeps its text
    assert all("Daily" in t for t in texts(spark, pages[:2]))
    assert set(texts(spark, [pages[0]] * 5)) == set(texts(spark, [pages[0]] * 2))


def plain_classes(pages):
    """Words that share their occurrence vector with an element of the template, from whole vectors."""
    vectors = {}
    for k, page in enumerate(pages):
        counts, text = X.parse(page)
        tokens = [*(p for p, n in counts.items() for _ in range(n)), *(X.words_token(p, w) for p, good, w in text if good)]
        for t in tokens:
            vectors.setdefault(t, [0] * len(pages))[k] += 1
    half = {t for t, v in vectors.items() if 2 * sum(map(bool, v)) >= len(pages) and "\n" not in t}
    valid = {t for t in half if all(t[:i] in half for i, c in enumerate(t) if c == "/")}
    often = lambda v: sum(map(bool, v)) >= X.REPEATED * len(pages)
    return {t for t, v in vectors.items() if "\n" in t and often(v) and any(vectors[e] == v for e in valid)}


def test_classes_decide_against_whole_vectors(spark):
    import random

    rng = random.Random(3)
    line = lambda n: "".join(f"<p>{rng.choice(['always', 'often', 'once more'])} {rng.randint(0, 3)}</p>" for _ in range(n))
    pages = []
    for i in range(12):
        extra = "<section class=box><p>boxed line</p></section>" if i else ""
        pages.append(f"<body><div>Same line</div><div>twice</div>{extra}<div>twice</div><article>{line(3)}<p>own text of page {i} "
                     + "and more " * 30 + f"</p></article><p>same end</p>{'<p>rare</p>' if i % 2 else ''}</body>")
    rows = [(i, f"http://h.org/{i}", p, "") for i, p in enumerate(pages)]
    found = X.templates(spark.createDataFrame(rows, SCHEMA).selectExpr("page_id AS page", "'h' AS host", "html")).first()
    assert set(found.words) == plain_classes(pages)
    assert {"/body/section.box\n"} <= {w[:-16] for w in found.words} and len(found.words) >= 3
    # without the classes (vectors that equal no other) the lines would stay
    tokens = [{"path": w, "n": 12, "digest": k, "chars": 9} for k, w in enumerate(found.words)]
    root = {"path": "", "n": 12, "digest": -1, "chars": 0, "inside": 10**6}
    assert X.template_words([root, *tokens], [""]) == []


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "http://h.org/1", "<p>a</p>", "x", "y", "z", 1)],
                               "page_id long, url string, html string, host string, main string, words string, page int")
    assert [tuple(r) for r in X.extract(df).collect()] == [(1, "http://h.org/1", "a", 1)]
