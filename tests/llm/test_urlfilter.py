import itertools
from math import log

from shelfwise.llm import urlfilter as U

SCHEMA = "page_id long, url string, html string, host string, n int"
URLS = {
    "http://WWW.Example.com/en/x?q#f": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
    "https://a.example.com/en/x": ("a.example.com", "/en/x", "example.com/en/", "block"),
    "https://example.com/en": ("example.com", "/en", "com/", "allow"),
    "http://com": ("com", "", None, None), "http://com/": ("com", "/", "com/", "allow"),
    "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
    "http://x.net/es/1": ("x.net", "/es/1", "net/es/", "block"), "http://x.net/de/1": ("x.net", "/de/1", None, None),
    "http://x.net?/es/": ("x.net", "", None, None), "//x.net/es/": ("", "", None, None), None: ("", "", None, None),
    "a://b://c/d": ("b:", "//c/d", None, None), "http://": ("", "", None, None),
}


def test_rules(spark):
    rows = [(i, u, None, "clash", 1) for i, u in enumerate(URLS)]
    rows += [(None, "http://x.net/fr/", "", "", 1), (3, "http://com", None, "", 1)]
    got = U.judge(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id is not None:
            host, path, rule, verdict = list(URLS.values())[r.page_id]
            assert (r.host, r.path, r.rule) == (host, path, rule), r
            assert r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")
    assert U.judge(spark.createDataFrame([], SCHEMA)).collect() == []


def test_method_blocks_spam_hosts(spark):
    html = "<p>cheap pills and free bets on a farm, spam spam, news of the day</p>" * 3
    hosts = ["cheappills.org", "spamfarm.org", "freebets.org", "dailynews.org", "newsoftheday.org", "cheapfarm.org"]
    rows = [(i, f"http://{h}/en/{i}", html, "", 1) for i, h in enumerate(hosts * 10)]
    got = {r.host: r.verdict for r in U.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[h] for h in hosts] == ["block", "block", "block", "allow", "allow", "block"]


def test_viterbi_is_the_best_split():
    counts, total = {"cheap": 50, "pills": 20, "heap": 90, "ill": 30, "pill": 25, "s": 10, "a": 100}, 400
    price = lambda w: log(counts[w] / total) if w in counts else log(10 / total) - len(w) * log(10)
    for label in ("cheappills", "apills", "zzheap", "s"):
        cuts = [[label[i:j] for i, j in zip((0, *c), (*c, len(label)))] for k in range(len(label))
                for c in itertools.combinations(range(1, len(label)), k)]
        best = max(sum(map(price, c)) for c in cuts)
        assert abs(sum(map(price, U.viterbi(label, counts, total))) - best) < 1e-9
