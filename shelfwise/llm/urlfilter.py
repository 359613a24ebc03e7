"""URL filter: rules first, then host word segmentation and naive Bayes.

Concatenated host names are split into words by a unigram Viterbi search; the unigram counts come from
all words of the pages' texts. Multinomial naive Bayes over the host's and the path's tokens then decides
what no rule covers. It learns from the pages themselves: a host with one of the ``SEEDS`` among its words is
an example to block, any other one to allow, so words that keep company with the seeds count too.

Work on words is done once per distinct host label, host and path pattern; results are joined back.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import stored

#: (verdict, rule): host and its subdomains, path prefix (fixed values of the registered query).
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
         ("block", "net/fr/"))
#: Words that mark a host as an example to block (a parameter).
SEEDS = ("ads", "adult", "bet", "bets", "betting", "casino", "escort", "gambling", "jackpot", "pharma", "pills", "poker",
         "porn", "replica", "sex", "slots", "spam", "torrent", "track", "tracker", "viagra", "warez", "xxx")
#: A DNS label has at most 63 characters; longer ones are one token. Longest word that is looked for.
LABEL, WORD = 63, 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: str = "url") -> tuple:
    """Host and path columns; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substr({url}, instr({url}, '://') + 3)"))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)?", 1)
    return F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path")


def apply_rules(rules=RULES) -> tuple:
    """Columns ``rule`` and ``by_rule`` (null where none fits): the longest fitting rule wins."""
    rule = verdict = F.lit(None).cast("string")
    for say, text in sorted(rules, key=lambda r: len(r[1])):  # longer ones are put on top
        host, _, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(f"/{path}")
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, say).otherwise(verdict)
    return rule.alias("rule"), verdict.alias("by_rule")


def viterbi(label: str, counts: dict[str, int], total: int) -> list[str]:
    """Most likely split of ``label`` into words under unigram counts; unseen words pay for each letter."""
    best, back = [0.0] * (len(label) + 1), [0] * (len(label) + 1)
    for end in range(1, len(label) + 1):
        best[end] = float("-inf")
        for start in range(max(0, end - WORD), end):
            word = label[start:end]
            n = counts.get(word)
            p = log(n / total) if n else log(10 / total) - (end - start) * log(10)
            if best[start] + p > best[end]:
                best[end], back[end] = best[start] + p, start
    out, end = [], len(label)
    while end:
        out.append(label[back[end]:end])
        end = back[end]
    return out[::-1]


def _labels(hosts: DataFrame) -> DataFrame:
    """Distinct runs of letters in the host names."""
    return hosts.select(F.explode(F.split("host", "[^a-z]+")).alias("label")).filter("label <> ''").distinct()


def unigrams(pages: DataFrame) -> DataFrame:
    """``(word, n)``: the words of all pages' texts (tags dropped), A-Z lower-cased."""
    text = F.translate(F.regexp_replace("html", r"(?s)<(script|style)\b.*?</\1>|<[^>]*>", " "), _UPPER, _LOWER)
    words = pages.select(F.explode(F.regexp_extract_all(text, F.lit(rf"\b[a-z]{{2,{WORD}}}\b"), F.lit(0))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def segment(labels: DataFrame, words: DataFrame, seeds=SEEDS) -> DataFrame:
    """``(label, tokens)``. Each label meets the counts of its substrings, at most LABEL * WORD of them; the
    seeds are words too."""
    spark = labels.sparkSession
    extra = spark.createDataFrame([(w, 1) for w in seeds], "word string, n long")
    words = words.unionByName(extra).groupBy("word").agg(F.sum("n").alias("n"))
    total = words.agg(F.sum("n")).first()[0]
    short = labels.filter(F.length("label") <= LABEL)
    subs = short.select("label", F.explode(F.sequence(F.lit(1), F.length("label"))).alias("s")).select(
        "label", F.explode(F.expr(f"transform(sequence(1, least({WORD}, length(label) - s + 1)), k -> substr(label, s, k))")).alias("word"))
    found = subs.distinct().join(words, "word").groupBy("label").agg(F.collect_list(F.struct("word", "n")).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.column(0).to_pylist()
            split = [viterbi(x, {r["word"]: r["n"] for r in f or ()}, total) if len(x) <= LABEL else [x]
                     for x, f in zip(names, b.column(1).to_pylist())]
            yield pa.record_batch([b.column(0), pa.array(split, pa.list_(pa.string()))], names=["label", "tokens"])

    return labels.join(found, "label", "left").select("label", "found").mapInArrow(run, "label string, tokens array<string>")


def path_pattern(path: str = "path"):
    """The path lower-cased with each number as ``0``: few of them, however many pages."""
    return F.regexp_replace(F.translate(path, _UPPER, _LOWER), "[0-9]+", "0")


def judge(pages: DataFrame, rules=RULES, seeds=SEEDS) -> DataFrame:
    """``(page_id, host, path, rule, verdict, block_score)``, one row per row of ``pages`` (page_id, url, html).

    block_score is the naive Bayes log odds of blocking; it decides (above 0) where no rule fits. A null url
    or one without ``://`` has an empty host and path, fits no rule and is judged on no tokens; a null html
    adds no words; repeated rows and null ids each keep their row; ties of equal length cannot fit together;
    an empty table gives an empty result; other columns are ignored.
    """
    urls = pages.select("page_id", *split_url()).withColumn("pattern", path_pattern())
    pairs = stored(urls.groupBy("host", "pattern").agg(F.count(F.lit(1)).alias("n")), "url-pairs")
    hosts = pairs.select("host").distinct()
    split = stored(segment(_labels(hosts), unigrams(pages), seeds), "url-labels")
    pieces = hosts.select("host", F.posexplode(F.split("host", "[^a-z]+")).alias("k", "label")).filter("label <> ''")
    tokens = pieces.join(split, "label").select("host", F.explode("tokens").alias("token"))
    host_tokens = stored(tokens.groupBy("host", "token").agg(F.count(F.lit(1)).alias("times")), "url-host-tokens")
    path_tokens = (pairs.select("pattern").distinct()
                   .select("pattern", F.explode(F.split("pattern", "[^a-z0-9]+")).alias("token")).filter("token <> ''")
                   .select("pattern", F.concat(F.lit("/"), "token").alias("token"))
                   .groupBy("pattern", "token").agg(F.count(F.lit(1)).alias("times")))
    bad = host_tokens.filter(F.col("token").isin(*seeds)).select("host").distinct().withColumn("bad", F.lit(True))
    examples = pairs.join(bad, "host", "left").withColumn("bad", F.coalesce("bad", F.lit(False)))
    by_host = examples.groupBy("host", "bad").agg(F.sum("n").alias("n")).join(host_tokens, "host")
    by_path = examples.groupBy("pattern", "bad").agg(F.sum("n").alias("n")).join(path_tokens, "pattern")
    side = lambda b: F.sum(F.when(F.col("bad") == b, F.col("n") * F.col("times")).otherwise(0))
    counts = stored(by_host.select("token", "bad", "n", "times").unionByName(by_path.select("token", "bad", "n", "times"))
                    .groupBy("token").agg(side(True).alias("n1"), side(False).alias("n0")), "url-counts")
    size, all1, all0 = counts.agg(F.count(F.lit(1)), F.sum("n1"), F.sum("n0")).first()
    docs1, docs0 = examples.agg(F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)),
                                F.sum(F.when(F.col("bad"), 0).otherwise(F.col("n")))).first()
    prior = log(((docs1 or 0) + 1) / ((docs0 or 0) + 1))
    odds = (F.log((F.col("n1") + 1) / F.lit((all1 or 0) + size + 1.0)) - F.log((F.col("n0") + 1) / F.lit((all0 or 0) + size + 1.0)))
    weights = counts.select("token", odds.alias("w"))
    total = F.sum(F.col("w") * F.col("times"))
    host_score = stored(host_tokens.join(weights, "token").groupBy("host").agg(total.alias("hs")), "url-host-scores")
    path_score = stored(path_tokens.join(weights, "token").groupBy("pattern").agg(total.alias("ps")), "url-path-scores")
    score = F.lit(prior) + F.coalesce("hs", F.lit(0.0)) + F.coalesce("ps", F.lit(0.0))
    told = urls.join(host_score, "host", "left").join(path_score, "pattern", "left").select(
        "page_id", "host", "path", *apply_rules(rules), F.round(score, 6).alias("block_score"))
    verdict = F.coalesce("by_rule", F.when(F.col("block_score") > 0, "block").otherwise("allow"))
    return told.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "block_score")
