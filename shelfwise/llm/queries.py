"""Registered queries of this package: thin digests of the operators' results."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.llm import (
    chat, decontaminate, exactdedup, extract, langid, licenses, merkle, packing, simhash, tokenalign, topk, toxicity,
    urlfilter)
from shelfwise.llm.common import table


def op1_toxicity(spark, d):
    return toxicity.predict(table(spark, d, "documents"), table(spark, d, "labels"))


def op2_urlfilter(spark, d):
    return urlfilter.judge(table(spark, d, "pages"))


def op3_language(spark, d):
    return langid.predict(table(spark, d, "documents"))


def op4_decontaminate(spark, d):
    found = decontaminate.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op5_packing(spark, d):
    import public_tokenizers

    pieces = packing.pack(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op6_simhash(spark, d):
    return simhash.near_duplicates(table(spark, d, "documents"))


def op7_licenses(spark, d):
    return licenses.scan(table(spark, d, "documents"))


def op8_extract(spark, d):
    return extract.extract(table(spark, d, "pages"))


def op9_chat(spark, d):
    return chat.repair(table(spark, d, "conversations"))


def op10_topk(spark, d):
    return topk.search(table(spark, d, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_exact_dedup(spark, d):
    docs = table(spark, d, "documents")
    return exactdedup.deduplicate(docs, exactdedup.older_half(docs))


def op12_merkle(spark, d):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return merkle.manifest(table(spark, d, "documents"), {"text": lower}, tampered)


def op13_align(spark, d):
    import public_tokenizers

    aligned = tokenalign.align(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                               public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_urlfilter": op2_urlfilter,
    "op3_language": op3_language,
    "op4_decontaminate": op4_decontaminate,
    "op5_packing": op5_packing,
    "op6_simhash": op6_simhash,
    "op7_licenses": op7_licenses,
    "op8_extract": op8_extract,
    "op9_chat": op9_chat,
    "op10_topk": op10_topk,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_merkle": op12_merkle,
    "op13_align": op13_align,
}


def _merkle_sql(levels: int = 8) -> str:
    """A tree a language and one over them, ``levels`` levels each, unrolled."""
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    field = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || {0}, '-')"
    leaf = "sha256(" + " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"
    step = "xor(x >> 1, 3988292384 * (x & 1))"
    crc = ("xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
           "lambda c: CAST(ascii(c) AS BIGINT))), lambda s, c: list_reduce(list_concat([xor(s, c)], "
           f"[0, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: {step})), 4294967295)")
    out = [f"""WITH leaves AS (SELECT doc_id, lang, {leaf.format("text")} AS leaf,
  CASE WHEN {crc} % 3 = 0 THEN {leaf.format(low)} END AS other FROM documents),
a0 AS (SELECT lang AS g, row_number() OVER w - 1 AS p, count(*) OVER (PARTITION BY lang) AS n, leaf AS h, doc_id, other
       FROM leaves WINDOW w AS (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf))"""]
    for tree, first in (("a", None), ("b", f"""b0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS p,
  count(*) OVER () AS n, h, g AS lang FROM a{levels})""")):
        out += [first] if first else []
        for k in range(levels):
            out.append(f"""{tree}{k + 1} AS (SELECT g, p // 8 AS p, max((n + 7) // 8) AS n,
  CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY p)) ELSE min(h) END AS h FROM {tree}{k} GROUP BY g, p // 8)""")
            out.append(f"""{tree}r{k} AS (SELECT g, p // 8 AS r, array_agg(h ORDER BY p) AS hs FROM {tree}{k} WHERE n > 1 GROUP BY ALL)""")
    out.append(f"""f0 AS (SELECT a.doc_id, a.h AS leaf, a.g, a.p, b.p AS q, b.h AS subroot, t.h AS root,
  coalesce(other, a.h) AS f, '' AS proof FROM a0 a JOIN b0 b ON a.g IS NOT DISTINCT FROM b.lang, b{levels} t)""")
    k = 0
    for tree, g, p in (("a", "f.g", "f.p"), ("b", "0", "f.q")):
        for level in range(levels):
            at = f"({p} // {8**level})"
            left = f"array_to_string(hs[1:{at} % 8], '')"
            right = f"array_to_string(hs[{at} % 8 + 2:], '')"
            out.append(f"""f{k + 1} AS (SELECT f.* REPLACE (CASE WHEN hs IS NULL THEN f ELSE sha256({left} || f || {right}) END AS f,
  CASE WHEN hs IS NULL THEN proof ELSE proof || {left} || {right} END AS proof)
  FROM f{k} f LEFT JOIN {tree}r{level} x ON x.g IS NOT DISTINCT FROM {g} AND x.r = {at} // 8)""")
            k += 1
    return ",\n".join(out) + f"""
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified FROM f{k}"""


#: DuckDB SQL of those queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op4_decontaminate": r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
           FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark),
t AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + 9], ' ') AS x
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS s FROM b WHERE len(w) > 0)),
p AS (SELECT k, n, s, array_to_string(w[s:s + n - 1], ' ') AS x
      FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM t))),
h AS (SELECT k, s, n, item_id FROM p JOIN t USING (n, x)),
c AS (SELECT k, count(DISTINCT q) AS n_hit FROM (SELECT k, unnest(range(s, s + n)) AS q FROM h) GROUP BY k),
i AS (SELECT k, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS id FROM h) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (k) LEFT JOIN i USING (k)""",
    "op10_topk": """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
      FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10""",
    "op11_exact_dedup": """
WITH n AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                           'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
g AS (SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, text_sha256 FROM n
      WINDOW w AS (PARTITION BY text_sha256))
SELECT doc_id, keep_id, group_size, coalesce(doc_id = keep_id, false) AS kept, text_sha256 FROM g""",
    "op12_merkle": _merkle_sql(),
}
