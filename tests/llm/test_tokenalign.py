import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shelfwise.llm import tokenalign as T

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", " ", "Hello, WORLD! it's we'll don't", "<|endoftext|> x </s><unk><0x41>", "日本語のテキスト。混ぜる abc 🙂🙂 👩‍👩‍👧",
         "▁x has the sign", "ﬁ é é Å", "a\x00b\n\t\r  c   ", "भाषा हिन्दी " * 30, "a" * 3000, "x." * 800, "﻿​" * 9,
         "The quick brown fox jumps over the lazy dog. " * 40]


def brute(texts):
    """Plain two-pointer alignment with the tokenizers as they are."""
    byte, piece = T.ByteTokenizer(A).bytes, T.PieceTokenizer(B).bytes
    hf, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    hf.encode_special_tokens = True
    docs, counts = [], Counter()
    for t in texts:
        a = hf.encode(" " + t, add_special_tokens=False).ids if t else []
        b = sp.encode(t) if t else []
        want = (" " + (t or "")).encode()
        if not t or b"".join(byte[i] for i in a) != want or b"".join(piece[i] for i in b) != want:
            a, b = [], []
        links, groups, i, j = [], [], 0, 0
        x, y, ga, gb = 0, 0, [], []
        while i < len(a):
            links.append((a[i], b[j]))
            x2, y2 = x + len(byte[a[i]]), y + len(piece[b[j]])
            if x2 <= y2:
                ga.append(a[i])
                i, x = i + 1, x2
            if y2 <= x2:
                gb.append(b[j])
                j, y = j + 1, y2
            if x2 == y2:
                groups.append(f"{','.join(map(str, ga))}|{','.join(map(str, gb))}")
                ga, gb = [], []
        assert j == len(b) and not ga
        docs.append((a, b, links, groups))
        counts.update(links)
    top = Counter()
    for (_, v), n in counts.items():
        top[v] = max(top[v], n)
    return [(len(a), len(b), len(g), len(k), sum(counts[p] == top[p[1]] for p in k), sum(counts[p] for p in k), ";".join(g))
            for a, b, k, g in docs]


def result(df, **bounds):
    cols = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    return sorted(((r.doc_id, *(r[c] for c in cols)) for r in T.align(df, A, B, **bounds).collect()), key=repr)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    odd = ["".join(chr(rng.choice([rng.randint(1, 0x24F), rng.randint(32, 126), 32, rng.randint(0xE000, 0x1FFFF)]))
                   for _ in range(200)) for _ in range(10)]
    words = ["alpha", "Beta.", "gamma,", "delta!", "x1", "ünï", "a" * 40]
    return TEXTS + odd + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 400))) for _ in range(20)]


@pytest.mark.parametrize("piece, block, pairs", [(1 << 14, 1 << 19, 2_000_000), (7, 40, 2_000_000), (2, 1, 60), (64, 500, 300)])
def test_equals_two_pointers(spark, texts, piece, block, pairs):
    if piece < 10:
        texts = [t and t[:300] for t in texts[:20]]
    df = spark.createDataFrame([(i, t, "z", 0) for i, t in enumerate(texts)], "doc_id long, text string, key string, a int")
    assert result(df.repartition(3), size=piece, block=block, task_pairs=pairs, max_pairs=pairs) == sorted(((i, *r) for i, r in enumerate(brute(texts))), key=repr)


def test_repeated_rows_null_ids_and_invalid_bytes(spark):
    texts = ["same text", "same text", "no id", "bad"]
    df = spark.createDataFrame(list(zip([3, 3, None, 4], texts)), "doc_id long, text string")
    df = df.selectExpr("doc_id", "if(text = 'bad', cast(X'41FF42' AS string), text) AS text")
    want = brute(texts[:3])
    assert result(df) == sorted([(3, *want[0]), (3, *want[1]), (None, *want[2]), (4, 0, 0, 0, 0, 0, 0, "")], key=repr)


def test_empty(spark):
    assert T.align(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []


def test_diagonals_cut_the_merge():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = (np.unique(rng.integers(1, 60, rng.integers(0, 40))) for _ in range(2))
        order = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
        d = np.arange(len(order) + 1)
        assert T.diagonal(a, b, d).tolist() == [sum(s == 0 for _, s in order[:k]) for k in d.tolist()]


def test_byte_tokenizer_gives_the_files_ids():
    hf = Tokenizer.from_file(A)
    hf.encode_special_tokens = True
    rng = random.Random(9)
    mine = T.ByteTokenizer(A)
    for c in [*range(1, 0x3000), *rng.sample(range(0xE000, 0x110000), 3000)]:
        t = f" a{chr(c)}b {chr(c)}1{chr(c)} {chr(c)}!"
        assert mine.encode(t) == hf.encode(t, add_special_tokens=False).ids
