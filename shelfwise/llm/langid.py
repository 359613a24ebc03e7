"""Language identification by cross-parsing entropy.

Each language's labelled sample becomes a suffix automaton. A text is cut, greedily from the left, into
the longest phrases that occur in a language's sample; the automaton follows each phrase one letter at
a time. A language that needs few phrases is close. Phrases are priced at log2 of the sample's length
(the bits that point to a place in it), divided by the text's letters: the estimate of cross entropy in
bits a letter. The language with the least wins.

Automata are dense tables walked by array operations: many stretches of text at once, all languages
side by side. A stretch has at most ``LANE`` letters and starts a new phrase, for every language alike,
so long texts are read whole and cost no more a letter than short ones.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import bucket, free_name, slices

#: Bounds of the labelled sample: texts a language (on average), and characters of one text.
SAMPLE_TEXTS = 48
SAMPLE_CHARS = 1000
LANE = 1024
SLICE_BYTES = 2 << 20
UNKNOWN = "und"
#: Phrases a letter above which a text reads as no learned language, and the letters that this takes.
FOREIGN, LEAST = 0.8, 20


def sample(labelled: DataFrame, texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """About ``texts`` texts a language (text, lang), spread by a hash, each a stretch of at most ``chars``
    characters, joined. Languages are counted first; a row's place among its language's rows is then
    known from its hash, so the few rows that fit are met by the filter, and no text is shuffled."""
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return {}
    pairs = [F.lit(x) for k, n in sorted(counts.items()) for x in (k, float(n))]
    place = (F.xxhash64("text", "doc_id") / F.lit(2.0**64) + 0.5) * F.element_at(F.create_map(*pairs), F.col("lang"))
    got = (rows.select("lang", place.alias("place"), F.expr(f"substr(text, 1, {chars})").alias("text"))
           .filter(F.col("place") < 2 * texts + 8).orderBy("place", "lang", "text").limit(texts * len(counts)).collect())
    out: dict[str, list[str]] = {}
    for r in got:
        out.setdefault(r["lang"], []).append(r["text"])
    return {k: "\n".join(v) for k, v in out.items()}


@functools.cache
def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: its lower case (first character of it), whether it is a letter, a letter or mark."""
    lower = np.arange(0x110000, dtype=np.uint32)
    kind = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        ch = chr(i)
        k = unicodedata.category(ch)[0]
        if k in "LM":
            kind[i] = 1 if k == "L" else 2
            lower[i] = ord(ch.lower()[0])
    return lower, kind == 1, kind > 0


def suffix_automaton(codes: np.ndarray, width: int) -> np.ndarray:
    """Transitions ``[state, letter]`` of the suffix automaton of ``codes``; -1 where there is none.
    State 0 is the empty phrase; a path from it spells exactly the phrases that occur."""
    size = 2 * max(len(codes), 1) + 1
    move = np.full((size, width), -1, np.int32)
    length, link = [0] * size, [-1] * size
    used, last = 1, 0
    for c in codes.tolist():
        cur, used = used, used + 1
        length[cur] = length[last] + 1
        p = last
        while p != -1 and move[p, c] == -1:
            move[p, c] = cur
            p = link[p]
        if p == -1:
            link[cur] = 0
        else:
            q = int(move[p, c])
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone, used = used, used + 1
                move[clone] = move[q]
                length[clone], link[clone] = length[p] + 1, link[q]
                while p != -1 and move[p, c] == q:
                    move[p, c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return move[:used]


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by a space, and where each text ends (its space included)."""
    points = np.frombuffer(" ".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)


class Parser:
    """Phrases of texts by language. Texts are lower-cased, what is no letter or mark is one space;
    letters outside the samples' alphabet are a phrase each."""

    def __init__(self, samples: dict[str, str]) -> None:
        self.langs = sorted(samples)
        lower, _, inside = _characters()
        every, _ = _points([samples[k] for k in self.langs])
        alphabet = np.unique(lower[every[inside[every]]])
        self.width = len(alphabet) + 2  # 0: space, last: any other letter
        code = np.full(0x110000, self.width - 1, np.uint16)
        code[alphabet] = np.arange(1, len(alphabet) + 1)
        self.code = np.where(inside, code[lower], 0).astype(np.uint16)
        tables, self.base, self.price, at = [], [], [], 0
        for k in self.langs:
            codes, _, _ = self.codes([samples[k]])
            move = suffix_automaton(codes, self.width)
            dead = len(move)  # where nothing goes on: at the start, and after a letter that no phrase has
            move = np.vstack((move, np.full(self.width, -1, np.int32)))
            ends = move < 0
            step = np.where(ends, np.where(move[0] < 0, dead, move[0]), move).astype(np.int64) + at
            tables.append(step * self.width << 1 | ends)
            self.base.append((at + dead) * self.width)
            at += len(move)
            self.price.append(np.log2(max(len(codes), 2)))
        self.table = np.concatenate(tables).ravel().astype(np.int32 if at * self.width < 1 << 30 else np.int64) \
            if tables else np.zeros(0, np.int32)

    def codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Letter codes of all texts with single spaces, each text's end there, its number of letters."""
        points, ends = _points(texts)
        codes = self.code[points]
        keep = codes > 0
        keep[1:] |= codes[:-1] > 0
        kept = np.concatenate(([0], np.cumsum(keep)))
        known = np.concatenate(([0], np.cumsum(_characters()[1][points])))
        return codes[keep], kept[ends], np.diff(known[np.concatenate(([0], ends))])

    def phrases(self, codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of phrases ``[text, language]`` of texts that end at ``ends`` in ``codes``."""
        starts = np.concatenate(([0], ends[:-1]))
        lanes = -(-(ends - starts) // LANE)
        of = np.repeat(np.arange(len(ends)), lanes)
        first = np.repeat(starts, lanes) + LANE * (np.arange(len(of)) - np.repeat(np.cumsum(lanes) - lanes, lanes))
        size = np.minimum(LANE, ends[of] - first)
        order = np.argsort(-size, kind="stable")
        first, size, of = first[order], size[order], of[order]
        active = np.searchsorted(-size, -np.arange(LANE), side="left")  # lanes with a letter at each step
        out = np.zeros((len(ends), len(self.langs)))
        state = np.empty(len(of), self.table.dtype)
        for k, base in enumerate(self.base):
            state[:] = base
            count = np.zeros(len(of), np.int32)
            for s in range(int(size[0]) if len(size) else 0):
                n = active[s]
                nxt = self.table[state[:n] + codes[first[:n] + s]]
                count[:n] += nxt & 1
                np.right_shift(nxt, 1, out=state[:n])
            out[:, k] = np.bincount(of, weights=count, minlength=len(ends))
        return out

    def foreign(self, texts: list[str | None]) -> np.ndarray:
        """Whether a text reads as no learned language: it has no letter, or it is of ``LEAST`` letters at least and
        every language needs more than ``FOREIGN`` phrases a letter, so even pairs of its letters are unknown."""
        codes, ends, known = self.codes([t or "" for t in texts])
        size = np.diff(np.concatenate(([0], ends)))
        if not self.langs:
            return np.zeros(len(texts), bool)
        rate = self.phrases(codes, ends).min(axis=1) / np.maximum(size, 1)
        return (known == 0) | (known >= LEAST) & (rate > FOREIGN)

    def judge(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; ``und`` and 0 without a letter or a learned language."""
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        codes, ends, known = self.codes([t or "" for t in texts])
        size = np.diff(np.concatenate(([0], ends)))
        bits = self.phrases(codes, ends) * self.price / np.maximum(size, 1)[:, None]
        best = bits.argmin(axis=1)
        odds = np.exp2(bits.min(axis=1, keepdims=True) - bits)
        score = np.where(known > 0, 1 / odds.sum(axis=1), 0.0)
        return [self.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())], score


def train(labelled: DataFrame) -> Parser:
    """The parser learned from rows (doc_id, text, lang); a bounded sample, see ``sample``."""
    return Parser(sample(labelled))


def identify(docs: DataFrame, parser: Parser) -> DataFrame:
    """``docs`` with the columns lang_pred and score (names are lengthened if the input has them).

    The whole text counts. lang_pred is ``und`` and score 0 if the text is null or has no letter, or
    nothing was learned; a tie goes to the first language in alphabetical order. Repeated rows and
    null ids each keep their row; an empty table stays empty; other columns pass unchanged.
    """
    columns = docs.columns
    lang, score = free_name(columns, "lang_pred"), free_name(columns, "score")
    shared = docs.sparkSession.sparkContext.broadcast(parser)  # bounded by the sample's bounds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE_BYTES):
            langs, scores = shared.value.judge(b.column(columns.index("text")).to_pylist())
            yield pa.record_batch([*b.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                  names=[*columns, lang, score])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(lang, T.StringType()),
                                              T.StructField(score, T.DoubleType())]))


def recognised(docs: DataFrame, parser: Parser) -> DataFrame:
    """The rows of ``docs`` that read as some learned language (see ``Parser.foreign``); all rows where nothing
    was learned. A null text and a text without a letter read as none."""
    columns = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(parser)  # bounded by the sample's bounds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE_BYTES):
            yield b.filter(pa.array(~shared.value.foreign(b.column(columns.index("text")).to_pylist())))

    return docs.mapInArrow(run, docs.schema)


def predict(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``: learned from the rows whose crc32(doc_id) mod ``folds``
    is not ``held`` and whose lang is known, told for every row. held_out is false for a null id,
    whose row is not learned from either."""
    fold = bucket("doc_id", folds)
    parser = train(docs.select("doc_id", "text", "lang").filter(fold != held))
    told = identify(docs.select("doc_id", "text"), parser)
    return told.select("doc_id", F.coalesce(fold == held, F.lit(False)).alias("held_out"), "lang_pred", "score")
