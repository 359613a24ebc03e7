"""Alignment of two tokenizers' tokens by merge-path partitioning.

A document's tokens under A and under B are two ascending lists of byte ends. Merging the lists (of equal ends
A's first) visits every pair of overlapping tokens once: a step that consumes an end emits the pair of tokens it
stands in, but for a B end that equals the A end before it, which closes a group.

The merge is cut by diagonals, ``size`` steps apart: on diagonal d a binary search finds how many of the first d
ends are A's. So pieces are independent and of equal work, however long a document is; each is a row with
the ids it needs. A piece emits its overlaps, its closed groups and the two open ones at its borders;
the open ones of neighbouring pieces are stitched into groups.

Pair counts of the whole corpus come from the pieces' overlaps, added up before they are shuffled. They are
looked up in tables of at most ``max_pairs`` pairs, one broadcast each; a document's sums over the tables add up.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator
from functools import reduce
from itertools import chain
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import slices, stored
from shelfwise.llm.packing import _Lists, _Numbers

#: Steps of the merge in a piece.
PIECE = 1 << 14
#: Pairs in one broadcast table (17 bytes each).
MAX_PAIRS = 2_000_000
#: Distinct pairs a task adds up before it hands them on.
TASK_PAIRS = 1_000_000
SLICE_BYTES = 2 << 20
#: Words that a worker's tables hold before they are dropped.
CACHE_WORDS = 300_000
#: New words encoded as one text.
LEARN_WORDS = 4096
#: White space of ASCII, and other.
_ASCII_SPACE = " \t\n\v\f\r\x1c\x1d\x1e\x1f"
_LOOSE_SPACE = [p for c in _ASCII_SPACE for p in (c + " ", " " + c)]
_OTHER_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Steps worked on at once.
BLOCK_STEPS = 1 << 19
#: The byte-level pre-tokenizer's pattern (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECES = ("key long, piece int, pieces int, doc_id long, n_a long, n_b long, a_steps long, b_steps long, "
          "a_start long, b_start long, a binary, b binary")
ALIGNED = ("key long, piece int, pieces int, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
           "count_sum long, groups string, head_a string, head_b string, tail_a string, tail_b string")


class ByteTokenizer:
    """Ids of a byte-level BPE file. Where the file's merges are numbered in their order, the faster library
    is used; both give the same ids."""

    def __init__(self, path: str) -> None:
        spec = json.load(open(path, encoding="utf-8"))
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte_of = {chr(b): b for b in plain}
        byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocabulary = {k: v for k, v in spec["model"]["vocab"].items() if k not in special}
        size = max([*vocabulary.values(), *special.values()]) + 1
        self.bytes = [b""] * size
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(byte_of[c] for c in token)
        self.sizes = np.array([len(t) for t in self.bytes], np.int64)
        merged = [vocabulary.get("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in spec["model"]["merges"]]
        before = spec["pre_tokenizer"] or {}
        self.by_words = not spec["normalizer"] and before.get("type") == "ByteLevel" and before.get("use_regex", True)
        if (None not in merged and merged == sorted(merged) and not spec["normalizer"]
                and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")):
            import tiktoken

            ranks = {self.bytes[i]: i for i in vocabulary.values()}
            self.encode = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer

            whole = Tokenizer.from_file(path)
            whole.encode_special_tokens = True
            self.encode = lambda text: whole.encode(text, add_special_tokens=False).ids


class PieceTokenizer:
    """Ids of a sentencepiece model with byte fallback."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.bytes = [bytes([int(n[3:5], 16)]) if model.is_byte(i) else n.replace("▁", " ").encode()
                      for i, n in enumerate(names)]
        self.sizes = np.array([len(t) for t in self.bytes], np.int64)
        self.encode = functools.partial(model.encode, num_threads=1)


class Words:
    """Ids of texts by both tokenizers, with each word encoded once.

    Where single spaces stand between words that neither begin nor end with white space, no token of A or B reaches
    from one word into the next space: A's pattern starts anew at each such space, and no piece of B
    has a space sign behind another sign. So a text's ids are those of its words, each with its space. Other texts
    go through the tokenizers whole. Tables are dropped when they reach ``CACHE_WORDS`` words.
    """

    def __init__(self, a: ByteTokenizer, b: PieceTokenizer) -> None:
        self.a, self.b = a, b
        self.apart = a.by_words and not any(b" " in t.lstrip(b" ") for t in b.bytes)
        self._clear()

    def _clear(self) -> None:
        self.words, self.a_ids, self.b_ids, self.good = _Numbers(), _Lists(), _Lists(), np.zeros(0, bool)

    def _true(self, raw: bytes, a: list[int], b: list[int]) -> bool:
        """Whether both lists of tokens give back the space and the text."""
        want = b" " + raw
        return (b"".join(map(self.a.bytes.__getitem__, a)) == want) and (b"".join(map(self.b.bytes.__getitem__, b)) == want)

    def _learn(self) -> None:
        new, self.words.new = self.words.new, []
        for i in range(0, len(new), LEARN_WORDS):
            self._learn_part(new[i: i + LEARN_WORDS])

    def _learn_part(self, words: list[str]) -> None:
        """Encode the words as one text and cut its tokens at the words' ends; one by one, should some not be given back."""
        text = " ".join(words)
        a, b = self.a.encode(" " + text), self.b.encode(text)
        if good := self._true(text.encode(), a, b):
            ends = np.cumsum([len(w.encode()) + 1 for w in words])
            for table, sizes, ids in ((self.a_ids, self.a.sizes, a), (self.b_ids, self.b.sizes, b)):
                ids = np.array(ids, np.int64)
                table.add(ids, np.diff(np.searchsorted(np.cumsum(sizes[ids]), ends, side="right"), prepend=0))
            good = [True] * len(words)
        else:
            both = [(self.a.encode(" " + w), self.b.encode(w)) for w in words]
            for table, lists in zip((self.a_ids, self.b_ids), zip(*both)):
                table.add(np.fromiter(chain.from_iterable(lists), np.int64), np.array([len(x) for x in lists], np.int64))
            good = [self._true(w.encode(), x, y) for w, (x, y) in zip(words, both)]
        self.good = np.concatenate((self.good, np.array(good, bool)))

    def encode(self, raws: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and of B for each text; none where the text is empty or not given back by both."""
        if len(self.words) > CACHE_WORDS:
            self._clear()
        number, counts, which, own = self.words.__getitem__, [], [], {}
        for k, raw in enumerate(raws):
            try:
                text = raw.decode()
            except UnicodeDecodeError:   # no token of B gives such bytes back
                text = ""
            words = text.split(" ") if text and self.apart and not _loose(text) else []
            counts.append(len(words))
            which.extend(map(number, words))
            if text and not words:
                a, b = self.a.encode(" " + text), self.b.encode(text)
                own[k] = (a, b) if self._true(raw, a, b) else ([], [])
        if self.words.new:
            self._learn()
        which, stop = np.array(which, np.int64), np.cumsum(counts, dtype=np.int64)
        bad = np.concatenate(([0], np.cumsum(~self.good[which])))
        both = [table.gather(which) for table in (self.a_ids, self.b_ids)]
        at = [np.concatenate(([0], np.cumsum(size))) for _, size in both]
        none = np.zeros(0, np.int64)
        for k, (j, n) in enumerate(zip(stop.tolist(), counts)):
            if k in own:
                yield tuple(np.array(x, np.int64) for x in own[k])
            elif not n or bad[j] != bad[j - n]:
                yield none, none
            else:
                yield tuple(flat[edge[j - n]:edge[j]].astype(np.int64) for (flat, _), edge in zip(both, at))


def _loose(text: str) -> bool:
    """Whether white space stands at an edge of the text or of a word, or is not of ASCII."""
    return (text[0] in _ASCII_SPACE or text[-1] in _ASCII_SPACE or any(p in text for p in _LOOSE_SPACE)
            or not text.isascii() and bool(_OTHER_SPACE.search(text)))


@functools.cache
def _tokenizers(a_path: str, b_path: str) -> SimpleNamespace:
    """Both tokenizers, the byte lengths of their tokens and the word tables, once a Python worker."""
    a, b = ByteTokenizer(a_path), PieceTokenizer(b_path)
    width = "<u2" if max(len(a.sizes), len(b.sizes)) <= 1 << 16 else "<u4"
    return SimpleNamespace(words=Words(a, b), a_size=a.sizes, b_size=b.sizes, width=width)


def diagonal(a: np.ndarray, b: np.ndarray, d: np.ndarray) -> np.ndarray:
    """How many of the first ``d`` ends of the merge of ``a`` and ``b`` (equal ends: ``a``'s first) are ``a``'s; by
    binary search on each diagonal."""
    low, high = np.maximum(d - len(b), 0), np.minimum(d, len(a))
    while (open_ := low < high).any():
        i = (low + high) >> 1
        first = open_ & (a[np.minimum(i, len(a) - 1)] <= b[np.clip(d - 1 - i, 0, max(len(b) - 1, 0))])
        low, high = np.where(first, i + 1, low), np.where(open_ & ~first, i, high)
    return low


def _pieces(key: int, doc_id: int | None, a: np.ndarray, b: np.ndarray, tools: SimpleNamespace, size: int) -> Iterator[tuple]:
    """Rows of a document's pieces."""
    steps = len(a) + len(b)
    n = max(1, -(-steps // size))
    if n == 1:
        yield (key, 0, 1, doc_id, len(a), len(b), len(a), len(b), 0, 0, a.astype(tools.width).tobytes(),
               b.astype(tools.width).tobytes())
        return
    a_end, b_end = np.cumsum(tools.a_size[a]), np.cumsum(tools.b_size[b])
    d = np.minimum(np.arange(n + 1) * size, steps)
    at_a = diagonal(a_end, b_end, d)
    at_b = d - at_a
    a_from, b_from = np.concatenate(([0], a_end)), np.concatenate(([0], b_end))
    for p, (i, i2, j, j2) in enumerate(zip(at_a[:-1].tolist(), at_a[1:].tolist(), at_b[:-1].tolist(), at_b[1:].tolist())):
        yield (key, p, n, doc_id, len(a), len(b), i2 - i, j2 - j, int(a_from[i]), int(b_from[j]),
               a[i:i2 + 1].astype(tools.width).tobytes(), b[j:j2 + 1].astype(tools.width).tobytes())


def cut(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
        size: int = PIECE) -> DataFrame:
    """Pieces of all documents, ``size`` steps each. A document without tokens (text null, empty, no valid UTF-8, or bytes of its
    tokens that differ from space + text) has one piece without steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, key = _tokenizers(a_path, b_path), TaskContext.get().partitionId() << 33
        for batch in slices(batches, "text", SLICE_BYTES):
            rows = []
            for doc_id, (a, b) in zip(batch.column(0).to_pylist(), tools.words.encode([r or b"" for r in batch.column(1).to_pylist()])):
                rows += _pieces(key, doc_id, a, b, tools, size)
                key += 1
            yield _batch(rows, _PIECES_ARROW)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, PIECES)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


_LONG = pa.int64()
_PIECES_ARROW = pa.schema([("key", _LONG), ("piece", pa.int32()), ("pieces", pa.int32()), ("doc_id", _LONG), ("n_a", _LONG),
                           ("n_b", _LONG), ("a_steps", _LONG), ("b_steps", _LONG), ("a_start", _LONG), ("b_start", _LONG),
                           ("a", pa.binary()), ("b", pa.binary())])
_ALIGNED_ARROW = pa.schema([*list(_PIECES_ARROW)[:6], ("n_groups", _LONG), ("n_links", _LONG), ("n_best", _LONG),
                            ("count_sum", _LONG), ("groups", pa.string()), ("head_a", pa.string()), ("head_b", pa.string()),
                            ("tail_a", pa.string()), ("tail_b", pa.string())])


def _ranges(sizes: np.ndarray) -> np.ndarray:
    """0..n-1 for each of ``sizes``, one after the other."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class _Side:
    """One tokenizer's tokens of many pieces: all ids, where each piece's begin, its steps and their ends."""

    def __init__(self, ids: pa.Array, steps: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: str) -> None:
        raw = ids.to_pylist()
        held = np.array([len(r) for r in raw], np.int64) // np.dtype(width).itemsize
        self.ids = np.frombuffer(b"".join(raw), width).astype(np.int64)
        self.first = np.cumsum(held) - held
        self.steps, self.before = steps, np.cumsum(steps) - steps
        self.piece = np.repeat(np.arange(len(steps)), steps)
        self.token = self.first[self.piece] + _ranges(steps)
        run = np.concatenate(([0], np.cumsum(sizes[self.ids])))
        self.start = starts
        self.end = run[self.token + 1] - run[self.first][self.piece] + starts[self.piece]
        self.stop = starts + run[self.first + held] - run[self.first]


class Merge:
    """The merge of many pieces at once: each lies in a stretch of its own on one line of bytes."""

    def __init__(self, batch: pa.RecordBatch, tools: SimpleNamespace) -> None:
        number = {c: batch.column(c).to_numpy() for c in ("a_steps", "b_steps", "a_start", "b_start")}
        a = self.a = _Side(batch.column("a"), number["a_steps"], number["a_start"], tools.a_size, tools.width)
        b = self.b = _Side(batch.column("b"), number["b_steps"], number["b_start"], tools.b_size, tools.width)
        low, high = np.minimum(a.start, b.start), np.maximum(a.stop, b.stop)
        shift = np.cumsum(high - low + 1) - (high - low + 1) - low
        a_end, b_end = a.end + shift[a.piece], b.end + shift[b.piece]
        at_b, at_a = np.searchsorted(b_end, a_end, "left"), np.searchsorted(a_end, b_end, "right")
        # an A step stands in the B token that is open then, and the other way round
        mate_b = b.first[a.piece] + at_b - b.before[a.piece]
        inside = at_a - a.before[b.piece]
        last = np.where(inside > 0, a_end[np.maximum(at_a - 1, 0)] if len(a_end) else 0, (a.start + shift)[b.piece])
        self.tie = last == b_end
        free = ~self.tie
        mate_a = a.first[b.piece[free]] + inside[free]
        self.link_a = np.concatenate((a.ids[a.token], a.ids[mate_a]))
        self.link_b = np.concatenate((b.ids[mate_b], b.ids[b.token[free]]))
        self.link_piece = np.concatenate((a.piece, b.piece[free]))
        self.pieces = len(low)
        self.ties = np.bincount(b.piece[self.tie], minlength=self.pieces)
        self.links = np.bincount(self.link_piece, minlength=self.pieces)
        tied = np.concatenate(([0], np.cumsum(self.tie)))
        # groups are numbered over all pieces; each piece has one more than ties: what is open at its end
        self.group_a, self.group_b = tied[at_b] + a.piece, tied[:-1] + b.piece

    def text(self, digits: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All groups as bytes, ids in order with a separator after each, and the place in the bytes where each
        group's A ids and B ids begin; with one more place at the end."""
        n = int((self.ties + 1).sum())
        in_a, in_b = np.bincount(self.group_a, minlength=n), np.bincount(self.group_b, minlength=n)
        start = np.cumsum(in_a + in_b) - in_a - in_b
        order = np.empty(len(self.group_a) + len(self.group_b), np.int64)
        mark = np.full(len(order), ord(","), np.uint8)
        order[start[self.group_a] + np.arange(len(self.group_a)) - (np.cumsum(in_a) - in_a)[self.group_a]] = self.a.ids[self.a.token]
        order[(start + in_a)[self.group_b] + np.arange(len(self.group_b)) - (np.cumsum(in_b) - in_b)[self.group_b]] = self.b.ids[self.b.token]
        mark[(start + in_a)[in_a > 0] - 1] = ord("|")
        mark[(start + in_a + in_b)[in_b > 0] - 1] = ord(";")
        rows, size = digits[order], lengths[order]
        rows[np.arange(len(order)), size] = mark
        flat = rows[np.arange(digits.shape[1]) <= size[:, None]]
        place = np.concatenate(([0], np.cumsum(size + 1)))
        return flat, place[np.append(start, len(order))], place[start + in_a]


@functools.cache
def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0..n-1, a free byte after them, and their number."""
    width = len(str(n)) + 1
    rows = np.zeros((n, width), np.uint8)
    lengths = np.array([len(str(i)) for i in range(n)], np.int64)
    for k in range(1, width):
        which = np.flatnonzero(lengths == k)
        for p in range(k):
            rows[which, p] = which // 10 ** (k - 1 - p) % 10 + ord("0")
    return rows, lengths


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches of about ``size`` steps."""
    for batch in batches:
        if not batch.num_rows:
            continue
        steps = batch.column("a_steps").to_numpy() + batch.column("b_steps").to_numpy()
        part = (np.cumsum(steps) - 1) // size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for i, j in zip(cuts, cuts[1:]):
            yield batch.slice(i, j - i)


def _sum_up(held: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Counted codes of several blocks as one: distinct codes and their counts."""
    codes, counts = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.add.reduceat(counts, first) if len(codes) else counts


def _pairs(codes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(codes >> 32), pa.array(codes & 0xFFFFFFFF), pa.array(counts)], names=["a", "b", "n"])


def pair_counts(pieces: DataFrame, a_path: str, b_path: str, block: int = BLOCK_STEPS, most: int = TASK_PAIRS) -> DataFrame:
    """(a, b, n): how many links of the corpus hold the id pair; added up in the tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = _tokenizers(a_path, b_path)
        held, size = [], 0
        for batch in _blocks(batches, block):
            m = Merge(batch, tools)
            held.append(np.unique((m.link_a << 32) | m.link_b, return_counts=True))
            size += len(held[-1][0])
            if size > 2 * most:
                held = [_sum_up(held)]
                size = len(held[0][0])
                if size > most:
                    yield _pairs(*held[0])
                    held, size = [], 0
        if held:
            yield _pairs(*_sum_up(held))

    return pieces.mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def _tables(counts: DataFrame, most: int) -> list[tuple]:
    """The counted pairs in broadcast tables of about ``most`` pairs at most: codes, counts, whether best.

    Beyond ``most`` they are split by a hash, so that each table is about half full. Their number is
    bounded by the vocabularies, not by the corpus."""
    spark = counts.sparkSession.sparkContext
    n = counts.count()
    k = 1 if n <= most else -(-2 * n // most)
    share = F.pmod(F.xxhash64("a", "b"), F.lit(k).cast("long"))
    tables = []
    for r in range(k):
        part = (counts if k == 1 else counts.filter(share == r)).select(
            F.col("a").cast("long") * (1 << 32) + F.col("b"), "n", "best").toArrow()
        codes = part.column(0).to_numpy()
        order = np.argsort(codes)
        tables.append(spark.broadcast((codes[order], part["n"].to_numpy()[order], part["best"].to_numpy()[order])))
    return tables


def _aligned(pieces: DataFrame, table, whole: bool, a_path: str, b_path: str, block: int) -> DataFrame:
    """Per piece its sums over the pairs of ``table`` and, if ``whole``, its groups and numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = _tokenizers(a_path, b_path)
        codes, counts, best = table.value
        digits, lengths = _digits(max(len(tools.a_size), len(tools.b_size)))
        for batch in _blocks(batches, block):
            m = Merge(batch, tools)
            own, where = np.unique((m.link_a << 32) | m.link_b, return_inverse=True)
            at = np.minimum(np.searchsorted(codes, own), max(len(codes) - 1, 0))
            found = (codes[at] == own) if len(codes) else np.zeros(len(own), bool)
            n = np.where(found, counts[at], 0) if len(codes) else np.zeros(len(own), np.int64)
            good = found & best[at] if len(codes) else found
            order = np.argsort(m.link_piece, kind="stable")
            where, edge = where[order], np.concatenate(([0], np.cumsum(m.links)))
            sums, bests = (np.concatenate(([0], np.cumsum(x[where])))[edge] for x in (n, good.astype(np.int64)))
            columns = [batch.column(c) for c in _PIECES_ARROW.names[:6]]
            numbers = [pa.array(m.ties * whole), pa.array(m.links * whole), pa.array(np.diff(bests)), pa.array(np.diff(sums))]
            texts = _fragments(m, digits, lengths, batch.column("pieces").to_pylist()) if whole else [[None] * m.pieces] * 5
            yield pa.record_batch([*columns, *numbers, *(pa.array(t, pa.string()) for t in texts)], schema=_ALIGNED_ARROW)

    return pieces.mapInArrow(run, ALIGNED)


def _fragments(m: Merge, digits: np.ndarray, lengths: np.ndarray, pieces: list[int]) -> list[list]:
    """Per piece: its groups, or, where the document has several pieces, the closed inner ones and the ids of
    the open first and last group (the last null where no group closes in the piece)."""
    flat, a_at, b_at = m.text(digits, lengths)
    raw = flat.tobytes().decode("ascii")
    first = np.cumsum(m.ties + 1) - m.ties - 1
    edges = zip(*(x.tolist() for x in (a_at[first], b_at[first], a_at[first + 1], a_at[first + m.ties], b_at[first + m.ties],
                                       a_at[first + m.ties + 1])))
    out: list[list] = [[], [], [], [], []]
    for n, t, (head_a, head_b, second, tail_a, tail_b, end) in zip(pieces, m.ties.tolist(), edges):
        if n == 1:
            row = (raw[head_a:end][:-1], None, None, None, None)
        else:
            tail = (raw[tail_a:tail_b][:-1], raw[tail_b:end][:-1]) if t else (None, None)
            row = (raw[second:tail_a][:-1] if t else "", raw[head_a:head_b][:-1], raw[head_b:second][:-1], *tail)
        for column, value in zip(out, row):
            column.append(value)
    return out


def _stitch(table: pa.Table) -> pa.Table:
    """The groups of one document from its pieces: what is open at a border goes on in the next piece."""
    rows = sorted(table.to_pylist(), key=lambda r: r["piece"])
    done: list[str] = []
    a: list[str] = []
    b: list[str] = []
    for r in rows:
        a.append(r["head_a"])
        b.append(r["head_b"])
        if r["tail_a"] is not None:
            done += [f"{','.join(filter(None, a))}|{','.join(filter(None, b))}", r["groups"]]
            a, b = [r["tail_a"]], [r["tail_b"]]
    out = dict(rows[0], piece=0, groups=";".join(filter(None, done)), head_a=None, head_b=None, tail_a=None, tail_b=None)
    out |= {c: sum(r[c] for r in rows) for c in ("n_groups", "n_links", "n_best", "count_sum")}
    return pa.Table.from_pylist([out], schema=_ALIGNED_ARROW)


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = PIECE,
          block: int = BLOCK_STEPS, task_pairs: int = TASK_PAIRS, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    ``a_path``: byte-level BPE file for space + text; ``b_path``: sentencepiece model that adds the space itself.
    Places where tokens of both end cut them into groups (``groups``: ``a1,a2|b1;a3|b2,b3``); a link is a pair of
    tokens whose bytes overlap; an id pair's count is its number of links in all documents, ``count_sum``
    the sum of the counts of a document's links, ``n_best`` its links whose count is the highest of their B id (ties
    included). Texts that are null, empty, no valid UTF-8 or not given back by both tokenizers have no
    tokens: zeros and empty ``groups``. Repeated rows and null ids are documents of their own; other columns are
    ignored; an empty table gives no row.
    """
    pieces = stored(cut(docs, a_path, b_path, id_col, text_col, size), "align-pieces")
    counts = pair_counts(pieces, a_path, b_path, block, task_pairs)
    highest = F.max("n").over(Window.partitionBy("b"))  # at most the vocabulary of A in a window
    tables = _tables(stored(counts.select("a", "b", "n", (F.col("n") == highest).alias("best")), "align-pairs"), max_pairs)
    short, long = pieces.filter("pieces = 1"), pieces.filter("pieces > 1")
    parts = [[_aligned(p, t, i == 0, a_path, b_path, block) for i, t in enumerate(tables)] for p in (short, long)]
    whole, broken = (reduce(DataFrame.unionByName, p) for p in parts)
    if len(tables) > 1:
        whole, broken = _added(whole), _added(broken)
    stitched = broken.groupBy("key").applyInArrow(_stitch, ALIGNED)
    return whole.unionByName(stitched).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


def _added(parts: DataFrame) -> DataFrame:
    """A piece's rows of several tables in one."""
    return (parts.groupBy("key", "piece", "pieces", "doc_id", "n_a", "n_b")
            .agg(*(F.sum(c).alias(c) for c in ("n_groups", "n_links", "n_best", "count_sum")),
                 *(F.max(c).alias(c) for c in ("groups", "head_a", "head_b", "tail_a", "tail_b"))))
