"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

Each word enters as a hashed word vector beside the scaled sum of the vectors of its hashed character
n-grams (3 and 5 bytes, word edges included, and the word's beginnings). A window of ``WINDOW`` words runs through one recurrent layer in each direction;
attention weighs the states, their sum gives the window's logit. A window begins at every ``STRIDE``-th word, so windows
overlap sixfold and cover every text whole; a document's logit is its largest, turned into a probability by a fitted scale and offset.

Labels are for documents, so windows are chosen while training: at first those with the most telling
words, later those on which the network itself scores highest (one a document, and as many others of
harmless ones). The labelled sample is bounded by ``MAX_TOXIC``, ``MAX_OTHER`` and ``MAX_BYTES``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.bytewords import join_texts, span_hashes, word_spans
from shelfwise.llm.common import bucket, free_name, slices

#: Words in a window, words from one scored window to the next, and from one learned window to the next.
WINDOW, STRIDE, LEARN_STRIDE = 24, 4, 16
#: Bounds of the labelled sample: texts of each kind (their sum is never passed), and bytes of one text.
MAX_TOXIC, MAX_OTHER, MAX_BYTES = 1200, 2400, 8000
WORD_ROWS, GRAM_ROWS, WORD_DIM, GRAM_DIM, HIDDEN, ATTEND = 1 << 15, 1 << 16, 8, 8, 8, 8
#: Lengths in bytes of the word beginnings that count beside the n-grams.
PREFIXES = (4, 5, 6, 7, 8, 9)
ROUNDS, EPOCHS, BATCH, RATE = 3, 4, 256, 0.02
SLICE_BYTES = 2 << 20
CHUNK = 4096
_IS_WORD = np.array([b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A for b in range(256)])


class Words:
    """Words of some texts: each one's number among the distinct ones, and those one's inputs."""

    def __init__(self, texts: list[bytes | None]) -> None:
        raw, at = join_texts(texts, pad=2)
        buf = np.concatenate(([32, 32], np.where(_IS_WORD[raw], raw, 32), [32, 32])).astype(np.uint32)
        starts, ends = word_spans(raw, _IS_WORD)
        self.counts = np.diff(np.append(np.searchsorted(starts, at), len(starts)))
        hashes = span_hashes(raw, starts, ends)
        distinct, first, self.word = np.unique(hashes, return_index=True, return_inverse=True)
        self.rows = (distinct >> np.uint64(64 - 15)).astype(np.int64)
        s, e = starts[first] + 2, ends[first] + 2
        kinds = [(3, e - s, -1), (5, np.maximum(e - s - 2, 0), -1)]  # n bytes, how many in each word, first place
        kinds += [(n, (e - s >= n).astype(np.int64), None) for n in PREFIXES]
        self.per_word = sum(size for _, size, _ in kinds)
        self.gram_at = np.cumsum(self.per_word) - self.per_word
        self.grams, skip = np.empty(int(self.per_word.sum()), np.int64), np.zeros_like(s)
        for n, size, place in kinds:
            k = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            pos = k + np.repeat(s + (place or 0), size)
            h = np.full(len(k), n if place else 100 + n, np.uint32)
            for j in range(n):
                h = (h ^ buf[pos + j]) * np.uint32(0x01000193)
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            self.grams[k + np.repeat(self.gram_at + skip, size)] = h >> np.uint32(16)
            skip = skip + size

    def windows(self, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers ``[window, WINDOW]`` (one past the last word: none), and each window's text."""
        n = np.maximum(1, -(-(self.counts - WINDOW) // stride) + 1)
        of = np.repeat(np.arange(len(n)), n)
        k = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        first = np.cumsum(self.counts) - self.counts
        place = (k * stride)[:, None] + np.arange(WINDOW)
        word = np.append(self.word, len(self.rows))
        inside = place < self.counts[of][:, None]
        return np.where(inside, word[np.where(inside, first[of][:, None] + place, -1)], len(self.rows)), of

    def gram_rows(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """N-grams of the given distinct words, one word after the other, and how many each has."""
        size = self.per_word[words]
        k = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        return self.grams[k + np.repeat(self.gram_at[words], size)], size


def _sums(values: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sum of the rows of each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[new], np.add.reduceat(values[order], new, axis=0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """The weights, forward and backward passes."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.word = np.zeros((WORD_ROWS, WORD_DIM), np.float32)
        self.gram = (0.05 * rng.standard_normal((GRAM_ROWS, GRAM_DIM))).astype(np.float32)
        d = WORD_DIM + GRAM_DIM
        self.w = {f"{k}{s}": v for s in "fb" for k, v in
                  (("x", draw(d, 3 * HIDDEN)), ("o", np.zeros(3 * HIDDEN, np.float32)),
                   ("g", draw(HIDDEN, 2 * HIDDEN)), ("c", draw(HIDDEN, HIDDEN)))}
        self.w |= {"a": draw(2 * HIDDEN, ATTEND), "v": draw(ATTEND, 1), "out": draw(2 * HIDDEN, 1),
                   "bias": np.zeros(1, np.float32)}
        self.scale, self.offset = 1.0, 0.0

    def inputs(self, words: Words, which: np.ndarray) -> np.ndarray:
        """Input vectors of the distinct words ``which``, and a row of zeros for no word."""
        grams, size = words.gram_rows(which)
        out = np.zeros((len(which) + 1, WORD_DIM + GRAM_DIM), np.float32)
        if len(which):
            out[:-1, :WORD_DIM] = self.word[words.rows[which]]
            at = np.cumsum(size) - size
            out[:-1, WORD_DIM:] = np.add.reduceat(self.gram[grams], at, axis=0) / np.sqrt(size, dtype=np.float32)[:, None]
        return out

    def _run(self, gates: np.ndarray, idx: np.ndarray, side: str, keep: list | None) -> np.ndarray:
        """States ``[step, window, HIDDEN]`` of one direction."""
        g, c = self.w[f"g{side}"], self.w[f"c{side}"]
        out = np.empty((WINDOW, len(idx), HIDDEN), np.float32)
        h = np.zeros((len(idx), HIDDEN), np.float32)
        for t in range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1):
            a = gates[idx[:, t]]
            zr = 1 / (1 + np.exp(-(a[:, :2 * HIDDEN] + h @ g)))
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            cand = np.tanh(a[:, 2 * HIDDEN:] + (r * h) @ c)
            if keep is not None:
                keep.append((t, h, z, r, cand))
            h = h + z * (cand - h)
            out[t] = h
        return out

    def forward(self, x: np.ndarray, idx: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of the windows ``idx`` (rows of ``x``; its last row stands for no word)."""
        steps = {"f": [], "b": []} if keep is not None else {"f": None, "b": None}
        states = np.concatenate([self._run(x @ self.w[f"x{s}"] + self.w[f"o{s}"], idx, s, steps[s]) for s in "fb"], axis=2)
        tan = np.tanh(states @ self.w["a"])
        e = (tan @ self.w["v"])[:, :, 0]
        real = (idx < len(x) - 1).T
        weight = np.exp(e - e.max(axis=0)) * real
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        pooled = np.einsum("tb,tbh->bh", weight, states)
        if keep is not None:
            keep |= {"steps": steps, "states": states, "tan": tan, "weight": weight, "pooled": pooled}
        return (pooled @ self.w["out"])[:, 0] + self.w["bias"][0]

    def gradients(self, x: np.ndarray, idx: np.ndarray, y: np.ndarray) -> tuple[dict, np.ndarray, float]:
        """Of the mean logistic loss: by weight, by row of ``x``; and the loss."""
        k: dict = {}
        logit = self.forward(x, idx, k)
        p = _sigmoid(logit)
        d = ((p - y) / len(y)).astype(np.float32)
        w, states, tan, weight = self.w, k["states"], k["tan"], k["weight"]
        out = {"out": k["pooled"].T @ d[:, None], "bias": np.array([d.sum()], np.float32)}
        d_pool = d[:, None] * w["out"][:, 0]
        d_weight = np.einsum("bh,tbh->tb", d_pool, states)
        d_e = weight * (d_weight - (weight * d_weight).sum(axis=0))
        d_tan = d_e[:, :, None] * w["v"][:, 0] * (1 - tan * tan)
        out["v"] = np.einsum("tba,tb->a", tan, d_e)[:, None]
        out["a"] = np.einsum("tbh,tba->ha", states, d_tan)
        d_states = weight[:, :, None] * d_pool + d_tan @ w["a"].T
        d_x = np.zeros_like(x)
        for s, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
            g, c = w[f"g{s}"], w[f"c{s}"]
            d_gates, each, at = np.zeros((len(x), 3 * HIDDEN), np.float32), [], []
            d_g, d_c, d_h = np.zeros_like(g), np.zeros_like(c), np.zeros((len(idx), HIDDEN), np.float32)
            for t, h, z, r, cand in reversed(k["steps"][s]):
                d_h = d_h + d_states[t][:, part]
                d_cand = d_h * z * (1 - cand * cand)
                d_rh = d_cand @ c.T
                d_c += (r * h).T @ d_cand
                d_zr = np.concatenate((d_h * (cand - h) * z * (1 - z), d_rh * h * r * (1 - r)), axis=1)
                d_g += h.T @ d_zr
                each.append(np.concatenate((d_zr, d_cand), axis=1))
                at.append(idx[:, t])
                d_h = d_h * (1 - z) + d_rh * r + d_zr @ g.T
            rows, sums = _sums(np.concatenate(each), np.concatenate(at))
            d_gates[rows] = sums
            out |= {f"g{s}": d_g, f"c{s}": d_c, f"x{s}": x.T @ d_gates, f"o{s}": d_gates.sum(axis=0)}
            d_x += d_gates @ w[f"x{s}"].T
        loss = -np.mean(np.log(np.where(y > 0, p, 1 - p) + 1e-9))
        return out, d_x, float(loss)

    def logits(self, words: Words, idx: np.ndarray) -> np.ndarray:
        x = self.inputs(words, np.arange(len(words.rows)))
        return np.concatenate([self.forward(x, idx[s:s + CHUNK]) for s in range(0, len(idx), CHUNK)] or [np.zeros(0)])

    def scored(self, x: np.ndarray, gates: dict[str, np.ndarray], idx: np.ndarray) -> np.ndarray:
        """What ``forward`` gives, without what learning needs; ``gates``: the words' part of the gates by direction."""
        column, n = np.ascontiguousarray(idx.T), len(idx)
        states = np.empty((WINDOW, n, 2 * HIDDEN), np.float32)
        for s, part, steps in (("f", slice(0, HIDDEN), range(WINDOW)), ("b", slice(HIDDEN, 2 * HIDDEN), range(WINDOW - 1, -1, -1))):
            g, c, h = self.w[f"g{s}"], self.w[f"c{s}"], np.zeros((n, HIDDEN), np.float32)
            for t in steps:
                a = gates[s].take(column[t], axis=0)
                zr = h @ g
                zr += a[:, :2 * HIDDEN]
                np.exp(np.negative(zr, out=zr), out=zr)
                zr += 1
                np.reciprocal(zr, out=zr)
                cand = (zr[:, HIDDEN:] * h) @ c
                cand += a[:, 2 * HIDDEN:]
                np.tanh(cand, out=cand)
                cand -= h
                cand *= zr[:, :HIDDEN]
                h = h + cand
                states[t, :, part] = h
        flat = states.reshape(WINDOW * n, 2 * HIDDEN)
        tan = flat @ self.w["a"]
        e = (np.tanh(tan, out=tan) @ self.w["v"]).reshape(WINDOW, n)
        weight = np.exp(e - e.max(axis=0)) * (column < len(x) - 1)
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        return (weight * (flat @ self.w["out"]).reshape(WINDOW, n)).sum(axis=0) + self.w["bias"][0]

    def document_logits(self, texts: list[bytes | None]) -> np.ndarray:
        """Largest window logit of each text; a text without words has one empty window."""
        if not len(texts):
            return np.zeros(0)
        words = Words(texts)
        idx, of = words.windows()
        x = self.inputs(words, np.arange(len(words.rows)))
        gates = {s: x @ self.w[f"x{s}"] + self.w[f"o{s}"] for s in "fb"}
        logit = np.concatenate([self.scored(x, gates, idx[k:k + CHUNK]) for k in range(0, len(idx), CHUNK)])
        return np.maximum.reduceat(logit, np.searchsorted(of, np.arange(len(texts))))

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        return _sigmoid(self.scale * self.document_logits(texts).astype(float) + self.offset)


def _telling(net: Network, words: Words, doc_of_word: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Start the first component of both vector tables at the log odds of the labels of the documents
    that hold the word or n-gram; returns the sum of both for each distinct word."""
    held = {"word": np.zeros((2, WORD_ROWS)), "gram": np.zeros((2, GRAM_ROWS))}
    for first in range(0, len(toxic), 100):  # a hundred documents at a time: this runs on the driver
        part = (doc_of_word >= first) & (doc_of_word < first + 100)
        pairs = np.unique(words.word[part] * 100 + doc_of_word[part] - first)
        word, doc = pairs // 100, pairs % 100
        grams, size = words.gram_rows(word)
        for name, row, of in (("word", words.rows[word], doc), ("gram", grams, np.repeat(doc, size))):
            pair = np.unique(row * 100 + of)
            np.add.at(held[name], (toxic[first + pair % 100].astype(int), pair // 100), 1)

    def odds(count: np.ndarray) -> np.ndarray:
        share = (count + 0.5) / (np.array([[(~toxic).sum()], [toxic.sum()]]) + 1)
        return np.clip(np.log(share[1] / share[0]), -4, 4) * (count.sum(axis=0) >= 3)

    by_word, by_gram = odds(held["word"]), odds(held["gram"])
    net.word[:, 0], net.gram[:, 0] = 0.5 * by_word, 0.5 * by_gram
    at = np.cumsum(words.per_word) - words.per_word
    return by_word[words.rows] + np.maximum.reduceat(by_gram[words.grams], at)


def train(texts: list[bytes | None], toxic: list[int], seed: int = 7) -> Network:
    """Learn from texts and labels. Without texts of both kinds every score is the share of toxic ones."""
    net = Network(seed)
    y = np.array(toxic, bool)
    if not len(y) or y.all() or not y.any():
        net.w["out"][:] = 0
        net.scale, net.offset = 0.0, (-3.0 if not len(y) or not y.any() else 3.0)
        return net
    rng = np.random.default_rng(seed)
    words = Words(texts)
    if not len(words.rows):
        net.w["out"][:] = 0
        net.scale, net.offset = 0.0, float(np.log(y.mean() / (1 - y.mean())))
        return net
    idx, of = words.windows(LEARN_STRIDE)
    at = np.searchsorted(of, np.arange(len(y)))
    tell = np.append(_telling(net, words, np.repeat(np.arange(len(y)), words.counts), y), -9.0)
    score = np.sort(tell[idx], axis=1)[:, -3:].sum(axis=1)
    adam = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.w.items()}
    squares = {"word": np.full(WORD_ROWS, 1e-6, np.float32), "gram": np.full(GRAM_ROWS, 1e-6, np.float32)}
    step = 0
    for _ in range(ROUNDS):
        rank = np.lexsort((-score, of))
        place = np.arange(len(of)) - at[of[rank]]
        hard = rank[place < 1]
        other = np.flatnonzero(~y[of])
        chosen = np.concatenate((hard, rng.choice(other, min(len(other), len(hard)), replace=False)))
        for _ in range(EPOCHS):
            for part in np.array_split(rng.permutation(chosen), max(1, len(chosen) // BATCH)):
                step += 1
                which, local = np.unique(idx[part], return_inverse=True)
                has_none = which[-1] == len(words.rows)
                which = which[:-1] if has_none else which
                x = net.inputs(words, which)
                grad, d_x, _ = net.gradients(x, local.reshape(len(part), WINDOW), y[of[part]].astype(np.float32))
                for k, g in grad.items():
                    m, v = adam[k]
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    net.w[k] -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
                grams, size = words.gram_rows(which)
                each = np.repeat(d_x[:-1, WORD_DIM:] / np.sqrt(size, dtype=np.float32)[:, None], size, axis=0)
                for name, (rows, g) in (("word", _sums(d_x[:-1, :WORD_DIM], words.rows[which])), ("gram", _sums(each, grams))):
                    squares[name][rows] += (g * g).mean(axis=1)
                    getattr(net, name)[rows] -= RATE * g / np.sqrt(squares[name][rows])[:, None]
        score = net.logits(words, idx)
    del words, idx, of
    logit = [net.document_logits(texts[k:k + 100]) for k in range(0, len(texts), 100)]   # a hundred at a time: this runs on the driver
    _calibrate(net, np.concatenate(logit).astype(float), y)
    return net


def _calibrate(net: Network, logit: np.ndarray, y: np.ndarray) -> None:
    """Scale and offset by logistic regression on the sample's documents, drawn towards scale 1."""
    a, b = 1.0, 0.0
    for _ in range(500):
        d = _sigmoid(a * logit + b) - y
        a -= 0.05 * ((d * logit).mean() + 0.01 * (a - 1))
        b -= 0.2 * (d.mean() + 0.01 * b)
    net.scale, net.offset = max(a, 0.05), b


def sample(docs: DataFrame, labels: DataFrame) -> tuple[list[bytes], list[int]]:
    """Texts and labels of a bounded sample of the rows that ``docs`` and ``labels`` (doc_id, toxic) share,
    spread by a hash: about ``MAX_TOXIC`` and ``MAX_OTHER`` rows, never more than both together. The labels are
    counted first; the ids that the hash puts in front, a bounded number, are broadcast to the texts."""
    most = MAX_TOXIC + MAX_OTHER
    rows = (labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
            .select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct())
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.xxhash64("doc_id", F.lit("toxicity")) / F.lit(2.0**64) + 0.5
    place = share * F.when(F.col("toxic") == 1, n.get(1, 0) / MAX_TOXIC).otherwise(n.get(0, 0) / MAX_OTHER)
    few = rows.withColumn("place", place).filter("place < 2").orderBy("place", "doc_id").limit(2 * most)
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).filter(F.octet_length("text") <= MAX_BYTES)
    got = (texts.join(F.broadcast(few), "doc_id").orderBy("place", "doc_id", "text").limit(most)
           .select("text", "toxic").collect())
    return [bytes(r["text"]) for r in got], [r["toxic"] for r in got]


def score(docs: DataFrame, net: Network) -> DataFrame:
    """``docs`` with the columns score (0 to 1) and predicted (names are lengthened if the input has them).

    Every overlapping window of the whole text counts. Null, empty and wordless texts get the score of a
    window without words. Repeated rows and null ids each keep their row; an empty table stays empty;
    other columns pass unchanged and are no input.
    """
    columns = docs.columns
    score_name, predicted = free_name(columns, "score"), free_name(columns, "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(net)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE_BYTES):
            p = shared.value.scores(b.column(columns.index("text")).cast(pa.large_binary()).to_pylist())
            yield pa.record_batch([*b.columns, pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))],
                                  names=[*columns, score_name, predicted])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(score_name, T.DoubleType()),
                                              T.StructField(predicted, T.IntegerType())]))


def learn(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> Network:
    """The network learned from the rows whose crc32(doc_id) mod ``folds`` is not ``held``."""
    return train(*sample(docs, labels.filter(bucket("doc_id", folds) != held)))


def predict(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row; held_out is false for a null id."""
    told = score(docs.select("doc_id", "text"), learn(docs, labels, folds, held))
    return told.select("doc_id", F.coalesce(bucket("doc_id", folds) == held, F.lit(False)).alias("held_out"),
                       "score", "predicted")
