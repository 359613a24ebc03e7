"""Benchmark decontamination over a distributed positional inverted index.

Every token of the training texts is posted: a segment of the index (one stored row, ``SEGMENT_BYTES``
of text, or one longer document) holds its sorted terms and, for each, the positions where it stands.
Segments are split by document, so building and searching need no shuffle, and no term, however
common, gathers in one task. Test windows are looked up in every segment: the positions of the
window's rarest term there, shifted back by its offset, are intersected with those of the next rarest,
and so on. What remains are exact phrases; with ``slop`` also windows whose terms all stand within that
many words of their place.

The test set is a stated query set. It goes to the tasks in blocks of ``BLOCK_BYTES`` of text, one
search of the index per block, so what is broadcast keeps its size however large the test set is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.bytewords import join_texts, span_hashes, word_spans
from shelfwise.llm.common import LARGE_ROWS, arrow_rows, free_name, slices, stored

WINDOW = 10
SEGMENT_BYTES = 4 << 20
BLOCK_BYTES = 16 << 20
#: Documents and segments that a task hands to Python at once.
DOCS_AT_ONCE, SEGMENTS_AT_ONCE = 1_000, 2
#: Bytes of words: everything but ASCII that is neither a digit nor a letter (A-Z come lower-cased).
_WORD = np.array([b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A for b in range(256)])
INDEX = ("seg long, doc_ids array<long>, text_hashes array<long>, bases array<int>, n_words array<int>, "
         "terms array<long>, offsets array<int>, postings binary")
FOUND = ("seg long, ord int, doc_id long, text_hash long, n_words long, runs array<struct<s:int,e:int>>, "
         "items array<string>, near array<string>")


def _tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Term hashes of all texts in order, and each text's number of them."""
    buf, at = join_texts(texts)
    starts, ends = word_spans(buf, _WORD)
    counts = np.diff(np.append(np.searchsorted(starts, at), len(starts)))
    return span_hashes(buf, starts, ends), counts


def build_index(docs: DataFrame, name: str = "postings") -> DataFrame:
    """Post every token of ``docs`` (doc_id, text) into index segments, written to the shared folder.

    Position of word w of the segment's document k: ``bases[k] + w``; one position stays free between
    documents, so no phrase runs from one into the next. A null text has no words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = TaskContext.get().partitionId() << 32
        for b in slices(batches, "text", SEGMENT_BYTES):
            hashes, counts = _tokens(b.column(2).cast(pa.large_binary()).to_pylist())
            k = len(counts)
            first = np.concatenate(([0], np.cumsum(counts)[:-1]))
            bases = first + np.arange(k)
            place = np.arange(len(hashes)) + np.repeat(np.arange(k), counts)
            order = np.argsort(hashes, kind="stable")
            ranked = hashes[order]
            new = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))) if len(ranked) else np.zeros(0, int)
            one = lambda x, t: pa.array([x], pa.list_(t))
            yield pa.record_batch([
                pa.array([seg]), one(b.column(0), pa.int64()), one(b.column(1), pa.int64()),
                one(bases.astype(np.int32), pa.int32()), one(counts.astype(np.int32), pa.int32()),
                one(ranked[new].view(np.int64), pa.int64()), one(np.append(new, len(ranked)).astype(np.int32), pa.int32()),
                pa.array([place[order].astype("<i4").tobytes()], pa.binary())],
                schema=_index_schema())
            seg += 1

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text")
    with arrow_rows(docs.sparkSession, DOCS_AT_ONCE):
        return stored(rows.mapInArrow(run, INDEX), name, options=LARGE_ROWS)


def _index_schema() -> pa.Schema:
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    return pa.schema([("seg", pa.int64()), ("doc_ids", longs), ("text_hashes", longs), ("bases", ints),
                      ("n_words", ints), ("terms", longs), ("offsets", ints), ("postings", pa.binary())])


def _windows(texts: list[bytes | None], window: int) -> tuple[list[np.ndarray], list[int]]:
    """Term hashes of every window of ``window`` words, and the number of its text; a text of fewer
    words, but not none, is one window."""
    hashes, counts = _tokens(texts)
    out, of, at = [], [], 0
    for i, n in enumerate(counts.tolist()):
        for s in range(max(n - window + 1, min(n, 1))):
            out.append(hashes[at + s: at + min(s + window, n)])
            of.append(i)
        at += n
    return out, of


class Segment:
    """One index row, ready to be searched."""

    def __init__(self, row: dict) -> None:
        self.bases = np.asarray(row["bases"], np.int64)
        self.sizes = np.asarray(row["n_words"], np.int64)
        self.terms = np.asarray(row["terms"], np.int64).view(np.uint64)
        self.offsets = np.asarray(row["offsets"], np.int64)
        self.postings = np.frombuffer(row["postings"], "<i4")

    def lists(self, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and length of each vocabulary term's posting list here."""
        if not len(self.terms):
            return np.zeros(len(vocabulary), np.int64), np.zeros(len(vocabulary), np.int64)
        k = np.minimum(np.searchsorted(self.terms, vocabulary), len(self.terms) - 1)
        there = self.terms[k] == vocabulary
        return self.offsets[k], np.where(there, self.offsets[k + 1] - self.offsets[k], 0)

    def phrase(self, starts: np.ndarray, lengths: np.ndarray, slop: int = 0) -> np.ndarray:
        """Places of a window whose i-th term has the list ``starts[i]``, ``lengths[i]``: lists are
        met from the rarest on, each shifted back by its offset."""
        order = np.argsort(lengths, kind="stable")
        r = order[0]
        cand = self.postings[starts[r]: starts[r] + lengths[r]].astype(np.int64) - r
        if slop:
            doc = np.searchsorted(self.bases, cand + r, side="right") - 1
            low, high = self.bases[doc], self.bases[doc] + self.sizes[doc] - 1
        for i in order[1:]:
            if not len(cand):
                break
            places = self.postings[starts[i]: starts[i] + lengths[i]]
            if not slop:
                k = np.minimum(np.searchsorted(places, cand + i), len(places) - 1)
                cand = cand[places[k] == cand + i]
            else:
                k = np.searchsorted(places, np.maximum(cand + i - slop, low))
                there = places[np.minimum(k, len(places) - 1)]
                ok = (k < len(places)) & (there <= np.minimum(cand + i + slop, high))
                cand, low, high = cand[ok], low[ok], high[ok]
        return cand


def _found(seg: Segment, query: dict, slop: int) -> tuple[dict, dict, dict]:
    """By document number: runs of hit words, items of exact windows, items of windows nearby only."""
    starts, lengths = seg.lists(query["vocabulary"])
    cover = np.zeros(int(seg.bases[-1] + seg.sizes[-1]) + 2, np.int64)
    exact, near = {}, {}
    for size, (ids, of) in query["by_size"].items():
        n = lengths[ids]
        for w in np.flatnonzero((n > 0).all(axis=1)):
            at = seg.phrase(starts[ids[w]], n[w])
            for d in np.unique(np.searchsorted(seg.bases, at, side="right") - 1).tolist():
                exact.setdefault(d, set()).add(of[w])
            np.add.at(cover, at, 1)
            np.add.at(cover, at + size, -1)
            if slop:
                wide = seg.phrase(starts[ids[w]], n[w], slop)
                wide = wide[~np.isin(wide, at)] + int(np.argmin(n[w]))
                for d in np.unique(np.searchsorted(seg.bases, wide, side="right") - 1).tolist():
                    near.setdefault(d, set()).add(of[w])
    inside = np.cumsum(cover) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
    runs: dict[int, list] = {}
    for s, e in zip(edges[::2].tolist(), edges[1::2].tolist()):
        d = int(np.searchsorted(seg.bases, s, side="right")) - 1
        runs.setdefault(d, []).append({"s": s, "e": e})
    return runs, exact, near


def _query(items: list, window: int) -> dict:
    """Windows of one block of test items as numbers into its vocabulary, by window length."""
    windows, of = _windows([i["text"].encode() if i["text"] is not None else None for i in items], window)
    vocabulary = np.unique(np.concatenate(windows)) if windows else np.zeros(0, np.uint64)
    by_size: dict = {}
    for w, i in zip(windows, of):
        by_size.setdefault(len(w), {}).setdefault(w.tobytes(), []).append(i)
    return {"vocabulary": vocabulary, "ids": [i["item_id"] or "" for i in items], "by_size": {
        n: (np.searchsorted(vocabulary, np.frombuffer(b"".join(x), np.uint64).reshape(-1, n)), [tuple(o) for o in x.values()])
        for n, x in by_size.items()}}


def search(index: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """Per indexed document: its words, the runs of words inside exact windows, the ids of the items
    with an exact window and of those with one within ``slop`` words only. Stored, a block of items at a time."""
    spark = index.sparkSession
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // BLOCK_BYTES))

    def block(b: int) -> DataFrame:
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == b) if n_blocks > 1 else rows
        query = spark.sparkContext.broadcast(_query([r.asDict() for r in part.collect()], window))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q = query.value
            names = lambda of: sorted({q["ids"][i] for w in of for i in w})
            for batch in batches:
                for k in range(batch.num_rows):
                    row = {n: batch.column(j)[k].as_py() if n == "postings" else batch.column(j)[k].values
                           for j, n in enumerate(batch.schema.names) if n != "seg"}
                    seg = Segment(row)
                    runs, exact, near = _found(seg, q, slop)
                    base = seg.bases.tolist()
                    keep = range(len(base)) if b == 0 else sorted({*runs, *near})
                    ids, hashes, sizes = (x.to_pylist() for x in (row["doc_ids"], row["text_hashes"], row["n_words"]))
                    yield pa.record_batch([
                        pa.array([batch.column(0)[k].as_py()] * len(keep), pa.int64()), pa.array(list(keep), pa.int32()),
                        pa.array([ids[d] for d in keep], pa.int64()), pa.array([hashes[d] for d in keep], pa.int64()),
                        pa.array([sizes[d] for d in keep], pa.int64()),
                        pa.array([[{x: r[x] - base[d] for x in r} for r in runs.get(d, [])] for d in keep],
                                 pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))),
                        pa.array([names(exact.get(d, ())) for d in keep], pa.list_(pa.string())),
                        pa.array([names(near.get(d, ())) for d in keep], pa.list_(pa.string()))],
                        names=["seg", "ord", "doc_id", "text_hash", "n_words", "runs", "items", "near"])

        with arrow_rows(spark, SEGMENTS_AT_ONCE):
            return stored(index.mapInArrow(run, FOUND), "found")

    found = [block(b) for b in range(n_blocks)]
    if n_blocks == 1:
        return found[0]
    both = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    return (reduce(DataFrame.unionByName, found).groupBy("seg", "ord")
            .agg(F.first("doc_id").alias("doc_id"), F.first("text_hash").alias("text_hash"),
                 F.first("n_words").alias("n_words"), both("runs"), both("items"), both("near")))


def hit_words(runs: str = "runs"):
    """Words inside the union of sorted runs."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(acc, r):  # type: ignore[no-untyped-def]
        end = F.greatest(acc["end"], r["e"])
        return F.struct(end.alias("end"), (acc["n"] + end - F.greatest(acc["end"], F.least(r["s"], r["e"]))).alias("n"))

    return F.aggregate(F.col(runs), start, lambda a, r: F.when(r["e"] > a["end"], add(a, r)).otherwise(a))["n"]


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_words, n_hit (words inside any occurrence of a
    window of ``window`` item words), items (sorted ids with an exact window), near (with ``slop``:
    ids with a window within that many words, sorted), contaminated (n_hit > 0).

    Null and wordless texts have no words and no hits; an item without words has no window; equal
    items all count; a null item_id reads ``''``; repeated rows and null doc_ids each give their row;
    empty tables give no rows or no hits; other columns are ignored.
    """
    found = search(build_index(docs), items, window, slop)
    return found.withColumn("n_hit", hit_words()).select(
        "doc_id", "text_hash", "n_words", "n_hit", "items", "near", (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, columns unchanged."""
    key, text = free_name(docs.columns, "__id"), free_name(docs.columns, "__hash")
    bad = (contamination(docs, items, window).filter("contaminated")
           .select(F.col("doc_id").alias(key), F.col("text_hash").alias(text)).distinct())
    return docs.join(stored(bad, "contaminated"), F.col("doc_id").cast("long").eqNullSafe(F.col(key))
                     & (F.xxhash64("text") == F.col(text)), "left_anti")
