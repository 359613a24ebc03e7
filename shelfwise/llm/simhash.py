"""SimHash near-duplicate groups over a Gray-order hierarchical index.

A text's fingerprint is the bitwise majority of its word shingles' XXH64 hashes. Two fingerprints
link when they differ in at most ``max_bits`` bits; documents group along links.

The index. 64 bits cut into ``max_bits + 1`` blocks leave one block untouched in any linked pair, so
each distinct fingerprint is filed once per block under that block's value: the root level, whose
masked pattern all members share. Members are kept in Gray rank (neighbours differ in few bits), runs
of ``FANOUT`` form nodes, and a node stores the bits on which all its members agree, less those its
parents already hold. A search adds up the differences on the way down and drops a node with all
below it once the sum exceeds ``max_bits``. A root with more than ``MAX_GROUP`` members is filed again
by the blocks of its remaining bits, which keeps every pair: at the third level 19 free bits bound it.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import free_name, stored
from shelfwise.llm.components import connected_components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Members of a root node beyond which its remaining bits are cut into blocks again.
MAX_GROUP = 1024
LEVELS = 3
FANOUT = 16
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text; null and wordless texts give 0.

    Words are runs without ASCII white space after lower-casing A-Z (exactly what ``bytes.lower``
    and ``bytes.split`` do); fewer words than a shingle form one shingle.
    """
    from xxhash import xxh64_intdigest as xxh

    words = (text or b"").lower().split()
    n = len(words)
    if not n:
        return 0
    k = min(shingle, n)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    cuts = zip(starts[: n - k + 1].tolist(), ends[k - 1:].tolist())
    hashes = np.fromiter((xxh(joined[a:b], SEED) for a, b in cuts), np.uint64, n - k + 1)
    octets = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    set_bits = np.concatenate([np.bincount(octets[:, j], minlength=256) @ _BITS for j in range(8)])
    return int.from_bytes(np.packbits(set_bits * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)`` of every row, fp as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.large_binary())
            fps = np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.record_batch([b.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each 64-bit pattern in the reflected Gray sequence."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


def _nodes(members: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels of (agreed bits not held above, pattern), root first; the last level is the members."""
    levels, low, high = [(np.full(len(members), ~np.uint64(0)), members)], members, members
    while len(low) > FANOUT:
        at = np.arange(0, len(low), FANOUT)
        low, high = np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at)
        levels.append((~(low ^ high), low))
    levels.reverse()
    held = np.zeros(len(levels[0][0]), np.uint64)
    out = []
    for k, (agreed, pattern) in enumerate(levels):
        if k:
            held = np.repeat(held, FANOUT)[: len(agreed)]
        out.append((agreed & ~held, pattern))
        held = held | agreed
    return out


def linked_pairs(members: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i < j) of the members, sorted by Gray rank, that differ in at most ``max_bits`` bits."""
    levels = _nodes(members)
    for first in range(0, len(members), 256):
        q = np.arange(first, min(first + 256, len(members)))
        top = len(levels[0][0])
        qi, node, diff = np.repeat(q, top), np.tile(np.arange(top), len(q)), 0
        for k, (mask, pattern) in enumerate(levels):
            if k:
                node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                qi, diff = np.repeat(qi, FANOUT), np.repeat(diff, FANOUT)
                real = node < len(mask)
                qi, node, diff = qi[real], node[real], diff[real]
            diff = diff + np.bitwise_count((members[qi] ^ pattern[node]) & mask[node]).astype(np.int64)
            near = diff <= max_bits
            if k == len(levels) - 1:
                near &= qi < node
            qi, node, diff = qi[near], node[near], diff[near]
        yield qi, node


def _local_links(fps: np.ndarray, starts: np.ndarray, ends: np.ndarray, max_bits: int) -> np.ndarray:
    """A spanning set of the links inside each group ``fps[start:end]`` as rows (u, v)."""
    label = np.arange(len(fps))

    def join(a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = label[a], label[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))
            while (label != label[label]).any():
                label[:] = label[label]

    size = ends - starts
    small = size <= 4 * FANOUT
    group = np.repeat(np.arange(len(starts)), size)
    in_small = np.repeat(small, size)
    for lag in range(1, int(size[small].max(initial=1))):
        i = np.flatnonzero(in_small[:-lag] & (group[:-lag] == group[lag:]))
        i = i[np.bitwise_count(fps[i] ^ fps[i + lag]) <= max_bits]
        join(i, i + lag)
    for s, e in zip(starts[~small], ends[~small]):
        for i, j in linked_pairs(fps[s:e], max_bits):
            join(i + s, j + s)
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return np.stack([fps[moved], fps[label[moved]]], axis=1).view(np.int64)


def _blocks(free: int, parts: int) -> list[tuple[int, int]]:
    """(shift, width) of ``parts`` near-equal blocks of the lowest ``free`` bits, highest first."""
    cuts = [free * k // parts for k in range(parts + 1)]
    return [(free - cuts[k + 1], cuts[k + 1] - cuts[k]) for k in range(parts)]


def _free_after(level: int, max_bits: int) -> list[int]:
    """Possible numbers of free bits once ``level`` blocks have been taken."""
    free = {64}
    for _ in range(level):
        free = {f - w for f in free for _, w in _blocks(f, max_bits + 1)}
    return sorted(free)


def _file(rows: DataFrame, level: int, max_bits: int) -> DataFrame:
    """File each row (fp, key, rest, free) under every block of its ``free`` low bits in ``rest``: the
    block's value goes into the key, the other bits close up and stay free."""

    def filed(free: int) -> list:
        parts = []
        for r, (shift, width) in enumerate(_blocks(free, max_bits + 1)):
            value = F.shiftrightunsigned("rest", shift).bitwiseAND(F.lit((1 << width) - 1))
            low = F.col("rest").bitwiseAND(F.lit((1 << shift) - 1))
            above = F.shiftrightunsigned("rest", shift + width) if shift + width < free else F.lit(0)
            parts.append(F.struct(F.concat_ws(".", "key", F.lit(r), value).alias("key"),
                                  F.shiftleft(above.cast("long"), shift).bitwiseOR(low).alias("rest"),
                                  F.lit(free - width).alias("free")))
        return parts

    widths = _free_after(level, max_bits)
    each = F.array(*filed(widths[-1]))
    for w in widths[:-1]:
        each = F.when(F.col("free") == w, F.array(*filed(w))).otherwise(each)
    return rows.select("fp", F.explode(each).alias("x")).select("fp", "x.key", "x.rest", "x.free")


def _search(filed: DataFrame, max_bits: int) -> DataFrame:
    """Spanning links of every root group, from a stream of rows sorted by key and Gray rank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
            new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            links = _local_links(fps, new, np.append(new[1:], len(keys)), max_bits)
            if len(links):
                yield pa.record_batch([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["u", "v"])

        keys, fps = np.empty(0, object), np.empty(0, np.uint64)
        for b in batches:
            keys = np.concatenate((keys, b.column(0).to_numpy(zero_copy_only=False)))
            fps = np.concatenate((fps, b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)))
            if len(keys):  # the last group may go on in the next batch; a group has MAX_GROUP rows at most
                tail = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if (keys != keys[-1]).any() else 0
                if tail:
                    yield from found(keys[:tail], fps[:tail])
                keys, fps = keys[tail:], fps[tail:]
        if len(keys):
            yield from found(keys, fps)

    gray = filed.select("key", "fp", F.col("rest").alias("g"))
    for s in (1, 2, 4, 8, 16, 32):
        gray = gray.withColumn("g", F.col("g").bitwiseXOR(F.shiftrightunsigned("g", s)))
    return (gray.repartition("key").sortWithinPartitions("key", "g").select("key", "fp")
            .mapInArrow(run, "u long, v long"))


def links(nodes: DataFrame, max_bits: int = MAX_BITS, max_group: int = MAX_GROUP) -> DataFrame:
    """Links ``(u, v)`` between distinct fingerprints ``fp`` that connect exactly what is linked.

    Every pair within ``max_bits`` bits lies in the same component of the result; a group yields
    at most one link per member, so the rows grow with the fingerprints and not with pairs.
    """
    rows = nodes.select("fp", F.lit("").alias("key"), F.col("fp").alias("rest"), F.lit(64).alias("free"))
    found = []
    for level in range(LEVELS):
        filed = _file(rows, level, max_bits)
        if level == LEVELS - 1:
            found.append(_search(filed, max_bits))
            break
        big = stored(filed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
                     .filter(F.col("n") > max_group).select("key"), "simhash-big")
        found.append(_search(filed.join(big, "key", "left_anti"), max_bits))
        if big.isEmpty():
            break
        rows = filed.join(big, "key", "left_semi")
    return functools.reduce(DataFrame.unionByName, found)


def group(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Near-duplicate groups of ``documents``: ``(doc_id, fp, root, component_id)``, one row per row.

    ``root`` is the group's smallest fingerprint, ``component_id`` its smallest non-null doc_id.
    Null or wordless texts have fingerprint 0 and link like any other; repeated rows and ids are
    kept; a null doc_id gets its group's component_id; an empty table gives an empty result; other
    columns are ignored.
    """
    fps = stored(fingerprints(docs, shingle), "simhash-fps")
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    comps = connected_components(links(nodes, max_bits), "simhash")
    rooted = stored(nodes.join(comps.withColumnRenamed("node", "fp"), "fp", "left")
                    .withColumn("root", F.coalesce("root", "fp")), "simhash-rooted")
    first = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return fps.join(rooted.select("fp", "root").join(first, "root"), "fp").select(
        "doc_id", "fp", "root", "component_id")


def hex_fingerprint(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every row; see ``group``."""
    return group(docs, shingle, max_bits).select("doc_id", hex_fingerprint().alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each near-duplicate group is kept: the one
    with the group's smallest doc_id (a null id only where the group has no other). Of several rows
    with that id the one with the least text hash stays; equal ones count once."""
    groups = group(docs, shingle, max_bits)
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    # an id may stand in several groups: all its rows count, not only those of the group that it stays for
    per_id = stored(groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max(first).alias("stays"))
                    .filter("stays"), "simhash-stay")
    stay = free_name(docs.columns, "__stay")
    own = F.col("doc_id").cast("long")
    once = per_id.filter("n = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias(stay))
    # as many ids as documents stay: a merge join at every size, never a broadcast
    kept = docs.join(once.hint("merge"), own.eqNullSafe(F.col(stay)), "left_semi")
    again = stored(per_id.filter("n > 1 OR doc_id IS NULL").select(F.col("doc_id").alias(stay)), "simhash-again")
    if again.isEmpty():
        return kept
    rows = docs.join(again, own.eqNullSafe(F.col(stay)), "left_semi")
    fps = rows.select(F.struct(*docs.columns).alias("row"), F.col("doc_id"), "text")
    order = F.struct(F.xxhash64("row"), F.col("row.text"))
    one = (_with_fp(fps, shingle).groupBy("doc_id", "fp").agg(F.min_by("row", order).alias("row")))
    roots = groups.filter(first).select(F.col("doc_id").alias("i"), F.col("fp").alias("f"), "root").distinct()
    picked = (one.join(roots, F.col("doc_id").cast("long").eqNullSafe(F.col("i")) & (F.col("fp") == F.col("f")))
              .groupBy("root").agg(F.min_by("row", order).alias("row")))
    return kept.unionByName(picked.select("row.*"))


def _with_fp(rows: DataFrame, shingle: int) -> DataFrame:
    """``rows`` (row, doc_id, text) with the fingerprint of their text."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("long")
    def fp(texts):  # type: ignore[no-untyped-def]
        import pandas as pd

        return pd.Series([int(np.uint64(fingerprint(t.encode() if isinstance(t, str) else None, shingle))
                              .astype(np.int64)) for t in texts], dtype="int64")

    return rows.withColumn("fp", fp("text"))
