"""Exact de-duplication against a minimal perfect hash over historical distinct digests.

The index of a history is a set of shards, chosen by a hash of the digest. A shard's hash is a cascade
of bit arrays: a digest sits at the first level where no other digest of the shard meets its bit, and the rank
of that bit (popcounts before it) is its slot. So n digests have exactly n slots, and each slot holds the full
digest, the locator of the group's winner and the group's size.

Arriving rows are digested, repeats among them are added up before they are shuffled, and each distinct digest
is looked up in its shard: it is a member only if all its bytes equal the slot's. Members join the slot's group
and move its locator if they win; nonmembers form groups of their own. The result is again an index, so history grows
run by run.

A shard holds about ``SHARD`` distinct digests whatever the texts are, so a group of copies never meets in one
task: only its (digest, size, winner) does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import stored

#: Distinct digests a shard of the index is sized for.
SHARD = 1 << 15
#: Bits of a level for each digest that is still without a slot.
GAMMA = 2
#: A group of more than one in ``HOT`` of all rows is joined back by broadcast: at most ``HOT`` such groups exist.
HOT = 1000
GROUP = "shard long, digest binary, group_size long, winner_id long, winner_row long"
INDEX = ("shard long, sizes binary, bits binary, digests binary, group_size array<long>, winner_id array<long>, "
         "winner_row array<long>")
INDEX_ARROW = pa.schema([("shard", pa.int64()), ("sizes", pa.binary()), ("bits", pa.binary()), ("digests", pa.binary()),
                         ("group_size", pa.list_(pa.int64())), ("winner_id", pa.list_(pa.int64())),
                         ("winner_row", pa.list_(pa.int64()))])
_GROUP_ARROW = pa.schema([("shard", pa.int64()), ("digest", pa.binary()), ("group_size", pa.int64()),
                          ("winner_id", pa.int64()), ("winner_row", pa.int64())])
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """The text that is compared: A-Z lower-cased, null as empty."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


class PerfectHash:
    """Minimal perfect hash over distinct 32-byte digests, given as an (n, 4) array of 64-bit words."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray) -> None:
        self.sizes, self.words = sizes, words
        self.base = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64) if len(sizes) else sizes
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        x = keys[:, level & 3] ^ (keys[:, (level + 1) & 3] * np.uint64((2 * level * 0x9E3779B97F4A7C15 + 1) & (2**64 - 1)))
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((x ^ (x >> np.uint64(32))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """Levels until every key has a bit of its own; equal keys are an error."""
        sizes, words, left = [], [], keys
        while len(left):
            if len(sizes) == 256:
                raise ValueError("the digests of an index must be distinct")
            size = -(-GAMMA * len(left) // 64) * 64
            at = cls._place(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at]]
        return cls(np.array(sizes, np.int64), np.concatenate(words) if words else np.zeros(0, "<u8"))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; keys outside the set get any slot, or -1."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            bit = self.base[level] + self._place(keys[left], level, size)
            word, shift = self.words[bit >> 6], (bit & 63).astype(np.uint64)
            hit = (word >> shift) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << shift) - np.uint64(1)))
            out[left[hit]] = (self.before[bit >> 6] + below)[hit]
            left = left[~hit]
        return out


def _keys(column: pa.Array) -> np.ndarray:
    flat = pa.concat_arrays([c.cast(pa.binary(32)) for c in column.chunks] or [pa.array([], pa.binary(32))])
    return np.frombuffer(b"".join(flat.to_pylist()), "<u8").reshape(-1, 4)


def digests(docs: DataFrame, historical: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, digest, old) of every row, stored: ``row`` is a locator that tells rows with the same id apart,
    ``old`` whether ``historical`` holds."""
    return stored(docs.select(
        F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"),
        F.unhex(F.sha2(normalised(F.col(text_col)).cast("binary"), 256)).alias("digest"),
        F.coalesce(historical, F.lit(False)).alias("old")), "dedup-digests")


def groups(rows: DataFrame, shards: int) -> DataFrame:
    """One row a distinct digest: its shard, number of rows, and the locator (id, row) of its winner, the row with
    the largest id (null ids lose; rows with the same id: the largest locator)."""
    shard = F.pmod(F.xxhash64("digest"), F.lit(shards).cast("long"))
    return (rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("id", "row")).alias("winner"))
            .select(shard.alias("shard"), "digest", "group_size", F.col("winner.id").alias("winner_id"),
                    F.col("winner.row").alias("winner_row")))


def build(history: DataFrame) -> DataFrame:
    """The index of grouped distinct digests: per shard the levels of its hash and the slot arrays."""

    def shard(table: pa.Table) -> pa.Table:
        if not table.num_rows:
            return INDEX_ARROW.empty_table()
        keys = _keys(table["digest"])
        h = PerfectHash.build(keys)
        order = np.argsort(h.slots(keys), kind="stable")
        ids = table["winner_id"].to_pylist()
        return pa.table({
            "shard": table["shard"][:1], "sizes": [h.sizes.astype("<i8").tobytes()], "bits": [h.words.tobytes()],
            "digests": [np.ascontiguousarray(keys[order]).tobytes()],
            "group_size": [table["group_size"].to_numpy()[order]],
            "winner_id": [[ids[i] for i in order.tolist()]], "winner_row": [table["winner_row"].to_numpy()[order]],
        }, schema=INDEX_ARROW)

    return history.groupBy("shard").applyInArrow(shard, INDEX)


def probe(index: DataFrame, arriving: DataFrame) -> DataFrame:
    """All groups after the arriving ones were looked up: members added to their slots, nonmembers beside them."""

    def look_up(slots: pa.Table, new: pa.Table) -> pa.Table:
        if not slots.num_rows:
            return new.select(_GROUP_ARROW.names).cast(_GROUP_ARROW)
        h = PerfectHash(*(np.frombuffer(slots[c][0].as_py(), t) for c, t in (("sizes", "<i8"), ("bits", "<u8"))))
        held = np.frombuffer(slots["digests"][0].as_py(), "<u8").reshape(-1, 4)
        size, win_id, win_row = (slots[c][0].as_py() for c in ("group_size", "winner_id", "winner_row"))
        shard, extra = slots["shard"][0].as_py(), new.slice(0, 0)
        if new.num_rows:
            keys = _keys(new["digest"])
            slot = h.slots(keys)
            member = (slot >= 0) & (held[slot] == keys).all(1)
            extra = new.filter(pa.array(~member))
            was = new.filter(pa.array(member))
            columns = (was[c].to_pylist() for c in ("group_size", "winner_id", "winner_row"))
            for s, n, i, r in zip(slot[member].tolist(), *columns):
                size[s] += n
                if (i is not None, i or 0, r) > (win_id[s] is not None, win_id[s] or 0, win_row[s]):
                    win_id[s], win_row[s] = i, r
        raw = held.tobytes()
        known = pa.table({"shard": [shard] * len(held), "digest": [raw[k: k + 32] for k in range(0, len(raw), 32)],
                          "group_size": size, "winner_id": win_id, "winner_row": win_row}, schema=_GROUP_ARROW)
        return pa.concat_tables([known, extra.select(_GROUP_ARROW.names).cast(_GROUP_ARROW)])

    return index.groupBy("shard").cogroup(arriving.groupBy("shard")).applyInArrow(look_up, GROUP)


def _rows_with_groups(rows: DataFrame, found: DataFrame, total: int) -> DataFrame:
    """Each row with its group. Groups of more than a ``HOT``-th of all rows, at most ``HOT`` of them, are
    broadcast, so their rows stay where they are; the others meet their rows by digest."""
    hot = F.col("group_size") > F.lit(total // HOT)
    large = found.filter(hot).select(F.col("digest").alias("d"), F.col("group_size").alias("n"),
                                     F.col("winner_id").alias("i"), F.col("winner_row").alias("r"))
    split = rows.join(F.broadcast(large), F.col("digest") == F.col("d"), "left")
    there = split.filter("d IS NOT NULL").select("id", "row", "digest", F.col("n").alias("group_size"),
                                                 F.col("i").alias("winner_id"), F.col("r").alias("winner_row"))
    rest = split.filter("d IS NULL").select("id", "row", "digest").join(found.filter(~hot).drop("shard"), "digest")
    return there.unionByName(rest)


def deduplicate(docs: DataFrame, historical: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after lower-casing A-Z; null counts as empty. Rows for which
    ``historical`` (a condition on the id) holds are the history that is indexed; all others arrive, are looked up and, if
    they are no members, grouped. The split changes the work, not the result: of each group the row with the
    largest id stays. Of rows with the same id and text, one stays; a null id loses to any other, and in a group
    without an id keep_id is null and one row stays. Repeated rows and very long texts are treated like any other;
    other columns are ignored; an empty table gives no row.
    """
    rows = digests(docs, historical, id_col, text_col)
    total = rows.count()
    shards = max(1, -(-total // SHARD))
    index = stored(build(groups(rows.filter("old"), shards)), "dedup-index")
    found = stored(probe(index, groups(rows.filter("NOT old"), shards)), "dedup-groups")
    out = _rows_with_groups(rows.drop("old"), found, total)
    return out.select(F.col("id").alias("doc_id"), F.col("winner_id").alias("keep_id"), "group_size",
                      (F.col("row") == F.col("winner_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def older_half(docs: DataFrame, id_col: str = "doc_id") -> Column:
    """Condition that holds for ids up to the middle of their range."""
    low, high = docs.agg(F.min(id_col), F.max(id_col)).first()
    return F.lit(False) if low is None else F.col(id_col) <= F.lit((low + high) // 2)
