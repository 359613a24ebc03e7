"""Merkle manifest of a dataset with leaf coordinates by bitmap rank.

Every row is a leaf, the sha256 of its fields. Within a group (a language) leaves are in the order of their ids.
Their coordinates come without sorting them: the ids of a group are merged into a bitmap, kept as its 64-bit
words that are not zero; a popcount directory of four levels, each of at most 65,536 children a node, gives the
number of ids before a word; the rank of an id is that number plus the popcount of the lower bits of its word.

A leaf's coordinate is its key into slot arrays: ``RUN ** levels`` consecutive leaves fill one array, which is
reduced by ``levels`` levels (runs of ``RUN`` become their hash) to one node; these nodes fill the arrays of the
next layer, until one node is left, the group's subroot. Subroots, in the order of the groups, are reduced
likewise to the root. On the way back each array is given the path from its node to the root, so that proofs are
made and checked array by array.

Rows that share an id (or have none) are told apart by their leaves: their order goes by the leaf, through the same
directory over its leading bits, and equal rows take the places that follow each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import stored
from shelfwise.operators.keys import dense_ids

#: Nodes in a run, and levels that a slot array is reduced by.
RUN, LEVELS = 8, 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Equal rows are set out in stretches of this many.
STRETCH = 1 << 16
_ARRAYS = "g string, block long, total long, ids array<long>, leaves binary, others array<binary>, top binary"
_LAYER = "g string, block long, total long, nodes binary, top binary"
_PATHS = "g string, pos long, path array<struct<left: string, right: string>>"
_MANIFEST = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
             "verified boolean")


def leaf_hash(fields: list[Column]) -> Column:
    """Digest of the fields: each ``-`` if null, else its byte count, ``:`` and its value."""
    parts = []
    for c in fields:
        text = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def offsets(counted: DataFrame, group: list[str], key: str, n: str) -> DataFrame:
    """Adds ``base``, the sum of ``n`` over the group's smaller keys, and ``total``, its sum over the group.

    ``counted`` has one row for each group and 64-bit key (null: smallest). A directory of four levels of
    16 bits: no window holds more than 65,537 rows, and each level is summed up from the one below."""
    tables, keys = [counted], [key]
    for level in range(1, 4):
        up = f"__up{level}"
        below = tables[-1].withColumn(up, F.shiftright(F.col(keys[-1]), 16))
        tables[-1] = below
        tables.append(below.groupBy(*group, up).agg(F.sum(n).alias(n)))
        keys.append(up)
    top = Window.partitionBy(*group)
    done = None
    for level in (3, 2, 1, 0):
        t, k = tables[level], keys[level]
        node = [*group] if level == 3 else [*group, keys[level + 1]]
        before = Window.partitionBy(*node).orderBy(F.col(k).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
        t = t.withColumn("base", F.coalesce(F.sum(n).over(before), F.lit(0)))
        if level == 3:
            done = t.withColumn("total", F.sum(n).over(top))
        else:
            above = done.select(*(F.col(c).alias(f"__d_{c}") for c in node), F.col("base").alias("__above"), "total")
            same = [F.col(c).eqNullSafe(F.col(f"__d_{c}")) for c in node]
            done = (t.join(above, same).withColumn("base", F.col("base") + F.col("__above"))
                    .drop("__above", keys[level + 1], *(f"__d_{c}" for c in node)))
    return done


def _word(key: str) -> Column:
    return F.shiftright(F.col(key), 6)


def bitmaps(rows: DataFrame) -> DataFrame:
    """The index: per group ``g`` the words of its id bitmap that are not zero (``w``, ``bits``), the rows in
    each (``n``) and before it (``base``), and the group's rows (``total``). Words are merged in the tasks first."""
    bit = F.expr("shiftleft(1L, cast(id & 63 AS int))")
    words = rows.groupBy("g", _word("id").alias("w")).agg(F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("n"))
    return stored(offsets(words, ["g"], "w", "n"), "merkle-bitmaps")


def coordinates(rows: DataFrame) -> DataFrame:
    """Every leaf with its place ``pos`` in its group and the group's size ``total``."""
    index = bitmaps(rows)
    repeated = F.col("n") > F.coalesce(F.bit_count("bits"), F.lit(0))
    here = [F.col("g") == F.col("i_g"), _word("id").eqNullSafe(F.col("i_w"))]
    named = index.select(F.col("g").alias("i_g"), F.col("w").alias("i_w"), "bits", "base", "total", repeated.alias("many"))
    below = F.expr("bit_count(bits & ~shiftleft(-1L, cast(id & 63 AS int)))")
    placed = (rows.join(named.filter("NOT many"), here)
              .select("g", (F.col("base") + below).alias("pos"), "total", "id", "leaf", "other"))
    if index.filter(repeated).isEmpty():
        return placed
    tied = (rows.join(named.filter("many"), here).groupBy("g", "id", "leaf")
            .agg(F.count(F.lit(1)).alias("n"), F.first("other").alias("other"), F.first("base").alias("word_base"),
                 F.first("total").alias("total")))
    return placed.unionByName(_apart(stored(tied, "merkle-tied")))


def _apart(tied: DataFrame) -> DataFrame:
    """Places of the distinct (id, leaf) of words in which ids repeat; a word has at most 64 ids."""
    upto = (Window.unboundedPreceding, -1)
    ids = tied.groupBy("g", "id").agg(F.sum("n").alias("n"))
    in_word = Window.partitionBy("g", _word("id")).orderBy(F.col("id").asc_nulls_first()).rowsBetween(*upto)
    ids = ids.select(F.col("g").alias("k_g"), F.col("id").alias("k_id"),
                     F.coalesce(F.sum("n").over(in_word), F.lit(0)).alias("id_base"))
    lead = F.conv(F.substring(F.hex("leaf"), 1, 15), 16, 10).cast("long")
    tied = tied.withColumn("lead", lead)
    leads = offsets(tied.groupBy("g", "id", "lead").agg(F.sum("n").alias("n")), ["g", "id"], "lead", "n")
    leads = leads.select(F.col("g").alias("l_g"), F.col("id").alias("l_id"), F.col("lead").alias("l_lead"),
                         F.col("base").alias("lead_base"))
    same_lead = Window.partitionBy("g", "id", "lead").orderBy("leaf").rowsBetween(*upto)
    found = (tied.withColumn("leaf_base", F.coalesce(F.sum("n").over(same_lead), F.lit(0)))
             .join(ids, (F.col("g") == F.col("k_g")) & F.col("id").eqNullSafe(F.col("k_id")))
             .join(leads, (F.col("g") == F.col("l_g")) & F.col("id").eqNullSafe(F.col("l_id")) & (F.col("lead") == F.col("l_lead")))
             .withColumn("first", F.col("word_base") + F.col("id_base") + F.col("lead_base") + F.col("leaf_base")))
    stretches = (found.withColumn("s", F.explode(F.expr(f"sequence(0L, (n - 1) div {STRETCH})")))
                 .repartition("g", "id", "leaf", "s"))
    ends = F.expr(f"sequence(s * {STRETCH}, least(n, (s + 1) * {STRETCH}) - 1)")
    return (stretches.withColumn("k", F.explode(ends))
            .select("g", (F.col("first") + F.col("k")).alias("pos"), "total", "id", "leaf", "other"))


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def climb(nodes: str, total: int, n: int) -> list[str]:
    """Levels of one array, each the joined hex digests of its nodes; up to a single node, and through all ``n``
    levels if the array is one of several."""
    step, out = 64 * RUN, [nodes]
    while len(out) <= n and (total > RUN**n or len(out[-1]) > 64):
        below = out[-1]
        out.append("".join(_hash(below[i: i + step]) for i in range(0, len(below), step)))
    return out


def siblings(levels: list[str], i: int) -> list[tuple[str, str]]:
    """What stands left and right of node ``i``, and of the nodes above it, in their runs."""
    out = []
    for below in levels[:-1]:
        run = i - i % RUN
        out.append((below[64 * run: 64 * i], below[64 * (i + 1): 64 * (run + RUN)]))
        i //= RUN
    return out


def _arrays(placed: DataFrame, levels: int) -> DataFrame:
    """Leaves in slot arrays, each slot filled by its key, and the node that each array is reduced to."""
    size = RUN**levels

    def fill(table: pa.Table) -> pa.Table:
        n = table.num_rows
        slot = [p % size for p in table["pos"].to_pylist()]
        ids, leaves, others = [None] * n, [b""] * n, [None] * n
        for s, i, leaf, other in zip(slot, *(table[c].to_pylist() for c in ("id", "leaf", "other"))):
            ids[s], leaves[s], others[s] = i, leaf, other
        raw, total = b"".join(leaves), table["total"][0].as_py()
        top = climb(raw.hex(), total, levels)[-1]
        return pa.table({"g": table["g"][:1], "block": [table["pos"][0].as_py() // size], "total": [total], "ids": [ids],
                         "leaves": [raw], "others": [others], "top": [bytes.fromhex(top)]}, schema=_ARRAYS_ARROW)

    block = F.expr(f"pos div {size}")
    return placed.groupBy("g", block.alias("block")).applyInArrow(fill, _ARRAYS)


_ARRAYS_ARROW = pa.schema([("g", pa.string()), ("block", pa.int64()), ("total", pa.int64()), ("ids", pa.list_(pa.int64())),
                           ("leaves", pa.binary()), ("others", pa.list_(pa.binary())), ("top", pa.binary())])
_LAYER_ARROW = pa.schema([("g", pa.string()), ("block", pa.int64()), ("total", pa.int64()), ("nodes", pa.binary()),
                          ("top", pa.binary())])
_STEP = pa.struct([("left", pa.string()), ("right", pa.string())])
_PATHS_ARROW = pa.schema([("g", pa.string()), ("pos", pa.int64()), ("path", pa.list_(_STEP))])


def _layer(nodes: DataFrame, levels: int) -> DataFrame:
    size = RUN**levels

    def fill(table: pa.Table) -> pa.Table:
        held = [b""] * table.num_rows
        for p, top in zip(table["pos"].to_pylist(), table["top"].to_pylist()):
            held[p % size] = top
        raw, total = b"".join(held), table["total"][0].as_py()
        return pa.table({"g": table["g"][:1], "block": [table["pos"][0].as_py() // size], "total": [total], "nodes": [raw],
                         "top": [bytes.fromhex(climb(raw.hex(), total, levels)[-1])]}, schema=_LAYER_ARROW)

    return nodes.groupBy("g", F.expr(f"pos div {size}").alias("block")).applyInArrow(fill, _LAYER)


def _up(done: DataFrame, levels: int) -> DataFrame:
    """The reduced arrays of one layer as the nodes of the next."""
    size = RUN**levels
    return done.select("g", F.col("block").alias("pos"), F.expr(f"(total + {size - 1}) div {size}").alias("total"), "top")


def reduced(nodes: DataFrame, most: int, n: int) -> tuple[DataFrame, DataFrame]:
    """Nodes (g, pos, total, top), at most ``most`` a group, to (g, root) and the path of each: (g, pos, path)."""
    layers = []
    while most > 1:
        layers.append(stored(_layer(nodes, n), "merkle-layer"))
        nodes, most = _up(layers[-1], n), -(-most // RUN**n)
    roots = nodes.select("g", F.col("top").alias("root"))
    paths = nodes.select("g", "pos", F.expr("cast(array() AS array<struct<left: string, right: string>>)").alias("path"))

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, block, total, raw, path in zip(*(c.to_pylist() for c in batch.columns)):
                levels, first = climb(raw.hex(), total, n), block * RUN**n
                out = [[*({"left": x, "right": y} for x, y in siblings(levels, i)), *path] for i in range(len(raw) // 32)]
                yield pa.record_batch([pa.array([g] * len(out)), pa.array(range(first, first + len(out)), pa.int64()),
                                       pa.array(out, pa.list_(_STEP))], schema=_PATHS_ARROW)

    for layer in reversed(layers):
        above = paths.select(F.col("g").alias("p_g"), F.col("pos").alias("p_pos"), "path")
        paths = (layer.join(above, (F.col("g") == F.col("p_g")) & (F.col("block") == F.col("p_pos")))
                 .select("g", "block", "total", "nodes", "path").mapInArrow(down, _PATHS))
    return roots, paths


def _proofs(arrays: DataFrame, depth: int) -> DataFrame:
    """Proof of each leaf, and the root folded from what is presented (else the leaf) and the proof."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, raw, others, total, path, subroot, root in zip(*(c.to_pylist() for c in batch.columns)):
                leaves, sub, top = raw.hex(), subroot.hex(), root.hex()
                levels, n = climb(leaves, total, depth), len(ids)
                above = [(s["left"], s["right"]) for s in path]
                proofs, folded = [], []
                for i, other in enumerate(others):
                    steps = [*siblings(levels, i), *above]
                    h = other.hex() if other else leaves[64 * i: 64 * i + 64]
                    for left, right in steps:
                        h = _hash(left + h + right)
                    folded.append(h)
                    proofs.append("".join(x for step in steps for x in step))
                yield pa.record_batch([
                    pa.array(ids, pa.int64()), pa.array([leaves[64 * i: 64 * i + 64] for i in range(n)]), pa.array([sub] * n),
                    pa.array([top] * n), pa.array([_hash(p) for p in proofs]), pa.array(folded),
                    pa.array([f == top for f in folded])], names=[c.split()[0] for c in _MANIFEST.split(", ")])

    columns = ("ids", "leaves", "others", "total", "path", "subroot", "root")
    return arrays.select(*columns).mapInArrow(run, _MANIFEST)


def manifest(docs: DataFrame, presented: dict[str, Column] | None = None, when: Column | None = None,
             fields: tuple[str, ...] = FIELDS, group: str = "lang", key: str = "doc_id",
             levels: int = LEVELS) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256 (of its siblings, level by level), folded_root, verified.

    A leaf is the digest of ``fields``; leaves of a ``group`` value are in the order of the 64-bit ``key``. A proof
    is checked against the row as it is presented: where ``when`` holds, with the columns ``presented`` in the place of
    the stored ones. Null groups form the first group; null keys come first in theirs; rows with the same
    key are in the order of their leaves, and equal rows are leaves of their own. Empty and very long texts are hashed
    whole; columns outside ``fields`` are ignored; an empty table gives no row.
    """
    plain = {c: F.col(c) for c in fields}
    other = F.lit(None).cast("binary")
    if when is not None:
        other = F.when(when, leaf_hash(list((plain | (presented or {})).values())))
    g = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    rows = stored(docs.select(g.alias("g"), F.col(key).cast("long").alias("id"),
                              leaf_hash(list(plain.values())).alias("leaf"), other.alias("other")), "merkle-leaves")
    arrays = stored(_arrays(coordinates(rows), levels), "merkle-arrays")
    most, groups = arrays.agg(F.max("total"), F.count(F.when(F.col("block") == 0, 1))).first()
    subroots, paths = reduced(_up(arrays, levels), -(-(most or 0) // RUN**levels), levels)
    subroots = stored(dense_ids(subroots, ["g"], "pos", start=0), "merkle-subroots")
    root, over = reduced(subroots.select(F.lit("").alias("g"), "pos", F.lit(groups).cast("long").alias("total"),
                                         F.col("root").alias("top")), groups, levels)
    top = root.select("root").first()
    tops = (subroots.select(F.col("g").alias("s_g"), F.col("pos").alias("s_pos"), F.col("root").alias("subroot"))
            .join(over.select(F.col("pos").alias("o_pos"), F.col("path").alias("over")), F.col("s_pos") == F.col("o_pos"))
            .withColumn("root", F.lit(bytes(top[0]) if top else b"")))
    paths = paths.select(F.col("g").alias("p_g"), F.col("pos").alias("p_pos"), "path")
    whole = (arrays.join(paths, (F.col("g") == F.col("p_g")) & (F.col("block") == F.col("p_pos")))
             .join(tops, F.col("g") == F.col("s_g")).withColumn("path", F.concat("path", "over")))
    return _proofs(whole, levels)
