"""Chat formatting with minimum-cost role repair.

Legal conversations: an optional system turn, then user and assistant in turn, the assistant last. Dynamic
programming over this automaton finds the cheapest repair of each conversation: a turn may merge into the
message before it, take another role, or be preceded by empty messages. The repaired sequence is rendered
with ChatML marks, one piece of text per turn; joined in order, the pieces are the conversation.

Turns are range-split by conversation and turn, so a huge conversation spans many tasks. What a stretch of turns
costs from each state to each state is a small matrix; matrices of stretches multiply (min, +). The driver
combines those of the stretches that split boundaries cut, at most two a split, and each task then walks its
stretch between known states.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import stored

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
MERGE, RELABEL, UNKNOWN, INSERT = 1, 2, 1, 3
NEVER = 10**9
#: Legal next states.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
OUT = ("conv_id long, turn long, role string, final_role string, message long, action string, "
       "inserted array<string>, rendered string")


def _inserts() -> dict[tuple[int, int], list[int]]:
    """Fewest empty messages that make ``to`` a legal next state after ``of``."""
    out = {}
    for of in NEXT:
        paths = [[s] for s in NEXT[of]]
        for _ in range(4):
            for p in paths:
                out.setdefault((of, p[-1]), p[:-1])
            paths = [[*p, s] for p in paths for s in NEXT[p[-1]]]
    return out


INSERTS = _inserts()


def _step(of: int, to: int) -> int:
    """Price of emitting a turn in state ``to`` after state ``of``."""
    merge = MERGE if of == to else NEVER
    return min(merge, INSERT * len(INSERTS[of, to]) if (of, to) in INSERTS else NEVER)


STEP = [[_step(of, to) for to in range(4)] for of in range(4)]
END = [0, INSERT * 2, INSERT, 0]  # empty messages that bring each state to a legal end


def role_state(role: str | None) -> int:
    """State of a known role (white space and case aside), 0 of any other."""
    role = (role or "").strip().lower()
    return ROLES.index(role) if role in ROLES else 0


def turn_costs(role: str | None) -> list[list[int]]:
    """Price from each state to each state over one turn."""
    r = role_state(role)
    paid = [NEVER, *(0 if to == r else RELABEL if r else UNKNOWN for to in (SYSTEM, USER, ASSISTANT))]
    return [[min(STEP[of][to] + paid[to], NEVER) for to in range(4)] for of in range(4)]


class Stretch:
    """Costs, and messages begun, from each state to each state over turns added one by one."""

    def __init__(self) -> None:
        self.cost = [[0 if a == b else NEVER for b in range(4)] for a in range(4)]
        self.new = [[0] * 4 for _ in range(4)]

    def add(self, role: str | None) -> list[list[int]]:
        """Adds a turn; returns for each start and end the state before it."""
        step = turn_costs(role)
        back = [[0] * 4 for _ in range(4)]
        cost, new = [[NEVER] * 4 for _ in range(4)], [[0] * 4 for _ in range(4)]
        for a in range(4):
            for to in range(1, 4):
                at = min(range(4), key=lambda s: (self.cost[a][s] + step[s][to], s))
                back[a][to], cost[a][to] = at, min(self.cost[a][at] + step[at][to], NEVER)
                new[a][to] = self.new[a][at] + begun(at, to)
        self.cost, self.new = cost, new
        return back


def merges(of: int, to: int) -> bool:
    return of == to and STEP[of][to] == MERGE


def begun(of: int, to: int) -> int:
    """Messages begun by a turn emitted in ``to`` after ``of``, the empty ones before it included."""
    return 0 if merges(of, to) else 1 + len(INSERTS.get((of, to), ()))


def path(roles: list, start: int = START, end: int | None = None) -> list[int]:
    """States of the turns on the cheapest way from ``start`` to ``end`` (none: the cheapest legal end)."""
    s, backs = Stretch(), []
    for r in roles:
        backs.append(s.add(r))
    if end is None:
        end = min(range(4), key=lambda e: (s.cost[start][e] + END[e], e))
    out = []
    for back in reversed(backs):
        out.append(end)
        end = back[start][end]
    return out[::-1]


def piece(of: int, to: int, text: str | None, last: bool) -> tuple[str, list[str]]:
    """Rendered text of a turn in state ``to`` after state ``of``, and the roles of empty messages in it."""
    text = (text or "").replace("<|im_", "< |im_")
    extra: list[str] = []
    if merges(of, to):
        out = "\n\n" + text
    else:
        extra = [ROLES[s] for s in INSERTS[of, to]]
        out = "".join(["<|im_end|>\n" if of else "", *(f"<|im_start|>{r}\n<|im_end|>\n" for r in extra),
                       f"<|im_start|>{ROLES[to]}\n", text])
    if last:
        after = {SYSTEM: ["user", "assistant"], USER: ["assistant"], ASSISTANT: []}[to]
        out += "".join(["<|im_end|>\n", *(f"<|im_start|>{r}\n<|im_end|>\n" for r in after)])
        extra = extra + after
    return out, extra


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Runs of rows of one split and conversation, in order, as (split, conv, roles)."""
    key, roles = None, []
    for b in batches:
        for split, conv, role in zip(*(b.column(k).to_pylist() for k in range(3))):
            if key != (split, conv):
                if key is not None:
                    yield (*key, roles)
                key, roles = (split, conv), []
            roles.append(role)
    if key is not None:
        yield (*key, roles)


def _edge_matrices(turns: DataFrame) -> DataFrame:
    """Of the first and last stretch of each split: costs and begun messages, as 16 numbers each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(stretch: tuple, first: bool) -> tuple:
            s = Stretch()
            for r in stretch[2]:
                s.add(r)
            return (stretch[0], first, stretch[1], sum(s.cost, []), sum(s.new, []))

        rows, before, first = [], None, True
        for stretch in _stretches(batches):
            if before is not None and before[0] != stretch[0]:
                rows.append(row(before, first))
                first = True
            elif before is not None:
                if first:
                    rows.append(row(before, True))
                first = False
            before = stretch
        if before is not None:
            rows.append(row(before, first))
        if rows:
            types = (pa.int64(), pa.bool_(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows), types)],
                                  names=["split", "first", "conv_id", "cost", "new"])

    return turns.select("split", "conv_id", "role").mapInArrow(
        run, "split long, first boolean, conv_id long, cost array<long>, new array<long>")


def resolve(edges: list) -> dict:
    """``{(split, conv): (state before, state after, messages before, goes on)}`` of the stretches of
    conversations that cross splits, from rows (split, first, conv_id, cost, new) in order."""
    by_conv: dict = {}
    for e in edges:
        by_conv.setdefault(e["conv_id"], []).append(e)
    out = {}
    for conv, parts in by_conv.items():
        if len(parts) < 2:
            continue
        best, backs = [0, NEVER, NEVER, NEVER], []
        for p in parts:
            back = [min(range(4), key=lambda a: (best[a] + p["cost"][4 * a + b], a)) for b in range(4)]
            best = [min(best[back[b]] + p["cost"][4 * back[b] + b], NEVER) for b in range(4)]
            backs.append(back)
        state, ways = min(range(4), key=lambda e: (best[e] + END[e], e)), []
        for back in reversed(backs):
            ways.append((back[state], state))
            state = back[state]
        seen = 0
        for k, (p, (a, b)) in enumerate(zip(parts, ways[::-1])):
            out[p["split"], conv] = (a, b, seen, k < len(parts) - 1)
            seen += p["new"][4 * a + b]
    return out


def repair(turns: DataFrame) -> DataFrame:
    """One row per turn of ``turns`` (conv_id, turn, role, text): the role it ends with, the number of its
    message in the repaired conversation, what was done (keep, relabel, merge, merge+relabel), the roles of
    empty messages inserted with it, and its piece of the rendered conversation.

    Turns are ordered by turn number, then role and text (nulls first; equal rows are equal pieces). A null
    or unknown role takes the cheapest role; a null text is empty; turns with a null conv_id are one
    conversation; a text's own ChatML marks are broken up; ties go to the first state in the order start,
    system, user, assistant; an empty table gives an empty result; other columns are ignored.
    """
    spark = turns.sparkSession
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    parts = max(1, rows.rdd.getNumPartitions())
    order = ["conv_id", "turn", "role", "text"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, at = TaskContext.get().partitionId(), 0
        for b in batches:
            yield pa.record_batch([pa.array([split] * b.num_rows, pa.int64()), pa.array(range(at, at + b.num_rows), pa.int64()),
                                   *b.columns], names=["split", "place", *order])
            at += b.num_rows

    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    kept = stored(ranged.mapInArrow(number, "split long, place long, conv_id long, turn long, role string, text string"), "turns")
    again = lambda df: df.repartition(parts, "split").sortWithinPartitions("split", "place")
    edges = _edge_matrices(again(kept.select("split", "place", "conv_id", "role"))).collect()  # two rows a split at most
    known = spark.sparkContext.broadcast(resolve(sorted(edges, key=lambda e: (e["split"], not e["first"]))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for b in batches:
            out = []
            for row in zip(*(b.column(k).to_pylist() for k in (0, 2, 3, 4, 5))):
                if key != row[:2]:
                    out += _render(key, rows, known.value)
                    key, rows = row[:2], []
                rows.append(row)
            yield _batch(out)
        yield _batch(_render(key, rows, known.value))

    return again(kept).mapInArrow(run, OUT)


def _render(key: tuple | None, rows: list, known: dict) -> list[tuple]:
    if key is None:
        return []
    of, end, message, goes_on = known.get(key, (START, None, 0, False))
    out = []
    for k, (to, (_, conv, turn, role, text)) in enumerate(zip(path([r[3] for r in rows], of, end), rows)):
        rendered, extra = piece(of, to, text, k == len(rows) - 1 and not goes_on)
        message += begun(of, to)
        action = "+".join((["merge"] if merges(of, to) else []) + (["relabel"] if role_state(role) != to else []))
        out.append((conv, turn, role, ROLES[to], message - 1, action or "keep", extra, rendered))
        of = to
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.string())
    columns = list(zip(*rows)) if rows else [()] * len(types)
    return pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, types)],
                           names=["conv_id", "turn", "role", "final_role", "message", "action", "inserted", "rendered"])
