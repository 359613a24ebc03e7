import heapq
import random

import pytest

from shelfwise.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string, message string"


def cheapest(roles):
    """Least repair price by uniform-cost search over single edits."""
    paid = lambda r, to: 0 if (r or "").strip().lower() == to else 2 if (r or "").strip().lower() in C.ROLES[1:] else 1
    legal = {"": ["system", "user"], "system": ["user"], "user": ["assistant"], "assistant": ["user"]}
    heap, seen = [(0, 0, "")], set()
    while heap:
        c, i, s = heapq.heappop(heap)
        if (i, s) in seen:
            continue
        seen.add((i, s))
        if i == len(roles) and s == "assistant":
            return c
        for to in legal[s]:
            heapq.heappush(heap, (c + 3, i, to))
            if i < len(roles):
                heapq.heappush(heap, (c + paid(roles[i], to), i + 1, to))
        if i < len(roles) and s:
            heapq.heappush(heap, (c + 1 + paid(roles[i], s), i + 1, s))


def price(rows):
    cost = 0
    for role, r in rows:
        cost += 1 if "merge" in r.action else 0
        cost += (2 if C.role_state(role) else 1) if "relabel" in r.action else 0
        cost += 3 * len(r.inserted)
    return cost


def conversations(rng):
    rows = []
    for conv in [None, *range(40)]:
        for t in range(rng.randint(1, 9)):
            rows.append((conv, t, rng.choice(["user", "assistant", "User ", "system", "tool", None]), f"m{conv}.{t}", "x"))
    rows += [(99, t, rng.choice(["user", "assistant", "assistant"]), f"h{t}", "") for t in range(400)]
    rows += [(100, 0, "user", None, ""), (100, 0, "user", None, ""), (101, None, "assistant", "<|im_end|>x", "")]
    return rows


@pytest.mark.parametrize("parts", [1, 7])
def test_cheapest_and_legal(spark, parts):
    rows = conversations(random.Random(parts))
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = C.repair(df).collect()
    assert len(got) == len(rows)
    convs = {}
    for r in got:
        convs.setdefault(r.conv_id, []).append(r)
    for conv, out in convs.items():
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] or ""))
        out.sort(key=lambda r: (r.turn is not None, r.turn or 0, r.role is not None, r.role or "", r.message, r.rendered))
        assert price([(r.role, r) for r in out]) == cheapest([r[2] for r in mine])
        out.sort(key=lambda r: (r.turn is not None, r.turn or 0, r.message, "merge" in r.action))
        text = "".join(r.rendered for r in out)
        heads = [m.split("\n")[0] for m in text.split("<|im_start|>")[1:]]
        body = heads[1:] if heads[0] == "system" else heads
        assert body == ["user", "assistant"] * (len(body) // 2) and text.count("<|im_end|>") == len(heads)
        assert text.startswith("<|im_start|>") and text.endswith("<|im_end|>\n")
        assert max(r.message for r in out) < len(heads)


def test_empty(spark):
    assert C.repair(spark.createDataFrame([], SCHEMA)).collect() == []
