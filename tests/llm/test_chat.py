from itertools import groupby, product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlens.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, cost string, position int"


def legal(seq):
    if seq and seq[0] == chat.SYSTEM:
        seq = seq[1:]
    return len(seq) % 2 == 0 and all(r == (chat.USER if k % 2 == 0 else chat.ASSISTANT) for k, r in enumerate(seq))


def sequence(options, after):
    """The roles of the repaired conversation."""
    out = []
    for _, to, action, fill in options:
        out += fill
        if action == "merge":
            assert out
        else:
            out.append(to)
    return out + list(after)


def cheapest(roles):
    """All repairs, tried one by one."""
    best = [chat.INF]

    def go(k, state, cost):
        if cost >= best[0]:
            return
        if k == len(roles):
            if state in chat._END:
                best[0] = min(best[0], cost + chat.INSERT * len(chat._END[state]))
            return
        for c, to, _, _ in chat.options(state, roles[k]):
            go(k + 1, to, cost + c)

    go(0, chat.START, 0)
    return best[0]


ROLE_LISTS = st.lists(st.integers(0, 3), min_size=1, max_size=7)


@settings(max_examples=300, deadline=None)
@given(ROLE_LISTS, st.integers(1, 7))
def test_segments_give_the_cheapest_legal_repair(roles, cut):
    parts = [roles[:cut], roles[cut:]] if cut < len(roles) else [roles]
    borders = chat.chain([chat.matrix(p) for p in parts])
    options = [o for p, (a, z) in zip(parts, borders) for o in chat.repair(p, a, z)]
    after = chat._END[borders[-1][1]]
    assert legal(sequence(options, after))
    assert sum(o[0] for o in options) + chat.INSERT * len(after) == cheapest(roles)


def test_every_role_triple_is_legal():
    for roles in product(range(4), repeat=3):
        (a, z), = chat.chain([chat.matrix(list(roles))])
        assert legal(sequence(chat.repair(list(roles), a, z), chat._END[z]))


def odd_turns():
    return [(1, 0, "user", "hi", "c", 1), (1, 1, "assistant", "hello", "c", 1), (1, 2, "user", None, "c", 1),
            (2, 0, "assistant", "a", "c", 1), (2, 1, "assistant", "b", None, 1), (2, 1, "assistant", "b", None, 1),
            (3, None, "system", "s", "c", 1), (3, 0, None, "x", "c", 1), (3, 1, "robot", "", "c", 1),
            (None, 0, "USER ", "n", "c", 1), (None, None, "user", "m", "c", 1), (4, 0, "system", "y" * 100_000, "c", 1),
            (5, 5, "user", "u5", "c", 1), (5, 5, "assistant", "a5", "c", 1)]


def plain(data):
    """The whole dynamic program per conversation, rendered."""
    out = {}
    number = {"system": 1, "user": 2, "assistant": 3}
    key = lambda r: (r[0] is not None, r[0] or 0)
    for (_, conv), rows in groupby(sorted(data, key=key), key=key):
        rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or ""))
        nums = [number.get((r[2] or "").strip().lower(), 0) for r in rows]
        (a, z), = chat.chain([chat.matrix(nums)])
        turns = []
        for r, (_, to, action, fill) in zip(rows, chat.repair(nums, a, z)):
            turns += [[chat.ROLES[f], ""] for f in fill]
            if action == "merge":
                turns[-1][1] += "\n" + (r[3] or "")
            else:
                turns.append([chat.ROLES[to], r[3] or ""])
        turns += [[chat.ROLES[f], ""] for f in chat._END[z]]
        out[rows[0][0]] = "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in turns)
    return out


def rendered(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: r.position):
        got[r.conv_id] = got.get(r.conv_id, "") + r.rendered
    return got


def test_odd_rows(spark):
    df = spark.createDataFrame(odd_turns(), SCHEMA).repartition(3)
    out = chat.repair_roles(df).persist()
    assert out.count() == len(odd_turns())
    assert rendered(out) == plain(odd_turns())
    places = {}
    for r in out.collect():
        places.setdefault(r.conv_id, []).append(r.position)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_hot_conversation_spans_segments(spark):
    """One conversation over many range partitions equals the whole program."""
    roles = ["user", "assistant", "assistant", "user", "user", "tool", "system", "assistant"]
    data = [(7, k, roles[k * k % 8], f"t{k}", "c", 0) for k in range(3000)] + [(8, k, "user", "z", "c", 0) for k in range(5)]
    out = chat.repair_roles(spark.createDataFrame(data, SCHEMA)).persist()
    assert rendered(out) == plain(data)
    cost = {r.conv_id: r.c for r in out.groupBy("conv_id").agg(F.sum("cost").alias("c")).collect()}
    nums = [{"system": 1, "user": 2, "assistant": 3}.get(r[2], 0) for r in data[:3000]]
    (a, z), = chat.chain([chat.matrix(nums)])
    assert cost[7] == sum(o[0] for o in chat.repair(nums, a, z)) + chat.INSERT * len(chat._END[z])


def test_table(spark, sf):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    data = [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]
    assert rendered(chat.repair_roles(df)) == plain(data)


def test_empty(spark):
    assert chat.repair_roles(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("role", [0, 1, 2, 3])
def test_options_cover_every_role(role):
    assert all(chat.options(s, role) for s in range(4))
