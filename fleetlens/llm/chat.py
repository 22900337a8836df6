"""Chat formatting by minimum-cost role repair.

The legal conversations are those of an automaton: an optional system turn,
then user and assistant in turn, ending after an assistant turn.  Every input
turn is kept, relabelled, or merged into the turn before it, and empty turns
may be inserted before a turn or at the end; dynamic programming over the
automaton's states finds the cheapest repair.  Ties go to the option listed
first in ``options``.

Long conversations are not gathered in one task.  Rows are range-partitioned
by (conversation, turn), so a hot conversation spans many segments.  A segment
is summed up as a min-plus matrix (cheapest cost from state to state); the
matrices of a conversation, one per segment, are chained to fix the states at
the segment borders; then every segment is repaired on its own between its
borders.  The outcome is that of the whole dynamic program.

A null or unknown role is relabelled at a lower price.  Null text is empty.  A
null conversation id is a conversation, a null turn comes first.  Rows of the
same turn are ordered by role and text; repeated rows are turns of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("start", "system", "user", "assistant")
RELABEL, RELABEL_UNKNOWN, MERGE, MERGE_OTHER, INSERT = 4, 2, 1, 6, 3
#: empty turns needed before a turn with the second role, from the first state
_FILL = {(START, SYSTEM): (), (START, USER): (), (START, ASSISTANT): (USER,), (SYSTEM, USER): (),
         (SYSTEM, ASSISTANT): (USER,), (USER, ASSISTANT): (), (USER, USER): (ASSISTANT,),
         (ASSISTANT, USER): (), (ASSISTANT, ASSISTANT): (USER,)}
_END = {SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
INF = 1 << 60


def options(state: int, role: int) -> list[tuple[int, int, str, tuple[int, ...]]]:
    """(cost, next state, action, inserted roles) for an input role (0: unknown)."""
    out = []
    for to in (SYSTEM, USER, ASSISTANT):
        if (state, to) in _FILL:
            cost = 0 if to == role else RELABEL if role else RELABEL_UNKNOWN
            fill = _FILL[state, to]
            out.append((cost + INSERT * len(fill), to, "keep" if to == role else "relabel", fill))
    if state != START:
        out.append((MERGE if state == role or not role else MERGE_OTHER, state, "merge", ()))
    return sorted(out, key=lambda o: (o[0], ("keep", "merge", "relabel").index(o[2]), len(o[3]), o[1]))


#: cheapest option per (role, state, next state)
_STEP = [[{} for _ in range(4)] for _ in range(4)]
for _r in range(4):
    for _s in range(4):
        for _o in options(_s, _r):
            _STEP[_r][_s].setdefault(_o[1], _o)


def matrix(roles: list[int]) -> list[int]:
    """Cheapest cost from every state to every state over these turns, flat."""
    rows = [[0 if a == b else INF for b in range(4)] for a in range(4)]
    for r in roles:
        step = _STEP[r]
        for k in range(4):
            old, new = rows[k], [INF] * 4
            for s in range(4):
                if old[s] < INF:
                    for to, o in step[s].items():
                        if old[s] + o[0] < new[to]:
                            new[to] = old[s] + o[0]
            rows[k] = new
    return [c for row in rows for c in row]


def chain(matrices: list[list[int]]) -> list[tuple[int, int]]:
    """(first, last) state of every segment of one conversation."""
    cost = [0, INF, INF, INF]
    came = []
    for m in matrices:
        new, back = [INF] * 4, [0] * 4
        for to in range(4):
            for s in range(4):
                c = cost[s] + m[4 * s + to]
                if c < new[to]:
                    new[to], back[to] = c, s
        came.append(back)
        cost = new
    at = min(_END, key=lambda s: (cost[s] + INSERT * len(_END[s]), s))
    out = []
    for back in reversed(came):
        out.append((back[at], at))
        at = back[at]
    return out[::-1]


def repair(roles: list[int], first: int, last: int) -> list[tuple[int, int, str, tuple[int, ...]]]:
    """The cheapest options, one per turn, from state ``first`` to ``last``."""
    cost = [INF] * 4
    cost[first] = 0
    came = []
    for r in roles:
        new, back = [INF] * 4, [None] * 4
        for s in range(4):
            if cost[s] < INF:
                for to, o in _STEP[r][s].items():
                    if cost[s] + o[0] < new[to]:
                        new[to], back[to] = cost[s] + o[0], (s, o)
        came.append(back)
        cost = new
    out, at = [], last
    for back in reversed(came):
        at, o = back[at]
        out.append(o)
    return out[::-1]


def _role_number(role):
    out = F.lit(0)
    for k in (SYSTEM, USER, ASSISTANT):
        out = F.when(F.lower(F.trim(role)) == ROLES[k], k).otherwise(out)
    return out.cast("int")


def repair_roles(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """One row per input turn: conversation, turn, role, ``position`` (gapless
    from 0), ``new_role``, ``action`` (keep, relabel, merge), ``inserted``
    (roles of the empty turns put before it; on the last turn of a
    conversation ``inserted_after`` has those at the end), ``cost`` and
    ``rendered``.  The ``rendered`` of a conversation, joined in order of
    ``position``, are its repaired text."""
    spark = df.sparkSession
    order = [F.col(conv_col), F.col(turn_col), F.col(role_col), F.xxhash64(text_col)]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (df.select(conv_col, turn_col, role_col, text_col).repartitionByRange(parts, *order)
            .sortWithinPartitions(*order)
            .withColumns({"__seg": F.spark_partition_id(), "__ord": F.monotonically_increasing_id(),
                          "__num": _role_number(F.col(role_col))}))
    rows = C.materialize(rows, "turns")
    slim = rows.select("__seg", "__ord", "__num", F.col(conv_col).cast("string").alias("__conv"))

    def runs(batches):
        """(segment, conversation, orders, roles) of neighbouring turns; a
        segment is one range partition, so this holds one at a time."""
        held = None
        for b in batches:
            for seg, at, num, conv in zip(*(b.column(c).to_pylist() for c in ("__seg", "__ord", "__num", "__conv"))):
                if held is None or held[0] != seg or held[1] != conv:
                    if held is not None:
                        yield held
                    held = (seg, conv, [], [])
                held[2].append(at)
                held[3].append(num)
        if held is not None:
            yield held

    m_out = T.StructType([T.StructField("seg", T.IntegerType()), T.StructField("conv", T.StringType()),
                          T.StructField("head", T.LongType()), T.StructField("n", T.LongType()),
                          T.StructField("m", T.ArrayType(T.LongType()))])

    def summarise(batches):
        for seg, conv, at, nums in runs(batches):
            yield pa.RecordBatch.from_arrays([pa.array([seg], pa.int32()), pa.array([conv], pa.string()),
                                              pa.array([at[0]], pa.int64()), pa.array([len(at)], pa.int64()),
                                              pa.array([matrix(nums)], pa.list_(pa.int64()))], names=m_out.names)

    dealt = slim.repartition(parts, "__seg").sortWithinPartitions("__seg", "__ord")
    sums = dealt.mapInArrow(summarise, m_out)
    s_out = T.StructType([T.StructField("head", T.LongType()), T.StructField("first", T.IntegerType()),
                          T.StructField("last", T.IntegerType()), T.StructField("before", T.LongType()),
                          T.StructField("final", T.BooleanType())])

    def states(batches):
        def close(part):
            before = 0
            for k, ((head, n, _), (a, z)) in enumerate(zip(part, chain([p[2] for p in part]))):
                yield head, a, z, before, k == len(part) - 1
                before += n

        held, name = [], None
        for b in batches:
            found = []
            for conv, head, n, m in zip(*(b.column(c).to_pylist() for c in ("conv", "head", "n", "m"))):
                if held and conv != name:
                    found += close(held)
                    held = []
                name = conv
                held.append((head, n, m))
            if found:
                yield pa.RecordBatch.from_pylist([dict(zip(s_out.names, f)) for f in found],
                                                 schema=pa.schema([("head", pa.int64()), ("first", pa.int32()),
                                                                   ("last", pa.int32()), ("before", pa.int64()),
                                                                   ("final", pa.bool_())]))
        if held:
            yield pa.RecordBatch.from_pylist([dict(zip(s_out.names, f)) for f in close(held)],
                                             schema=pa.schema([("head", pa.int64()), ("first", pa.int32()),
                                                               ("last", pa.int32()), ("before", pa.int64()),
                                                               ("final", pa.bool_())]))

    # one row per conversation and segment: at most as many per conversation as there are range partitions
    border = (sums.repartition(parts, "conv").sortWithinPartitions("conv", "seg", "head").mapInArrow(states, s_out))
    border = C.materialize(border, "borders")
    marked = slim.join(border, F.col("__ord") == F.col("head"), "left").repartition(parts, "__seg") \
        .sortWithinPartitions("__seg", "__ord")
    a_out = T.StructType([T.StructField("at", T.LongType()), T.StructField("position", T.LongType()),
                          T.StructField("new", T.IntegerType()), T.StructField("action", T.StringType()),
                          T.StructField("inserted", T.ArrayType(T.StringType())),
                          T.StructField("inserted_after", T.ArrayType(T.StringType())),
                          T.StructField("cost", T.LongType()), T.StructField("final", T.BooleanType())])
    a_schema = pa.schema([("at", pa.int64()), ("position", pa.int64()), ("new", pa.int32()), ("action", pa.string()),
                          ("inserted", pa.list_(pa.string())), ("inserted_after", pa.list_(pa.string())),
                          ("cost", pa.int64()), ("final", pa.bool_())])

    def decide(batches):
        def close(run):
            at, nums, first, last, before, final = run
            for k, (a, o) in enumerate(zip(at, repair(nums, first, last))):
                end = final and k == len(at) - 1
                after = _END[last] if end else ()
                yield {"at": a, "position": before + k, "new": o[1], "action": o[2],
                       "inserted": [ROLES[x] for x in o[3]], "inserted_after": [ROLES[x] for x in after],
                       "cost": o[0] + INSERT * len(after), "final": end}

        held = None
        for b in batches:
            found = []
            columns = (b.column(c).to_pylist() for c in ("__ord", "__num", "head", "first", "last", "before", "final"))
            for at, num, head, first, last, before, final in zip(*columns):
                if head is not None:
                    if held is not None:
                        found += close(held)
                    held = ([], [], first, last, before, final)
                held[0].append(at)
                held[1].append(num)
            if found:
                yield pa.RecordBatch.from_pylist(found, schema=a_schema)
        if held is not None:
            yield pa.RecordBatch.from_pylist(list(close(held)), schema=a_schema)

    actions = marked.mapInArrow(decide, a_out)
    new_role = F.element_at(F.array(*(F.lit(r) for r in ROLES)), F.col("new") + 1)

    def empty_turns(col):
        return F.concat_ws("", F.transform(col, lambda r: F.concat(F.lit("<|"), r, F.lit("|>\n<|end|>\n"))))

    body = F.coalesce(F.col(text_col), F.lit(""))
    rendered = F.concat(
        F.when(F.col("action") == "merge", F.lit("\n"))
        .otherwise(F.concat(F.when(F.col("position") > 0, F.lit("<|end|>\n")).otherwise(""), empty_turns("inserted"),
                            F.lit("<|"), new_role, F.lit("|>\n"))),
        body, F.when(F.col("final"), F.concat(F.lit("<|end|>\n"), empty_turns("inserted_after"))).otherwise(""))
    return (rows.join(actions, F.col("__ord") == F.col("at"))
            .withColumns({"__new": new_role, "__rendered": rendered})
            .select(conv_col, turn_col, role_col, "position", F.col("__new").alias("new_role"), "action", "inserted",
                    "inserted_after", "cost", F.col("__rendered").alias("rendered")))
