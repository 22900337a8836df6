"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows of equal text form a group that is never split.  Groups are taken in
order of falling size, and each enters the bin with the tightest remaining
capacity that still takes it; open bins stand in a balanced (AVL) tree by
remaining room.  Groups of one size are alike, so the packing works on
the histogram of sizes: a run of ``c`` groups fills the tightest bin with as
many as fit, then the next.  The result is the same bins as one by one.

Bound: the histogram has one row per distinct group size; k distinct sizes
have a sum of k(k+1)/2 at least, so B bytes give at most sqrt(2B) rows (a
quarter of a million at 30 GB).  It is the only thing one task sees whole.

Ranks inside a size, and slots inside a shard, come from counts per hash
bucket plus ranks inside a bucket, so no window holds a whole size class or
shard.  A null text has size 1 (no bytes, plus 1).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

ROWS_PER_BUCKET = 100_000


class RoomTree:
    """AVL tree of (remaining room, bin); a node is (key, left, right, height)."""

    def __init__(self):
        self.top = None

    def insert(self, key: tuple[int, int]) -> None:
        self.top = _inserted(self.top, key)

    def pop_at_least(self, low: tuple[int, int]) -> tuple[int, int] | None:
        """Take out the smallest key from ``low`` on, None if there is none."""
        found, at = None, self.top
        while at:
            if at[0] >= low:
                found, at = at[0], at[1]
            else:
                at = at[2]
        if found is not None:
            self.top = _removed(self.top, found)
        return found


def _node(key, left, right):
    return key, left, right, 1 + max(left[3] if left else 0, right[3] if right else 0)


def _balanced(key, left, right):
    """A node whose sides differ by one level at most, given sides that differ by two."""
    lean = (left[3] if left else 0) - (right[3] if right else 0)
    if lean > 1:
        k, a, b, _ = left
        if (a[3] if a else 0) >= (b[3] if b else 0):
            return _node(k, a, _node(key, b, right))
        return _node(b[0], _node(k, a, b[1]), _node(key, b[2], right))
    if lean < -1:
        k, a, b, _ = right
        if (b[3] if b else 0) >= (a[3] if a else 0):
            return _node(k, _node(key, left, a), b)
        return _node(a[0], _node(key, left, a[1]), _node(k, a[2], b))
    return _node(key, left, right)


def _inserted(at, key):
    if at is None:
        return _node(key, None, None)
    k, left, right, _ = at
    if key < k:
        return _balanced(k, _inserted(left, key), right)
    return _balanced(k, left, _inserted(right, key))


def _removed(at, key):
    k, left, right, _ = at
    if key < k:
        return _balanced(k, _removed(left, key), right)
    if key > k:
        return _balanced(k, left, _removed(right, key))
    if left is None or right is None:
        return left or right
    least = right
    while least[1]:
        least = least[1]
    return _balanced(least[0], left, _removed(right, least[0]))


class Bins:
    """Bins of one capacity, in a tree by remaining room."""

    def __init__(self, capacity: int):
        self.capacity, self.rooms, self.opened = capacity, RoomTree(), 0

    def put(self, size: int, count: int, limit: int | None = None):
        """Place ``count`` groups of ``size``; yields (bin, how many).  Returns
        early, with groups left over, if more than ``limit`` bins were needed."""
        while count:
            tightest = self.rooms.pop_at_least((size, -1))
            if tightest is not None:
                room, b = tightest
            elif limit is not None and self.opened >= limit:
                return
            else:
                room, b = max(self.capacity, size), self.opened
                self.opened += 1
            k = min(count, room // size)
            yield b, k
            count -= k
            self.rooms.insert((room - k * size, b))


def best_fit_runs(sizes: list[int], counts: list[int], capacity: int,
                  limit: int | None = None) -> list[tuple[int, int, int, int]] | None:
    """Best-fit decreasing of a size histogram: (size, first rank, end rank,
    bin); None if more than ``limit`` bins are needed."""
    bins, out = Bins(capacity), []
    for size, count in sorted(zip(sizes, counts), reverse=True):
        at = 0
        for b, k in bins.put(size, count, limit):
            out.append((size, at, at + k, b))
            at += k
        if at < count:
            return None
    return out


def fewest_capacity(sizes: list[int], counts: list[int], shards: int) -> list[tuple[int, int, int, int]]:
    """Runs for the smallest capacity (by bisection) at which best-fit
    decreasing needs at most ``shards`` bins.  A group that is larger than its
    fair share has a bin of its own; the others share the remaining bins."""
    order = sorted(zip(sizes, counts), reverse=True)
    alone, total, free = [], sum(s * c for s, c in order), shards
    while order and free > 1 and order[0][0] * free > total:
        size, count = order[0]
        rank = sum(1 for a in alone if a[0] == size)
        alone.append((size, rank))
        total, free = total - size, free - 1
        order[0] = (size, count - 1)
        if count == 1:
            order.pop(0)
    runs = [(size, rank, rank + 1, free + i) for i, (size, rank) in enumerate(alone)]
    taken: dict[int, int] = {}
    for size, _ in alone:
        taken[size] = taken.get(size, 0) + 1
    if order:
        ss, cc = [s for s, _ in order], [c for _, c in order]
        low, high = -(-total // free), total
        best = best_fit_runs(ss, cc, high, free)
        span = max(1, low // 10_000)
        probe = low
        while probe < high:                       # upwards in growing steps, then bisect
            got = best_fit_runs(ss, cc, probe, free)
            if got is not None:
                best, high = got, probe
                break
            low, probe, span = probe + 1, probe + span, span * 2
        while low < high:
            mid = (low + high) // 2
            got = best_fit_runs(ss, cc, mid, free)
            if got is None:
                low = mid + 1
            else:
                best, high = got, mid
        runs += [(s, a + taken.get(s, 0), z + taken.get(s, 0), b) for s, a, z, b in best]
    return runs


def ranked(df: DataFrame, by: list[str], spread, order: list, name: str, total_rows: int) -> DataFrame:
    """Gapless rank from 0 inside each ``by``: offset of the row's hash bucket
    plus its rank inside the bucket, so a hot ``by`` is spread over buckets."""
    buckets = max(1, -(-total_rows // ROWS_PER_BUCKET)) * 8
    df = df.withColumn("__bucket", F.pmod(F.xxhash64(spread), F.lit(buckets)))
    inner = Window.partitionBy(*by, "__bucket").orderBy(*order)
    counts = df.groupBy(*by, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    return (df.withColumn("__in", F.row_number().over(inner) - 1)
            .join(offsets, [*by, "__bucket"])
            .withColumn(name, (F.col("__in") + F.col("__before")).cast("long"))
            .drop("__in", "__before", "__bucket"))


def assign(groups: DataFrame, group_col: str, size_col: str, shards: int | None = None,
           capacity: int | None = None) -> DataFrame:
    """(group, size) → adds ``shard``.  With ``capacity``: as few fixed-capacity
    shards as best-fit decreasing needs (a larger group has one of its own
    size).  With ``shards``: that many, as even as it can make them."""
    if (shards is None) == (capacity is None):
        raise ValueError("give either shards or capacity")
    hist = groups.groupBy(F.col(size_col).alias("size")).agg(F.count(F.lit(1)).alias("n"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes, counts = [int(x) for x in pdf["size"]], [int(x) for x in pdf["n"]]
        runs = (best_fit_runs(sizes, counts, capacity) if shards is None
                else fewest_capacity(sizes, counts, shards))
        return pd.DataFrame(runs, columns=["size", "from_rank", "to_rank", "shard"])

    runs = hist.groupBy(F.lit(0).alias("all")).applyInPandas(
        run, "size long, from_rank long, to_rank long, shard int")
    runs = C.materialize(runs, "shard-runs")
    placed = ranked(groups, [size_col], F.col(group_col), [F.col(group_col)], "__rank", groups.count())
    return (placed.join(runs, (F.col(size_col) == F.col("size")) & (F.col("__rank") >= F.col("from_rank"))
                        & (F.col("__rank") < F.col("to_rank")))
            .select(*groups.columns, "shard"))


def shard_documents(df: DataFrame, shards: int | None = 16, capacity: int | None = None,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard all documents under the law ``bytes``: id, ``size``,
    ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard`` (null).

    Equal texts are one group (identity by MD5 and length, a null text with
    the empty one).  Texts never shuffle; slim rows do.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = C.materialize(df.select(
        F.col(id_col), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text.cast("binary"))).alias("key")),
        "shard-rows")
    groups = C.materialize(rows.groupBy("key", "size").agg(F.count(F.lit(1)).alias("copies"))
                           .select("key", (F.col("size") * F.col("copies")).alias("bytes")), "shard-groups")
    placed = rows.join(assign(groups, "key", "bytes", shards, capacity).select("key", "shard"), "key")
    placed = C.materialize(placed, "shard-placed")
    slots = ranked(placed, ["shard"], F.struct(F.col(id_col), F.col("key")), [F.col(id_col), F.col("key")],
                   "slot", placed.count())
    return slots.select(id_col, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))
