"""Best-fit packing of token pieces into sequences by hierarchical residuals.

1. Every document is tokenised whole; a longer one than a sequence is cut into full
   pieces, the remainder first.  Full pieces are sequences already.
2. The other pieces are dealt over partitions by a hash.  Each partition packs
   its own by best-fit decreasing and emits the bins that are nearly full.
3. The underfull bins travel on as items.  A tree merges them: every round
   packs groups of several former partitions again and accepts a little more
   slack, until one task's worth is left or a round saves nothing.

The bins of a round are written to the shared folder before the next round
starts, and each partition packs in a fixed order, so a lost executor repeats
its share with the same outcome.

Null texts are empty: one piece that holds the end token alone.  Repeated rows
are documents of their own.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C
from .bpe import codec

FAN_IN = 8
TASK_ITEMS = 200_000
FIRST_ITEMS = 20_000


def pieces(df: DataFrame, tokenizer: str, capacity: int, end_id: int,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``piece``, ``start``, ``length``, ``ids_crc32``) of every document."""
    out = T.StructType([df.schema[id_col], T.StructField("piece", T.IntegerType()),
                        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                        T.StructField("ids_crc32", T.LongType())])
    tail = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        code = codec(tokenizer)
        for b in C.slices(batches, text_col):
            take, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(code.encode_whole(C.texts(b.column(text_col)))):
                ids += tail
                n = len(ids) // 4
                at, k = 0, 0
                while at < n:
                    size = (n - 1) % capacity + 1 if at == 0 else capacity
                    take.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(ids[4 * at:4 * (at + size)]))
                    at, k = at + size, k + 1
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col).take(pa.array(take, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=out.names)

    return df.select(id_col, text_col).mapInArrow(run, out)


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Item numbers of each bin.  Open bins are kept by remaining room; one
    integer has a bit for every room in use, so the tightest bin that takes an
    item is found by its lowest set bit at or above the item's size."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    used = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = used >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                used &= ~(1 << room)
            bins[at].append(i)
        else:
            room, at = capacity, len(bins)
            bins.append([i])
        left = room - size
        if left:
            by_room[left].append(at)
            used |= 1 << left
    return bins


def _round(items: DataFrame, capacity: int, slack: int, last: bool) -> DataFrame:
    """Pack the items of every partition; ``done`` marks bins to emit."""
    out = T.StructType([*(f for f in items.schema.fields if f.name in ("fill", "members")),
                        T.StructField("done", T.BooleanType())])

    def run(batches):
        table = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if table is None:
            return
        table = table.sort_by([("key", "ascending"), ("fill", "ascending")])
        sizes = table.column("fill").to_numpy()
        groups = best_fit_decreasing(sizes, capacity)
        order = np.concatenate([np.array(g, dtype=np.int64) for g in groups])
        members = table.column("members").combine_chunks().take(pa.array(order))
        inner = members.flatten()
        counts = np.asarray(pc.list_value_length(members)).astype(np.int64)
        per_bin = np.array([len(g) for g in groups], dtype=np.int64)
        ends = np.cumsum(per_bin)
        upto = np.concatenate([[0], np.cumsum(counts)])
        offsets = np.concatenate([[0], upto[ends]]).astype(np.int32)
        fill = np.add.reduceat(sizes[order], ends - per_bin)
        packed = pa.ListArray.from_arrays(pa.array(offsets), inner)
        done = np.full(len(groups), True) if last else fill >= capacity - slack
        yield from pa.Table.from_arrays([pa.array(fill), packed, pa.array(done)],
                                        names=out.names).to_batches(max_chunksize=5000)

    return items.select("key", "fill", "members").mapInArrow(run, out)


def pack(parts: DataFrame, capacity: int, id_col: str = "doc_id", fan_in: int = FAN_IN,
         task_items: int = TASK_ITEMS, first_items: int = FIRST_ITEMS) -> DataFrame:
    """Pack rows of ``pieces`` into sequences; adds ``sequence_id`` and ``offset``.

    ``first_items`` are the items of a partition of the first round, and
    ``task_items`` bounds what one task packs later: the tree narrows by
    ``fan_in`` as far as the bins still underfull fit.  When a round saves
    hardly anything, what is left meets in one last task if it fits, else it
    is emitted.  Widths follow from the items alone, so the sequences are the
    same on any number of cores.
    """
    parts = C.materialize(parts, "pieces")
    member = F.struct(*[F.col(c) for c in parts.columns])
    full = parts.filter(F.col("length") >= capacity)
    items = parts.filter(F.col("length") < capacity).select(
        F.xxhash64(*parts.columns).alias("key"), F.col("length").alias("fill"), F.array(member).alias("members"))

    bins = [full.select(F.col("length").alias("fill"), F.array(member).alias("members"))]
    left = items.count()
    width = max(1, -(-left // min(task_items, first_items)))
    slack, seed = max(1, capacity // 64), 0
    while left:
        last = width == 1
        # a hash of the bin's own key and of the round mixes bins that have not met yet
        dealt = items.repartition(width, F.xxhash64("key", F.lit(seed)))
        packed = C.materialize(_round(dealt, capacity, slack, last), "bins")
        bins.append(packed.filter("done").select("fill", "members"))
        if last:
            break
        rest = packed.filter(~F.col("done"))
        now = rest.count()
        items = rest.select(F.xxhash64("members").alias("key"), "fill", "members")
        seed += 1
        stalled = now >= 0.98 * left and seed > 1      # little to gain by meeting again
        if stalled and now > task_items:
            bins.append(rest.select("fill", "members"))
            break
        left, slack = now, min(capacity, slack * 2)
        width = 1 if stalled else max(1, -(-left // task_items), width // fan_in)

    every = bins[0]
    for b in bins[1:]:
        every = every.unionByName(b)
    return _unfold(every.withColumn("sequence_id", F.monotonically_increasing_id()))


def _unfold(bins: DataFrame) -> DataFrame:
    """One row per piece, with its place in the sequence."""
    member = bins.schema["members"].dataType.elementType
    out = T.StructType([*member.fields, T.StructField("sequence_id", T.LongType()),
                        T.StructField("offset", T.LongType())])

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            members = b.column("members")
            counts = np.asarray(pc.list_value_length(members)).astype(np.int64)
            inner = members.flatten()
            length = inner.field("length").to_numpy()
            before = np.cumsum(length) - length
            heads = np.cumsum(counts) - counts
            offset = before - np.repeat(before[heads], counts)
            ids = np.repeat(b.column("sequence_id").to_numpy(), counts)
            yield pa.RecordBatch.from_arrays([*(inner.field(f.name) for f in member.fields),
                                              pa.array(ids), pa.array(offset)], names=out.names)

    return bins.select("members", "sequence_id").mapInArrow(run, out)


def pack_documents(df: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise, cut and pack all documents: id, ``piece``, ``start``,
    ``length``, ``ids_crc32``, ``sequence_id``, ``offset``."""
    return pack(pieces(df, tokenizer, capacity, end_id, id_col, text_col), capacity, id_col)
