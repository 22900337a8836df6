"""SimHash near-dedup with bit-sliced comparison.

Fingerprints: texts are lower-cased (A-Z) and cut into words; every run of
``shingle`` words is hashed with XXH64 (seed 42); bit i of the fingerprint is 1
if it is set in over half of the hashes.  Fewer words: the whole sequence is
the only shingle.  No words (null, empty, blank): fingerprint zero.

Links: two fingerprints link if they differ in at most ``radius`` bits.  The 64
bits are cut into radius + 2 blocks; two linked fingerprints agree in at least
two whole blocks, so every pair of blocks gives a key under which all linked
pairs of distinct fingerprints meet.  Nothing is capped: a key with more than
``tile`` fingerprints is dealt into tiles, and pairs of tiles are compared as
cells of their own, each of at most about two tiles.

Comparison inside a task is bit-sliced.  The fingerprints of many keys, sorted
by key, stand vertically: plane p holds bit p of 64 neighbours in one machine
word.  For a shift k, plane XOR plane-shifted-by-k gives the differing bits of
all pairs (i, i + k) at once, and carry-save counters of three bits add them
up.  Words whose 64 pairs all exceed the radius, belong to different keys, or
join what is already connected are abandoned.

Only star edges of the connected pieces leave a task, never all pairs.  Their
components come from alternating large-star and small-star steps, each written
to the shared folder.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

TILE = 4096
BUFFER = 1 << 17


def simhash(words: list[bytes], shingle: int) -> int:
    """Fingerprint of one word sequence."""
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
        starts = [0, *ends[:-shingle].tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())]
    codes = np.array(hashes, dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(codes), 1 << 16):
        part = codes[at:at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(codes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, shingle: int, text_col: str = "text", out_col: str = "fp",
                 keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` plus the fingerprint as a signed long."""
    keep = [text_col] if keep is None else keep
    out = T.StructType([*(df.schema[c] for c in keep), T.StructField(out_col, T.LongType())])

    def run(batches):
        for b in C.slices(batches, text_col):
            fps = [simhash(x.lower().split(), shingle) for x in C.encode(b.column(text_col))]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in keep), pa.array(np.array(fps, dtype=np.uint64).view(np.int64))],
                names=out.names)

    return df.select(*dict.fromkeys([*keep, text_col])).mapInArrow(run, out)


# -- bit-sliced comparison --------------------------------------------------

def _planes(fps: np.ndarray) -> np.ndarray:
    """64 planes over the positions of ``fps``, as words of 64 positions, with
    spare zero words at the end for shifted reads."""
    n = len(fps)
    words = -(-n // 64)
    bits = np.zeros((words * 64, 64), dtype=np.uint8)
    bits[:n] = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")
    return np.concatenate([packed, np.zeros((64, 1), dtype=np.uint64)], axis=1)


def _mask_words(mask: np.ndarray) -> np.ndarray:
    padded = np.zeros(-(-len(mask) // 64) * 64, dtype=np.uint8)
    padded[:len(mask)] = mask
    return np.packbits(padded, bitorder="little").view("<u8")


def near_at_shift(planes: np.ndarray, valid: np.ndarray, shift: int, radius: int) -> np.ndarray:
    """Positions i with ``valid[i]`` whose fingerprint is within ``radius`` of
    the one at i + shift."""
    lanes = _mask_words(valid)
    active = np.flatnonzero(lanes)
    if not len(active):
        return active
    last = planes.shape[1] - 1
    step, bit = divmod(shift, 64)
    alive = lanes[active]
    one, two, four = (np.zeros(len(active), dtype=np.uint64) for _ in range(3))
    over = np.zeros(len(active), dtype=np.uint64)
    for p in range(64):
        low = planes[p][np.minimum(active + step, last)]
        if bit:
            high = planes[p][np.minimum(active + step + 1, last)]
            low = (low >> np.uint64(bit)) | (high << np.uint64(64 - bit))
        x = planes[p][active] ^ low
        carry = one & x
        one ^= x
        x = two & carry
        two ^= carry
        carry = four & x
        four ^= x
        over |= carry
        if p % 8 == 7:
            alive &= ~(over | _exceeds(one, two, four, radius))
            stay = np.flatnonzero(alive)
            if not len(stay):
                return stay
            if len(stay) < len(active):
                active, alive, one, two, four, over = (a[stay] for a in (active, alive, one, two, four, over))
    bits = np.unpackbits(np.ascontiguousarray(alive).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    word, lane = np.nonzero(bits)
    return active[word] * 64 + lane


def _exceeds(one, two, four, radius: int) -> np.ndarray:
    """Lanes whose three-bit count is above ``radius`` (0 to 7)."""
    out = np.zeros(len(one), dtype=np.uint64)
    for count in range(radius + 1, 8):
        match = ~np.zeros(len(one), dtype=np.uint64)
        for counter, bit in ((one, 1), (two, 2), (four, 4)):
            match &= counter if count & bit else ~counter
        out |= match
    return out


def connect(fps: np.ndarray, group: np.ndarray, side: np.ndarray, radius: int) -> np.ndarray:
    """Root position of every fingerprint among those it is linked to inside
    its group.  ``side`` is -1 where all pairs count, else only pairs of
    different sides do."""
    n = len(fps)
    root = np.arange(n)
    planes = _planes(fps)
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    longest = int(np.diff(np.concatenate([starts, [n]])).max())

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for shift in range(1, longest):
        valid = ((group[:-shift] == group[shift:]) & (root[:-shift] != root[shift:])
                 & ((side[:-shift] < 0) | (side[:-shift] != side[shift:])))
        hits = near_at_shift(planes, valid, shift, radius)
        if not len(hits):
            continue
        for i in hits.tolist():
            a, b = find(i), find(i + shift)
            if a != b:
                root[max(a, b)] = min(a, b)
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    return root


def link_edges(distinct: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Star edges (``a`` > ``b``) that connect all distinct fingerprints within
    ``radius``; ``distinct`` has the column ``fp``."""
    if not 0 <= radius <= 7:
        raise ValueError("radius must be between 0 and 7")
    blocks = radius + 2
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    fp = F.col("fp")

    def block(i):
        width = cuts[i + 1] - cuts[i]
        return F.shiftrightunsigned(fp, cuts[i]).bitwiseAND((1 << width) - 1)

    keys = [F.struct(F.lit(k).alias("k"), block(i).alias("x"), block(j).alias("y"))
            for k, (i, j) in enumerate(combinations(range(blocks), 2))]
    keyed = distinct.select("fp", F.explode(F.array(*keys)).alias("key")).select(
        "fp", F.xxhash64("key.k", "key.x", "key.y").alias("key"))
    big = (keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tile)
           .select(F.col("key").alias("big"), F.ceil(F.col("n") / tile).cast("int").alias("tiles")))
    big = C.materialize(big, "simhash-tiles")
    tiled = keyed.join(big, F.col("key") == F.col("big"), "left").withColumn(
        "own", F.when(F.col("tiles").isNotNull(), F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")).otherwise(0))
    cells = tiled.select("fp", "key", "own", F.explode(F.sequence(F.lit(0), F.coalesce("tiles", F.lit(1)) - 1)).alias("other"))
    cells = cells.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "fp")

    out = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def flush(parts):
        key, i, j, own, fps = (np.concatenate(c) for c in zip(*parts))
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
        root = connect(fps.view(np.uint64), np.cumsum(new), np.where(i == j, -1, own), radius)
        linked = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([pa.array(fps[linked]), pa.array(fps[root[linked]])], names=out.names)

    def run(batches):
        parts, held = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(c).to_numpy() for c in ("key", "i", "j", "own", "fp")]
            if held >= BUFFER:
                # everything up to the last change of cell is complete
                change = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])
                                        | (cols[2][1:] != cols[2][:-1]))
                first = tuple(c[0] for c in cols[:3]) != tuple(c[-1] for c in parts[-1][:3])
                cut = int(change[-1]) + 1 if len(change) else (0 if first else None)
                if cut is not None:
                    if cut:
                        parts.append([c[:cut] for c in cols])
                    yield flush(parts)
                    parts, held, cols = [], 0, [c[cut:] for c in cols]
            parts.append(cols)
            held += len(cols[0])
        if parts:
            yield flush(parts)

    spread = max(2, int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (cells.repartition(spread, "key", "i", "j").sortWithinPartitions("key", "i", "j", "fp")
            .mapInArrow(run, out))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(``node``, ``root``) for every node of the edges (``a``, ``b``): the
    smallest node reachable, by alternating large-star and small-star steps."""
    e = C.materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m")).select(
            "n", F.least("n", "m").alias("m"))
        large = (both.filter("v > u").join(low, F.col("u") == F.col("n"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        large = C.materialize(large, "large-star")
        least = large.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        small = (large.join(least, F.col("u") == F.col("n")).filter("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct())
        e = C.materialize(small, "small-star")
        now = tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1000003))
                    .first())
        if now == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
    raise RuntimeError("components did not settle")


def _row_hashes(id_col: str, text_col: str) -> tuple:
    """Two hashes of id and text: 128 bits that tell different rows apart."""
    return F.xxhash64(id_col, text_col), F.xxhash64(F.lit("row"), text_col, id_col)


def linked_rows(df: DataFrame, shingle: int, radius: int, tile: int = TILE,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One slim row per input row: id, ``row`` and ``row2`` (two hashes of id
    and text), ``fp``, ``root`` (smallest fingerprint of the component) and
    ``component_id``."""
    row, row2 = _row_hashes(id_col, text_col)
    marked = df.select(F.col(id_col), row.alias("row"), row2.alias("row2"), F.col(text_col))
    rows = C.materialize(fingerprints(marked, shingle, text_col, "fp", [id_col, "row", "row2"]), "fingerprints")
    distinct = C.materialize(rows.groupBy("fp").agg(F.min(id_col).alias("least")), "distinct-fingerprints")
    roots = components(link_edges(distinct.select("fp"), radius, tile))
    nodes = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = nodes.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("component_id"))
    of_fp = nodes.join(named, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "root", "component_id")
    return rows.join(of_fp, F.col("fp") == F.col("f")).select(
        id_col, "row", "row2", "fp", "root", "component_id")


def near_duplicates(df: DataFrame, shingle: int = 4, radius: int = 4, tile: int = TILE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``fingerprint`` (16 hex digits) and ``component_id`` (smallest id
    reachable over links) of every row.  A null id is never the smallest unless
    its component has no other."""
    return linked_rows(df, shingle, radius, tile, id_col, text_col).select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_component(df: DataFrame, linked: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay if each component of ``linked`` keeps the
    row with its smallest id (repeated rows: one).  The texts shuffle once: the
    rank of repeated rows uses the join's partitions."""
    first = linked.groupBy("root").agg(
        F.min(F.struct(F.col(id_col).isNull(), F.col(id_col), F.col("row"), F.col("row2"))).alias("m"))
    row, row2, rank, of, of2 = (C.free_name(df, x) for x in ("row", "row2", "rank", "of", "of2"))
    keep = first.select(F.col("m.row").alias(of), F.col("m.row2").alias(of2))
    one, two = _row_hashes(id_col, text_col)
    same = Window.partitionBy(row, row2).orderBy(F.lit(1))
    return (df.withColumns({row: one, row2: two})
            .join(keep, (F.col(row) == F.col(of)) & (F.col(row2) == F.col(of2)), "left_semi")
            .withColumn(rank, F.row_number().over(same)).filter(F.col(rank) == 1)
            .select(*[F.col(f"`{c}`") for c in df.columns]))
