"""Merkle dataset manifest with octopus multiproofs.

Every row is a leaf; the leaves of a tree (here: of a source) stand in order
and every ``ARITY`` consecutive nodes have their hash as parent, until one node
is left, the tree's subroot.  The subroots, in order of the tree's key, are the
leaves of one more tree, whose top is the root of the manifest.

1. Slim leaves are range-partitioned by (tree, id) into segments; counts per
   (segment, tree) give every leaf its gapless index in its tree.
2. Trees are built from aligned blocks of ``ARITY ** LEVELS`` leaves: a task
   folds a block several levels up and the block tops meet in the next round,
   so a hot tree is spread over its blocks and needs few rounds.
3. Proofs, the octopus: a segment's leaves are a run of each of its trees, so
   most siblings on their paths are known or derivable inside the segment.  A
   segment asks once for the minimal union of the node coordinates that are
   not, all of them by one join; a task then derives the shared interior nodes
   from the segment's leaves and the fetched nodes, and expands every leaf's
   own proof from them.

A task holds one segment (about ``SEGMENT`` leaves) or one block at a time.

Defined cases: null values hash as ``-``; a null tree key is a tree of its own,
before the others.  Leaves with the same id, repeated rows too, are ordered by
their hash; a null id comes first.  An empty table has no rows and no root.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

ARITY, LEVELS, SEGMENT = 3, 7, 20_000
TOP = ""                    # key of the tree over the subroots; other keys are not empty


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_hash(values: list[Column]) -> Column:
    """SHA-256 of the values, each as byte count, ``:`` and value, or ``-`` if null."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts)), 256)


def numbered(leaves: DataFrame, order: list[str], rows: int, segment: int) -> tuple[DataFrame, DataFrame]:
    """Leaves (``tree`` and others) with ``seg``, gapless ``idx`` in their tree
    and its size ``n``; and the spans (``seg``, ``tree``, ``n``, ``a``, ``b``)."""
    parts = max(1, -(-rows // segment))
    # identical rows may be many: the scan position lets them spread over segments too
    leaves = leaves.withColumn("tie", F.monotonically_increasing_id())
    placed = (leaves.repartitionByRange(parts, "tree", *order, "tie").sortWithinPartitions("tree", *order, "tie")
              .withColumns({"seg": F.spark_partition_id(),
                            "at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}).drop("tie"))
    placed = C.materialize(placed, "merkle-placed")
    counts = placed.groupBy("tree", "seg").agg(F.count(F.lit(1)).alias("c"), F.min("at").alias("first"))
    # a window row is a (tree, segment): at most as many per tree as there are segments
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("c").over(tree.orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = C.materialize(counts.select(F.col("tree").alias("t"), F.col("seg").alias("s"), "first", "c",
                                        before.alias("a"), F.sum("c").over(tree).alias("n")), "merkle-spans")
    out = placed.join(spans, (F.col("tree") == F.col("t")) & (F.col("seg") == F.col("s")))
    out = out.select(*leaves.drop("tie").columns, "seg", (F.col("at") - F.col("first") + F.col("a")).alias("idx"), "n")
    return out, spans.select(F.col("s").alias("seg"), F.col("t").alias("tree"), "n", "a",
                             (F.col("a") + F.col("c") - 1).alias("b"))


def height(n: int, arity: int = ARITY) -> int:
    h = 0
    while n > 1:
        n, h = -(-n // arity), h + 1
    return h


def parents(hashes: list[str], arity: int = ARITY) -> list[str]:
    return [digest("".join(hashes[i:i + arity])) for i in range(0, len(hashes), arity)]


_NODE = "tree string, n long, level int, idx long, hash string, top boolean"
_NODE_ARROW = pa.schema([("tree", pa.string()), ("n", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()),
                         ("hash", pa.string()), ("top", pa.bool_())])


def build(leaves: DataFrame, spark_parts: int, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """All nodes above the leaves (``tree``, ``n``, ``idx``, ``hash``) as
    ``tree``, ``n``, ``level``, ``idx``, ``hash``, ``top`` (the tree's subroot).
    Level 0 is there for trees of one leaf only, whose leaf is the subroot."""
    width = arity ** levels

    def fold(batches):
        def close(tree, n, level, first, hashes):
            size = n
            for _ in range(level):
                size = -(-size // arity)
            if size == 1:                              # a lone leaf
                yield tree, n, level, first, hashes[0], True
            for up in range(1, levels + 1):
                if size == 1:
                    return
                size, first, hashes = -(-size // arity), first // arity, parents(hashes, arity)
                for k, h in enumerate(hashes):
                    yield tree, n, level + up, first + k, h, size == 1

        held, out = None, []
        for b in batches:
            for tree, n, level, idx, h in zip(*(b.column(c).to_pylist() for c in ("tree", "n", "level", "idx", "hash"))):
                if held is None or held[0] != tree or held[3] // width != idx // width:
                    if held is not None:
                        out += close(*held)
                    held = (tree, n, level, idx, [])
                held[4].append(h)
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _NODE_ARROW)],
                                                 schema=_NODE_ARROW)
                out = []
        if held is not None:
            out += close(*held)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _NODE_ARROW)],
                                             schema=_NODE_ARROW)

    most = leaves.agg(F.max("n")).first()[0] or 1
    rounds = max(1, -(-height(most, arity) // levels))
    now = leaves.select("tree", "n", F.lit(0).alias("level"), "idx", "hash")
    nodes = None
    for r in range(rounds):
        block = F.floor(F.col("idx") / width).cast("long")
        made = (now.withColumn("block", block).repartition(spark_parts, "tree", "block")
                .sortWithinPartitions("tree", "block", "idx").mapInArrow(fold, _NODE))
        made = C.materialize(made, f"merkle-nodes-{r}")
        nodes = made if nodes is None else nodes.unionByName(made)
        now = made.filter((F.col("level") == (r + 1) * levels) & ~F.col("top")).drop("top")
    return nodes


def missing(a: int, b: int, n: int, arity: int = ARITY) -> list[tuple[int, int]]:
    """Coordinates (level, index) that the proofs of leaves a..b of n need and
    that cannot be derived from these leaves: the siblings at both edges."""
    out, level = [], 0
    while n > 1:
        first, last = a // arity, b // arity
        out += [(level, i) for i in range(first * arity, a)]
        out += [(level, i) for i in range(b + 1, min((last + 1) * arity, n))]
        a, b, n, level = first, last, -(-n // arity), level + 1
    return out


class Run:
    """The nodes on and beside the paths of leaves a..b, level by level:
    derived from the leaves and the fetched nodes."""

    def __init__(self, a: int, hashes: list[str], n: int, fetched: dict[tuple[int, int], str], arity: int = ARITY):
        self.arity, self.levels, self.sizes = arity, [], []
        here, level, b = dict(enumerate(hashes, a)), 0, a + len(hashes) - 1
        while n > 1:
            a, b = a // arity, b // arity
            for i in range(a * arity, min((b + 1) * arity, n)):
                if i not in here:
                    here[i] = fetched[level, i]
            self.levels.append(here)
            self.sizes.append(n)
            here = {p: digest("".join(here[i] for i in range(p * arity, min((p + 1) * arity, n))))
                    for p in range(a, b + 1)}
            n, level = -(-n // arity), level + 1
        self.top = here[0]
        self._known: dict[tuple[int, int], list[tuple[list[str], list[str]]]] = {}

    def siblings(self, i: int, level: int = 0) -> list[tuple[list[str], list[str]]]:
        """(left, right) siblings from this node up to the top; shared by the
        leaves below a node."""
        if level == len(self.levels):
            return []
        known = self._known.get((level, i))
        if known is None:
            p, here = i // self.arity, self.levels[level]
            end = min((p + 1) * self.arity, self.sizes[level])
            step = ([here[k] for k in range(p * self.arity, i)], [here[k] for k in range(i + 1, end)])
            known = [step, *self.siblings(p, level + 1)]
            if level:                                  # a leaf's own list is used once
                self._known[level, i] = known
        return known


def fold_up(leaf: str, siblings: list[tuple[list[str], list[str]]]) -> str:
    """The top that a leaf and its siblings give."""
    for left, right in siblings:
        leaf = digest("".join([*left, leaf, *right]))
    return leaf


_PROOF = ("id long, tree string, leaf string, subroot string, root string, proof array<string>, "
          "folded_root string, verified boolean")
_PROOF_ARROW = pa.schema([("id", pa.int64()), ("tree", pa.string()), ("leaf", pa.string()), ("subroot", pa.string()),
                          ("root", pa.string()), ("proof", pa.list_(pa.string())), ("folded_root", pa.string()),
                          ("verified", pa.bool_())])


def manifest(leaves: DataFrame, rows: int | None = None, arity: int = ARITY, levels: int = LEVELS,
             segment: int = SEGMENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Leaves (``tree``, ``id``, ``hash``, ``seen``) → placed leaves, spans and
    all nodes but the leaves themselves, the tree ``TOP`` over the subroots
    included.  ``seen``: the hash to verify, null for that of the leaf."""
    rows = leaves.count() if rows is None else rows
    parts = max(1, -(-rows // segment))
    placed, spans = numbered(leaves, ["id", "hash", "seen"], rows, segment)
    placed = C.materialize(placed, "merkle-leaves")
    nodes = build(placed, parts, arity, levels)
    subroots = C.materialize(nodes.filter("top").select(F.lit(TOP).alias("tree"), F.col("tree").alias("of"), "hash"),
                             "merkle-subroots")
    ranked, _ = numbered(subroots, ["of"], subroots.count(), segment)
    ranked = C.materialize(ranked, "merkle-ranked")
    over = build(ranked, max(1, -(-subroots.count() // segment)), arity, levels)
    cols = ["tree", "level", "idx", "hash"]
    everything = (nodes.filter("level > 0").select(*cols)
                  .unionByName(ranked.select("tree", F.lit(0).alias("level"), "idx", "hash"))
                  .unionByName(over.filter("level > 0").select(*cols)))
    # a segment's trees are neighbours, so their subroots are a run of the top tree
    ranks = ranked.select("of", F.col("idx").alias("rank"), F.col("n").alias("k"))
    spans = spans.join(ranks, F.col("tree") == F.col("of")).drop("of")
    top = spans.groupBy("seg").agg(F.lit(TOP).alias("tree"), F.max("k").alias("n"), F.min("rank").alias("a"),
                                   F.max("rank").alias("b"))
    spans = C.materialize(spans.select("seg", "tree", "n", "a", "b").unionByName(top), "merkle-asked")
    return placed, spans, everything


def prove(placed: DataFrame, spans: DataFrame, nodes: DataFrame, parts: int, arity: int = ARITY) -> DataFrame:
    """One row per leaf: ``id``, ``tree``, ``leaf``, ``subroot``, ``root``,
    ``proof`` (siblings, level by level to the root, left to right),
    ``folded_root`` and ``verified``."""
    def ask(batches):
        for b in batches:
            for seg, tree, n, a, z in zip(*(b.column(c).to_pylist() for c in ("seg", "tree", "n", "a", "b"))):
                found = missing(a, z, n, arity)
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([seg] * len(found), pa.int32()), pa.array([tree] * len(found), pa.string()),
                         pa.array([x[0] for x in found], pa.int32()), pa.array([x[1] for x in found], pa.int64())],
                        names=["seg", "of", "at", "no"])

    asked = spans.mapInArrow(ask, "seg int, of string, at int, no long")
    known = nodes.unionByName(placed.select("tree", F.lit(0).alias("level"), "idx", "hash"))
    fetched = asked.join(known, (F.col("of") == F.col("tree")) & (F.col("at") == F.col("level"))
                         & (F.col("no") == F.col("idx")))
    none = F.lit(None)
    sent = (fetched.select("seg", F.lit(0).alias("kind"), "tree", "level", "idx", "hash", none.cast("long").alias("n"),
                           none.cast("long").alias("id"), none.cast("string").alias("seen"))
            .unionByName(spans.select("seg", F.lit(1).alias("kind"), "tree", none.cast("int").alias("level"),
                                      F.col("a").alias("idx"), none.cast("string").alias("hash"), "n",
                                      none.cast("long").alias("id"), none.cast("string").alias("seen")))
            .unionByName(placed.select("seg", F.lit(2).alias("kind"), "tree", none.cast("int").alias("level"), "idx",
                                       "hash", "n", "id", "seen")))
    names = ("seg", "kind", "tree", "level", "idx", "hash", "n", "id", "seen")

    def expand(batches):
        def close(fetched, spans, leaves):
            runs = {t: Run(spans[t][0], [x[1] for x in rows], spans[t][1], fetched.get(t, {}), arity)
                    for t, rows in leaves.items()}
            a, k = spans[TOP]
            over = Run(a, [runs[t].top for t in leaves], k, fetched.get(TOP, {}), arity)
            out = []
            for r, (tree, rows) in enumerate(leaves.items()):
                above = over.siblings(a + r)
                for i, h, ident, seen in rows:
                    path = runs[tree].siblings(i) + above
                    folded = fold_up(h if seen is None else seen, path)
                    out.append((ident, tree, h, runs[tree].top, over.top, [x for l, z in path for x in (*l, *z)],
                                folded, folded == over.top))
                    if len(out) == 2000:
                        yield out
                        out = []
            if out:
                yield out

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PROOF_ARROW)],
                                              schema=_PROOF_ARROW)

        held = None
        for b in batches:
            for seg, kind, tree, level, idx, h, n, ident, seen in zip(*(b.column(c).to_pylist() for c in names)):
                if held is None or held[0] != seg:
                    if held is not None:
                        yield from map(batch, close(*held[1:]))
                    held = (seg, {}, {}, {})
                if kind == 0:
                    held[1].setdefault(tree, {})[level, idx] = h
                elif kind == 1:
                    held[2][tree] = (idx, n)
                else:
                    held[3].setdefault(tree, []).append((idx, h, ident, seen))
        if held is not None:
            yield from map(batch, close(*held[1:]))

    return (sent.repartition(parts, "seg").sortWithinPartitions("seg", "kind", "tree", "level", "idx")
            .mapInArrow(expand, _PROOF))


def document_proofs(df: DataFrame, tampered: Column, seen_text: Column, segment: int = SEGMENT) -> DataFrame:
    """Proofs of all documents, a tree per ``source``; where ``tampered`` is
    true the leaf that is verified has ``seen_text`` as its text."""
    def leaf(text):
        return leaf_hash([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text])

    tree = F.coalesce(F.concat(F.lit("1"), F.col("source")), F.lit("0"))
    leaves = C.materialize(df.select(
        tree.alias("tree"), F.col("doc_id").cast("long").alias("id"), leaf(F.col("text")).alias("hash"),
        F.when(tampered, leaf(seen_text)).alias("seen")), "merkle-rows")
    rows = leaves.count()
    placed, spans, nodes = manifest(leaves, rows, segment=segment)
    return prove(placed, spans, nodes, max(1, -(-rows // segment)))
