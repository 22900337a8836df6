import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from fleetlens.llm import merkle, queries

from .conftest import DOCS, odd_rows


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, i):
    """(top, siblings of node i level by level)."""
    path = []
    while len(nodes) > 1:
        run = nodes[i // 3 * 3:i // 3 * 3 + 3]
        path.append((run[:i % 3], run[i % 3 + 1:]))
        nodes, i = [h("".join(nodes[k:k + 3])) for k in range(0, len(nodes), 3)], i // 3
    return nodes[0], path


def brute(docs):
    """docs: (doc_id, source, lang, n_chars, text)."""
    by = {}
    for d in docs:
        by.setdefault(d[1], []).append(d)
    keys = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(((d[0], leaf(d), d) for d in by[s]), key=lambda x: (x[0] is not None, x[0] or 0, x[1])) for s in keys}
    subroots = [tree([x[1] for x in trees[s]], 0)[0] for s in keys]
    out = []
    for k, s in enumerate(keys):
        root, above = tree(subroots, k)
        for i, (doc_id, own, d) in enumerate(trees[s]):
            path = tree([x[1] for x in trees[s]], i)[1] + above
            seen = own
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
                seen = leaf([*d[:4], d[4] if d[4] is None else d[4].replace("\n", "")])
            for left, right in path:
                seen = h("".join([*left, seen, *right]))
            proof = h("".join(x for left, right in path for x in (*left, *right)))
            out.append((doc_id, own, subroots[k], root, proof, seen, seen == root))
    return sorted(out, key=repr)


COLS = ("doc_id", "source", "lang", "n_chars", "text")


def got(df, segment):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    p = merkle.document_proofs(df, tampered, F.translate("text", "\n", ""), segment=segment)
    rows = p.select("id", "leaf", "subroot", "root", F.sha2(F.concat_ws("", "proof"), 256), "folded_root", "verified")
    return sorted((tuple(r) for r in rows.collect()), key=repr)


@pytest.mark.parametrize("segment", [1, 4, 20_000])
def test_odd_rows(odd, segment):
    index = {c: k for k, c in enumerate(f.name for f in DOCS)}
    assert got(odd, segment) == brute([tuple(r[index[c]] for c in COLS) for r in odd_rows()])


@pytest.mark.parametrize("segment", [7, 20_000])
def test_table(small, segment):
    assert got(small, segment) == brute([tuple(r) for r in small.select(*COLS).collect()])


def test_query(spark, sf, small):
    rows = sorted((tuple(r) for r in queries.op11_merkle(spark, sf).collect()), key=repr)
    assert rows == brute([tuple(r) for r in small.select(*COLS).collect()])
    assert {r[-1] for r in rows} == {True, False}


def test_empty(none):
    assert got(none, 10) == []


def test_many_levels_in_blocks(spark):
    """Blocks of 3 leaves: every level is a round of its own."""
    n = 85
    df = spark.range(n).select(F.lit("1s").alias("tree"), "id", F.sha2(F.col("id").cast("string"), 256).alias("hash"),
                               F.lit(None).cast("string").alias("seen"))
    placed, spans, nodes = merkle.manifest(df, n, levels=1, segment=10)
    rows = merkle.prove(placed, spans, nodes, 9).collect()
    leaves = [h(str(i)) for i in range(n)]
    for r in rows:
        top, path = tree(leaves, r.id)
        assert (r.subroot, r.root, r.verified) == (top, top, True)
        assert list(r.proof) == [x for left, right in path for x in (*left, *right)]


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_missing_is_the_minimal_union(arity):
    """Against the set form: all siblings on the paths, less what is known or derivable."""
    for n in (1, 2, 7, 26, 27, 28):
        for a in range(n):
            for b in range(a, n):
                known, want, level, size = set(range(a, b + 1)), set(), 0, n
                while size > 1:
                    run = {k for i in known for k in range(i // arity * arity, min(i // arity * arity + arity, size))}
                    want |= {(level, k) for k in run - known}
                    known, size, level = {i // arity for i in known}, -(-size // arity), level + 1
                found = merkle.missing(a, b, n, arity)
                assert len(found) == len(set(found)) and set(found) == want
