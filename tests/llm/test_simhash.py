from itertools import combinations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlens.llm import simhash

from .conftest import lower, odd_rows, rows, words


def fingerprint(text, k=4):
    w = words(lower(text))
    if not w:
        return 0
    grams = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(data, radius=4):
    fps = [fingerprint(t) for _, t in data]
    root = list(range(len(data)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(range(len(data)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= radius:
            root[find(a)] = find(b)
    low = {}
    for i, (d, _) in enumerate(data):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, f"{fps[i]:016x}", low.get(find(i))) for i, (d, _) in enumerate(data)), key=repr)


@pytest.mark.parametrize("tile", [3, simhash.TILE])
def test_odd_rows(odd, tile):
    assert rows(simhash.near_duplicates(odd, tile=tile)) == brute([(r[0], r[1]) for r in odd_rows()])


def test_table(small):
    assert rows(simhash.near_duplicates(small)) == brute([(r.doc_id, r.text) for r in small.collect()])


def test_spark_hash_is_the_same(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0] % (1 << 64)
    assert got == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_empty(none):
    assert simhash.near_duplicates(none).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(2, 300), st.integers(0, 7))
def test_bit_sliced_links_equal_popcount(seed, n, radius):
    rng = np.random.default_rng(seed)
    group = np.sort(rng.integers(0, max(1, n // 20), n))
    centre = rng.integers(0, 1 << 63, n // 8 + 1, dtype=np.uint64)[rng.integers(0, n // 8 + 1, n)]
    flips = np.zeros(n, dtype=np.uint64)
    for _ in range(4):
        flips ^= np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
    fps = centre ^ flips
    side = np.where(rng.integers(0, 2, n) == 0, -1, rng.integers(0, 2, n))
    side = np.where(np.isin(group, group[side < 0]), -1, side)
    root = simhash.connect(fps, group, side, radius)
    want = np.arange(n)

    def find(i):
        while want[i] != i:
            i = want[i]
        return i

    for a, b in combinations(range(n), 2):
        if group[a] == group[b] and (side[a] < 0 or side[a] != side[b]) \
                and int(fps[a] ^ fps[b]).bit_count() <= radius:
            x, y = find(a), find(b)
            want[max(x, y)] = min(x, y)
    assert root.tolist() == [find(i) for i in range(n)]


@pytest.mark.parametrize("tile", [16, 4096])
def test_links_across_tiles(spark, tile):
    """A chain and a cloud of near fingerprints keep one component each."""
    rng = np.random.default_rng(5)
    cloud = np.uint64(0x0F0F1234ABCD5678) ^ np.array(
        [(1 << int(a)) | (1 << int(b)) for a, b in rng.integers(0, 64, (300, 2))], dtype=np.uint64)
    chain, at = [], 0x123456789ABCDEF0
    for k in range(30):
        at ^= 0b1111 << (4 * (k % 16))
        chain.append(at ^ (k // 16 << 3))
    fps = np.unique(np.concatenate([cloud, np.array(chain, dtype=np.uint64)])).view(np.int64).tolist()
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    roots = {r.node: r.root for r in simhash.components(simhash.link_edges(frame, 4, tile)).collect()}
    got = {f: roots.get(f, f) for f in fps}
    mask = (1 << 64) - 1
    want = {f: f for f in fps}
    for a, b in combinations(fps, 2):
        if ((a ^ b) & mask).bit_count() <= 4:
            low, high = sorted((want[a], want[b]))
            if low != high:
                want = {k: low if v == high else v for k, v in want.items()}
    assert got == want


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    got = simhash.components(edges).collect()
    assert {r.root for r in got} == {0} and len(got) == 200
