import math
import re
from collections import Counter

import numpy as np
import pytest

from fleetlens.llm import queries, search

from .conftest import lower, odd_rows

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, items, k=20):
    data = [(i, TERM.findall(lower(t))) for i, t in docs]
    data = [(i, Counter(ts), len(ts)) for i, ts in data if ts]
    n_docs, total = len(data), sum(n for _, _, n in data)
    df = Counter(t for _, c, _ in data for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in data:
            m = 100 - 25 + (25 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in TERM.findall(lower(text)) if c[t])
            if score > 0:
                found.append((-score, i is not None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_table(spark, sf, small):
    docs = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute(docs, items)
    assert got(queries.op12_search(spark, sf)) == want and len(want) > 100


ITEMS = [(1, "one two THREE four"), (2, None), (3, ""), (4, "?? --"), (5, "to to to line"), (6, "日本語 äöü w7x1"),
         (7, "unheard-of"), (8, "hello world hello"), (9, "l1y1 l2y2 l3y3 one")]


@pytest.mark.parametrize("k, query_bytes", [(20, 1 << 20), (1, 1 << 20), (3, 20)])
def test_odd_rows(spark, odd, k, query_bytes):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    found = search.search(odd, items, k=k, query_bytes=query_bytes)
    assert got(found) == brute([(r[0], r[1]) for r in odd_rows()], ITEMS, k)


def test_empty(spark, odd, none):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert got(search.search(none, items)) == []
    assert got(search.search(odd, items.limit(0))) == []


@pytest.mark.parametrize("accumulators", [0, 40, 400, 1 << 30])
@pytest.mark.parametrize("window", [8, 64])
def test_any_split_of_short_and_long_lists(monkeypatch, accumulators, window):
    """All term-at-a-time, all document-at-a-time, and both; ties at the k-th score."""
    monkeypatch.setattr(search, "WINDOW", window)
    rng = np.random.Generator(np.random.PCG64(7))
    weight = np.array([900, 700, 500, 300, 20, 5, 0, 1200])
    best = [search.Best(5) for _ in range(40)]
    wanted = [sorted(Counter(rng.integers(0, 8, size=rng.integers(1, 6)).tolist()).items()) for _ in best]
    score = [{} for _ in best]
    n_docs, n_terms, base = 600, 6000, 0
    for _ in range(3):
        n = rng.integers(1, 20, size=200)
        rows = [sorted(rng.choice(8, size=rng.integers(0, 5), replace=False, p=[.01, .02, .02, .05, .3, .3, .29, .01]))
                for _ in n]
        term = np.array([t for r in rows for t in r], dtype=np.int64)
        tf = rng.integers(1, 3, size=len(term))
        ends = np.r_[0, np.cumsum([len(r) for r in rows])]
        block = search.Block(n, ends, term, tf, weight, n_docs, n_terms)
        for q, top, all_scores in zip(wanted, best, score):
            top.ids = list(range(base, base + 200))
            search.search_block(block, q, top, accumulators)
            for d in range(200):
                m = 75 + 25 * int(n[d]) * n_docs // n_terms
                s = sum(times * int(weight[t]) * (10 ** 9 * int(f) // (1000 * int(f) + 12 * m)) for t, times in q
                        for u, f in zip(term[ends[d]:ends[d + 1]], tf[ends[d]:ends[d + 1]]) if u == t)
                if s:
                    all_scores[base + d] = s
        base += 200
    for top, all_scores in zip(best, score):
        want = sorted(((s, -d) for d, s in all_scores.items()), reverse=True)[:5]
        assert sorted(((e[0], e[2]) for e in top.heap), reverse=True) == want
