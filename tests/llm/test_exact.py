from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fleetlens.llm import exact

from .conftest import lower, odd_rows, rows, sha


def brute(data):
    groups = defaultdict(list)
    for i, t in data:
        groups[lower(t)].append(i)
    out, used = [], set()
    for i, t in data:
        norm = lower(t)
        known = [x for x in groups[norm] if x is not None]
        keep = max(known) if known else None
        kept = i == keep and norm not in used
        if kept:
            used.add(norm)
        out.append((i, keep, len(groups[norm]), kept, sha(norm)))
    return sorted(out, key=repr)


COLS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@pytest.mark.parametrize("bits", [64, 1 << 12, exact.BITS])
def test_odd_rows_any_filter_size(odd, bits):
    got = rows(exact.exact_dedup(odd, bits=bits), *COLS)
    assert got == brute([(r[0], r[1]) for r in odd_rows()])


def test_table(small):
    got = rows(exact.exact_dedup(small), *COLS)
    assert got == brute([(r.doc_id, r.text) for r in small.collect()])


def test_empty(none):
    assert exact.exact_dedup(none).count() == 0


def test_bad_bits(odd):
    with pytest.raises(ValueError):
        exact.exact_dedup(odd, bits=100)


def test_unique_rows_do_not_shuffle(small):
    plan = exact.exact_dedup(small)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Union" in plan


def test_clashing_and_dotted_names(odd):
    df = odd
    for c in ("tied", "a.b", "p0", "m1", "word", "mask", "top", "__tied", "gk"):
        df = df.withColumn(c, F.lit(1))
    out = exact.exact_dedup(df, bits=64)
    assert set(df.columns) <= set(out.columns)
    assert rows(out, *COLS) == brute([(r[0], r[1]) for r in odd_rows()])
