from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fleetlens.llm import lines, queries

from .conftest import lower, odd_rows, rows, sha

BLANKS = " \t\n\x0b\f\r"


def brute(data, min_docs=2, min_chars=10):
    """data: (doc_id, text) → (doc_id, n_lines, n_dropped, kept text)."""
    held = defaultdict(set)
    for i, t in data:
        for line in (t or "").split("\n"):
            held[lower(line.strip(BLANKS))].add(i)
    first = {k: min(v, key=lambda i: (i is None, i or 0)) for k, v in held.items()
             if len(v) >= min_docs and len(k) >= min_chars}
    out = []
    for i, t in data:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if first.get(lower(x.strip(BLANKS)), i) == i]
        out.append((i, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def planted():
    a, b = "A common line of text", "Another line of some length"
    return [(1, f"{a}\nown words here 1\n{a}"), (2, f"  {a.upper()}\t\nown words here 2\n\n"), (3, f"{a}\r\n{b}"),
            (3, f"{b}\nshort"), (4, b), (4, b), (4, b), (None, f"{a}\n{b}"), (None, None), (5, "short\nshort\n"),
            (6, "\n\n\n"), (7, f"ä{a}\n{a} \n{a}."), (8, "\n".join([a, "x", b] * 400)), (9, "ten chars!"),
            (10, "TEN CHARS!\nnine char"), (11, "nine char"), (12, "日本語日本語日本語日"), (13, "日本語日本語日本語日 ")]


COLS = ("doc_id", "n_lines", "n_dropped", "kept_text")


@pytest.mark.parametrize("min_docs", [1, 2, 3])
def test_planted(spark, min_docs):
    df = spark.createDataFrame(planted(), "doc_id long, text string").repartition(4)
    assert rows(lines.drop_repeated_lines(df, min_docs=min_docs), *COLS) == brute(planted(), min_docs)


def test_odd_rows_and_clashing_names(odd):
    df = odd
    for c in ("n_lines", "n_dropped", "kept_text", "id", "pos", "hash", "found", "first", "dropped", "__row", "__of",
              "__dropped", "a.b"):
        df = df.withColumn(c, F.lit(1))
    out = lines.drop_repeated_lines(df)
    assert rows(out, *COLS) == brute([(r[0], r[1]) for r in odd_rows()])
    assert set(df.columns) <= set(out.columns)


def test_query(spark, sf, small):
    data = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    want = sorted(((i, n, d, sha(t)) for i, n, d, t in brute(data)), key=repr)
    assert sorted((tuple(r) for r in queries.op13_lines(spark, sf).collect()), key=repr) == want


def test_empty_and_bad(none, odd):
    assert lines.drop_repeated_lines(none).count() == 0
    with pytest.raises(ValueError):
        lines.drop_repeated_lines(odd, min_docs=0)


def test_no_python(spark, sf):
    plan = queries.op13_lines(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
