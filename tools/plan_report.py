"""Markdown table of physical-plan shape per headline query.

usage: python tools/plan_report.py [sf_dir]
Counts shuffles (hash / range / single-partition exchanges), broadcasts,
sort-merge vs broadcast-hash joins, window operators and Parquet scans in the
planned (pre-AQE) physical plan.
"""

from __future__ import annotations

import io
import os
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from fleetlens.plans.catalog import queries  # noqa: E402
from fleetlens.session import local_session  # noqa: E402


def shape(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    p = buf.getvalue()
    return {
        "shuffles": p.count("Exchange hashpartitioning") + p.count("Exchange rangepartitioning")
        + p.count("Exchange SinglePartition") + p.count("Exchange RoundRobin"),
        "broadcasts": p.count("BroadcastExchange"),
        "smj": p.count("SortMergeJoin"),
        "bhj": p.count("BroadcastHashJoin"),
        "windows": p.count("Window ["),
        "scans": p.count("FileScan parquet"),
        "python": p.count("ArrowEvalPython") + p.count("BatchEvalPython") + p.count("FlatMapGroupsInPandas"),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    cols = ["shuffles", "broadcasts", "smj", "bhj", "windows", "scans", "python"]
    print("| query | " + " | ".join(cols) + " |")
    print("| --- |" + " --- |" * len(cols))
    for name in HEADLINE:
        s = shape(queries()[name](spark, sf))
        print(f"| `{name}` | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main()
