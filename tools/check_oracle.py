"""Run catalog queries on Spark and their SQL oracles on DuckDB, compare.

usage: python tools/check_oracle.py [sf_dir] [name ...]
Prints one line per query: OK / MISMATCH (+ first differences) / ROWS-ONLY.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from fleetlens.plans.catalog import oracle_sql, queries  # noqa: E402
from fleetlens.session import local_session  # noqa: E402
from fleetlens.sources.driver import TABLES  # noqa: E402


STRICT = bool(os.environ.get("STRICT"))      # compare doubles bit for bit


def norm(v, digits=6):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v if STRICT else round(v, digits)
    if hasattr(v, "as_tuple") and not isinstance(v, (int, str)):   # Decimal
        return round(float(v), digits)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, bool):
        return int(v)
    return v


def key(row):
    return tuple((0, "") if x is None else (1, str(type(x).__name__), x) if not isinstance(x, (int, float))
                 else (1, "num", float(x)) for x in row)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=key)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 and "/" in sys.argv[1] else "/root/testdata/sf0.01"
    names = [a for a in sys.argv[1:] if "/" not in a]
    spark = local_session(8)
    if os.environ.get("SESSION_TZ"):              # robustness: non-UTC session time zone
        spark.conf.set("spark.sql.session.timeZone", os.environ["SESSION_TZ"])
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SPARK-ERROR {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"{name:28s} ROWS-ONLY rows={len(srows)} ({ts:.1f}s)")
            continue
        try:
            res = con.execute(sqls[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SQL-ERROR {str(e)[:400]}")
            bad += 1
            continue
        sc, sr = rows_of(scols, srows)
        dc, dr = rows_of(dcols, drows)
        if sc != dc:
            print(f"{name:28s} COLUMNS spark={sc} duck={dc}")
            bad += 1
            continue
        if sr != dr:
            bad += 1
            diff = [(a, b) for a, b in zip(sr, dr) if a != b][:2]
            print(f"{name:28s} MISMATCH rows spark={len(sr)} duck={len(dr)} first={diff}")
            continue
        print(f"{name:28s} OK rows={len(sr)} ({ts:.1f}s)")
    print(f"FAILED {bad}")


if __name__ == "__main__":
    main()
