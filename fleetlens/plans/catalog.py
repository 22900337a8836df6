"""Registry of named queries over the driver tables and their DuckDB oracles.

Each entry is ``name -> (spark_fn(spark, sf_dir) -> DataFrame, oracle_sql | None)``.
Entries without SQL are checked by row count only (and by brute-force tests
in ``tests/``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _load():
    # importing the modules registers their queries
    from . import q_sensor, q_quality, q_components, q_alerts, q_dash, q_ops, q_ingest  # noqa: F401


def queries() -> dict:
    _load()
    return {k: v[0] for k, v in REGISTRY.items()}


def spark_round_sql(sql: str) -> str:
    """Rewrite ``round(x, d)`` in oracle text to round like Spark does.

    Spark rounds a double HALF_UP on its shortest decimal form; DuckDB rounds
    the binary value, so ties such as 287.7633625 can differ in the last
    digit.  Going through DECIMAL(38,12) first reproduces Spark's result."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 1, j + 6, None
        while depth:
            c = sql[k]
            if c == "(":
                depth += 1
            elif c == ")":
                depth -= 1
            elif c == "," and depth == 1:
                comma = k
            k += 1
        if comma is None:                       # round(x): leave as is
            out.append(sql[i:j + 6] + spark_round_sql(sql[j + 6:k - 1]) + ")")
            i = k
            continue
        inner = spark_round_sql(sql[j + 6:comma])
        digits = sql[comma + 1:k - 1].strip()
        out.append(sql[i:j] + f"CAST(round(CAST({inner} AS DECIMAL(38,12)), {digits}) AS DOUBLE)")
        i = k


def oracle_sql() -> dict:
    _load()
    return {k: spark_round_sql(v[1]) for k, v in REGISTRY.items() if v[1] is not None}
