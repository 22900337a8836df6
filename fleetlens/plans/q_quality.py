"""Catalog entries of the data-quality operators on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..operators import quality as Q
from ..operators.sets import select_or_null
from ..operators.windows import dedupe
from ..sources import driver as D
from . import oracle as O
from .catalog import query
from .q_sensor import _chain

LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _exp_sql():
    parts = [f"SELECT '{n}' AS expectation, count(*) AS total_rows, "
             f"count(*) FILTER (WHERE NOT COALESCE({e}, FALSE)) AS failed_rows FROM sensor"
             for n, e in S.EXPECTATIONS.items()]
    return O.with_(O.SENSOR) + "\nUNION ALL\n".join(parts)


@query("expectation_report", _exp_sql())
def expectation_report(spark, sf):
    """P-02: warn-only expectations as a table (rows are not dropped)."""
    return Q.expectation_report(D.sensor_readings(spark, sf))


@query("null_profile", "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls" for c in LINEITEM_COLS) + " FROM lineitem")
def null_profile(spark, sf):
    """P-12: per-column NULL counts in one pass."""
    return Q.null_profile(D.table(spark, sf, "lineitem"))


@query("range_violations", O.with_(O.SENSOR) + """
SELECT count(*) FILTER (WHERE COALESCE(engine_temp > 1000 OR engine_temp < 0 OR vibration < 0, FALSE))
       AS out_of_range FROM sensor""")
def range_violations(spark, sf):
    """P-11."""
    return Q.range_violations(D.sensor_readings(spark, sf))


@query("range_violations_custom", """
SELECT count(*) FILTER (WHERE COALESCE(l_discount > 0.08 OR l_quantity < 2, FALSE)) AS out_of_range
FROM lineitem""")
def range_violations_custom(spark, sf):
    """P-11 with a caller-supplied predicate."""
    return Q.range_violations(D.table(spark, sf, "lineitem"),
                              (F.col("l_discount") > 0.08) | (F.col("l_quantity") < 2))


@query("duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS dup_count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def duplicate_keys(spark, sf):
    """P-13 listing."""
    return Q.duplicate_keys(D.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("duplicate_key_count", """
SELECT count(*) AS duplicate_pk FROM (
  SELECT o_custkey, o_orderdate FROM orders GROUP BY ALL HAVING count(*) > 1) t""")
def duplicate_key_count(spark, sf):
    """P-13 summary."""
    return Q.duplicate_key_count(D.table(spark, sf, "orders"), ["o_custkey", "o_orderdate"])


_REST = [c for c in LINEITEM_COLS if c not in ("l_orderkey", "l_linenumber")]


@query("dedupe_latest", "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, "
       "l_linenumber ORDER BY l_shipdate DESC NULLS LAST, "
       + ", ".join(f"{c} DESC NULLS LAST" for c in _REST) + ") AS rn FROM lineitem) t WHERE rn = 1")
def dedupe_latest(spark, sf):
    """W-02: one row per (orderkey, linenumber), latest ship date, total tie-break."""
    return dedupe(D.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("null_key_count", """
SELECT count(*) FILTER (WHERE o_orderkey IS NULL OR o_custkey IS NULL) AS null_keys FROM orders""")
def null_key_count(spark, sf):
    """P-14."""
    return Q.null_key_count(D.table(spark, sf, "orders"), ["o_orderkey", "o_custkey"])


_COUNT_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "labels"]


@query("row_counts", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _COUNT_TABLES))
def row_counts(spark, sf):
    """P-15: row counts of many tables in one job."""
    return Q.row_counts({t: D.table(spark, sf, t) for t in _COUNT_TABLES})


@query("not_null_check", "SELECT * FROM orders")
def not_null_check(spark, sf):
    """P-16: CHECK (o_orderkey, o_custkey NOT NULL); rows pass, a violation fails the job."""
    return Q.validate_not_null(D.table(spark, sf, "orders"), ["o_orderkey", "o_custkey"], "orders_pk")


@query("drop_null_keys", O.with_(O.SENSOR) + """
SELECT * FROM sensor WHERE aircraft_id IS NOT NULL AND "timestamp" IS NOT NULL""")
def drop_null_keys(spark, sf):
    """P-09."""
    return Q.drop_null_keys(D.sensor_readings(spark, sf), ["aircraft_id", "timestamp"])


@query("schema_align", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, CAST(NULL AS DOUBLE) AS anomaly_score,
       'batch_001' AS batch_id, DATE '2024-02-01' AS alert_day
FROM orders""")
def schema_align(spark, sf):
    """P-07 / O-05: project onto a target schema; missing columns become typed
    NULLs or defaults (alert_day, batch_id)."""
    target = [("o_orderkey", T.LongType()), ("o_totalprice", T.DoubleType()), ("o_orderdate", T.DateType()),
              ("anomaly_score", T.DoubleType()), ("batch_id", T.StringType(), "batch_001"),
              ("alert_day", T.DateType(), "2024-02-01")]
    return select_or_null(D.table(spark, sf, "orders"), target)


def _sanity_sql():
    sensor_cols = ["timestamp", "aircraft_id", "engine_temp", "fuel_efficiency", "vibration"]
    twins = {k: f"{k}_raw" for k in O.COMP_KEYS}
    sel = [f"(SELECT count(*) FILTER (WHERE \"{c}\" IS NULL) FROM feat) AS sensor_{c}_nulls" for c in sensor_cols]
    sel += ["(SELECT count(*) FILTER (WHERE COALESCE(engine_temp > 1000 OR engine_temp < 0 OR vibration < 0, FALSE))"
            " FROM feat) AS sensor_out_of_range",
            "(SELECT count(*) FROM feat) AS sensor_row_count",
            "(SELECT count(*) FROM (SELECT aircraft_id, \"timestamp\" FROM feat GROUP BY ALL HAVING count(*) > 1) t)"
            " AS sensor_duplicate_pk"]
    for prefix, tname in twins.items():
        spec = S.COMPONENTS[prefix]
        for c, _ in spec.raw_cols:
            sel.append(f"(SELECT count(*) FILTER (WHERE {c} IS NULL) FROM {tname}) AS {prefix}_{c}_nulls")
        sel.append(f"(SELECT count(*) FROM {tname}) AS {prefix}_row_count")
    for st in ("CRITICAL", "WARNING"):
        sel.append(f"(SELECT count(*) FROM comp_alerts WHERE health_status = '{st}') AS component_alerts_{st.lower()}")
    sel.append(f"TIMESTAMP '{O.RUN_TS}' AS check_time")
    ctes = [*O.E1, O.enriched("JOIN"), O.FEATURES, *O.comp_ctes(O.COMP_KEYS), O.comp_view(), O.COMP_ALERTS]
    return O.with_(*ctes) + "SELECT " + ",\n  ".join(sel)


@query("sanity_row", _sanity_sql())
def sanity_row(spark, sf):
    """P-17: one wide row of null counts, row counts, range violations,
    duplicate PKs and component alert counts per status."""
    feats = _chain(spark, sf)["features"]
    twins = {k: D.COMPONENT_SOURCES[k](spark, sf) for k in O.COMP_KEYS}
    return Q.sanity_row(feats, twins, specs=S.COMPONENTS, check_time=O.RUN_TS)

