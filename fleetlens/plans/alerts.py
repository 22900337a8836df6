"""Alert mart E3: M-12, T-13 … T-16, A-03, A-04, W-04.

All component alerts live in one long frame keyed by ``component_id``
(instead of eleven tables unioned at read time); component metadata is a
bounded 11-row frame joined by broadcast.  Run time is passed in, so a rerun
of the same batch is repeatable (F-06).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.scalars import alert_category, alert_severity, batch_id, trace_id
from ..operators.joins import ref_join
from ..operators.sets import select_or_null, union_by_name
from ..operators.windows import latest_by
from ..sources.reference import alert_components


def run_ts_col(run_ts: str):
    return F.lit(run_ts).cast("timestamp_ntz")


def alerts_from_predictions(predictions: DataFrame, run_ts: str, batch: str | None = None) -> DataFrame:
    """M-12: rows with predicted_anomaly = 1, stamped with alert_day and batch_id."""
    return (predictions.withColumn("predicted_anomaly", F.col("predicted_anomaly").cast("int"))
            .filter(F.col("predicted_anomaly") == 1)
            .withColumn("alert_day", F.to_date(run_ts_col(run_ts)))
            .withColumn("batch_id", F.lit(batch) if batch else batch_id(run_ts)))


def unify_alerts(alerts_long: DataFrame, spark, run_ts: str, passthrough=()) -> DataFrame:
    """T-13: the unified alert view.

    ``alerts_long`` needs component_id plus any of timestamp, aircraft_id,
    predicted_anomaly, alert_day, batch_id (missing ones become typed NULLs,
    P-07)."""
    required = [("component_id", S.S)] + [(n, t) for n, t in S.UNIFIED_ALERT_REQUIRED]
    base = select_or_null(alerts_long, [(n, T_ntz(t)) for n, t in required], cast_present=False,
                          keep=list(passthrough))
    cfg = alert_components(spark)
    u = ref_join(base, cfg, on="component_id", how="inner")
    return u.select(
        "timestamp", "aircraft_id", "predicted_anomaly", "alert_day", "batch_id",
        "component_name", "component_id", "component_description",
        F.concat(F.lower("component_id"), F.lit("_alerts")).alias("alert_source"),
        F.concat(F.lit("component_predictions/"), F.col("component_id")).alias("inference_source"),
        trace_id("aircraft_id", "component_id", "timestamp").alias("inference_trace_id"),
        run_ts_col(run_ts).alias("processed_at"),
        F.to_date("timestamp").alias("alert_date"),
        F.hour("timestamp").alias("alert_hour"),
        alert_severity().alias("alert_severity"),
        alert_category().alias("alert_category"), *passthrough)


def T_ntz(t):
    from pyspark.sql import types as T
    return T.TimestampNTZType() if isinstance(t, T.TimestampType) else t


def unify_alert_tables(spark, tables: dict, run_ts: str) -> DataFrame:
    """T-13 over separate per-component frames (S-16 form): ``{component_id: df}``;
    absent components are simply not in the dict."""
    parts = [df.withColumn("component_id", F.lit(cid)) for cid, df in tables.items()]
    return unify_alerts(union_by_name(parts), spark, run_ts)


TRACE_KEYS = ["component_id", "aircraft_id", "timestamp"]


def traceability(unified: DataFrame, predictions_long: DataFrame, run_ts: str) -> DataFrame:
    """T-14 (J-07): each alert with the inference row it came from.

    The inference side is reduced to one row per (component, aircraft,
    timestamp) – greatest by its remaining columns – plus the number of rows
    sharing that key (``inf_matches``), so the join is many-to-one and never
    multiplies duplicates.  Inference columns are prefixed ``inf_`` (K11)."""
    rest = [c for c in predictions_long.columns if c not in TRACE_KEYS]
    inf = (predictions_long.groupBy(*TRACE_KEYS)
           .agg(F.max_by(F.struct(*rest), F.struct(*rest)).alias("__i"), F.count(F.lit(1)).alias("inf_matches"))
           .select(*TRACE_KEYS, *[F.col(f"__i.{c}").alias(f"inf_{c}") for c in rest], "inf_matches"))
    return (unified.join(inf, TRACE_KEYS, "left")
            .withColumn("inference_table", F.col("inference_source"))
            .withColumn("trace_created_at", run_ts_col(run_ts)))


def traceability_from_predictions(predictions_long: DataFrame, spark, run_ts: str,
                                  batch: str | None = None, sought=None) -> DataFrame:
    """T-14 from one evaluation of one long prediction frame: a key's inference
    row, its matches and its number of alerts come from the same aggregation
    (partial before the only shuffle, nothing is buffered per key).  The alerts
    of a key differ in no column of the mart, so a key's row is repeated as
    often as it has alerts.  Keys are compared as in :func:`traceability`: with
    a NULL in the key there is no inference.

    With ``sought``, a condition on the key and ``alert_category``, the result
    is :func:`lookup` of it.  A key has one trace id, so predictions dealt out
    by the id are in place for the aggregation and for the lookup: one shuffle
    of the predictions as they come, one sort, and only the rows found are
    repeated and given the columns of the mart."""
    rest = [c for c in predictions_long.columns if c not in TRACE_KEYS]
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in TRACE_KEYS])
    raised = F.col("predicted_anomaly").cast("int") == 1
    # the aggregation sorts (it holds strings): by a hash first, so that nearly every comparison is one of two longs
    by, rows, first = TRACE_KEYS, predictions_long, []
    if sought is not None:
        tid = trace_id("aircraft_id", "component_id", "timestamp")
        by = first = ["inference_trace_id"]
        rows = predictions_long.repartition(tid).withColumn("inference_trace_id", tid)
    keys = rows.groupBy(F.xxhash64(*by).alias("__h"), *first, *TRACE_KEYS).agg(
        F.max(F.struct(*rest)).alias("__i"), F.count(F.lit(1)).alias("inf_matches"),
        F.count_if(raised).cast("int").alias("__alerts")).filter("__alerts > 0")
    if sought is not None:
        known = F.broadcast(alert_components(spark).select("component_id"))     # others are not in the mart
        keys = lookup(keys.join(known, "component_id", "left_semi").withColumn("alert_category", alert_category()),
                      sought, by=["__h", "inference_trace_id"]).drop("inference_trace_id", "alert_category")
    alerts = (keys.drop("__h")
              .withColumn("__i", F.when(whole, F.col("__i")))
              .withColumn("inf_matches", F.when(whole, F.col("inf_matches")))
              .withColumn("__alerts", F.explode(F.array_repeat(F.lit(1), F.col("__alerts"))))
              .withColumnRenamed("__alerts", "predicted_anomaly"))
    u = unify_alerts(alerts_from_predictions(alerts, run_ts, batch), spark, run_ts, passthrough=["__i", "inf_matches"])
    return (u.select(*[c for c in u.columns if c not in ("__i", "inf_matches")],
                     *[F.col(f"__i.{c}").alias(f"inf_{c}") for c in rest], "inf_matches")
            .withColumn("inference_table", F.col("inference_source"))
            .withColumn("trace_created_at", run_ts_col(run_ts)))


def lookup(trace: DataFrame, condition, by=None) -> DataFrame:
    """J-11: all rows of the trace that share a trace id with a row for which
    ``condition`` holds (an id is not unique, so this is no filter on it).
    ``by``: columns that hold a hash of the id and the id, if there are."""
    by = by or [F.xxhash64("inference_trace_id"), "inference_trace_id"]      # hash first: cheap to sort by
    hit = F.max(F.coalesce(condition, F.lit(False))).over(Window.partitionBy(*by))
    return trace.withColumn("__hit", hit).filter("__hit").drop("__hit")


def alert_summary(unified: DataFrame, approx: bool = False) -> DataFrame:
    """A-03: per component, category, severity and day: alerts and distinct aircraft."""
    dims = ["component_name", "component_id", "alert_category", "alert_severity", "alert_date"]
    if approx:
        return unified.groupBy(*dims).agg(F.count(F.lit(1)).alias("alert_count"),
                                          F.approx_count_distinct("aircraft_id").alias("affected_aircraft_count"))
    # one row per aircraft first, dealt out to a set number of tasks: those rows shrink so well in a shuffle that
    # partitions merged by their size there fill a task's memory
    width = int(unified.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = unified.select(*dims, "aircraft_id").repartition(width, *dims, "aircraft_id")
    per = rows.groupBy(*dims, "aircraft_id").agg(F.count(F.lit(1)).alias("__n"))
    return per.groupBy(*dims).agg(F.sum("__n").alias("alert_count"),
                                  F.count("aircraft_id").alias("affected_aircraft_count"))


def alert_trends(unified: DataFrame) -> DataFrame:
    """A-04."""
    return unified.groupBy("alert_date", "component_id", "alert_category", "alert_severity").agg(
        F.count(F.lit(1)).alias("daily_alert_count"),
        F.count_distinct("aircraft_id").alias("daily_affected_aircraft"),
        F.avg("predicted_anomaly").alias("avg_anomaly_score"))


def dashboard_view(unified: DataFrame) -> DataFrame:
    """W-04: latest alert per (aircraft, component)."""
    return latest_by(unified, ["aircraft_id", "component_id"], ["timestamp"])


SQL_VIEW_COLS = ["timestamp", "aircraft_id", "predicted_anomaly", "alert_day", "alert_date", "alert_hour",
                 "alert_severity", "alert_category", "component_name", "component_id", "component_description",
                 "alert_source", "inference_source", "inference_trace_id", "batch_id", "processed_at"]


def sql_view(unified: DataFrame) -> DataFrame:
    """T-16 unified_alerts_sql_view."""
    return unified.select(*SQL_VIEW_COLS)


def drilldown(trace: DataFrame) -> DataFrame:
    """T-16 alert_to_inference_drilldown (+ alert_date, K22)."""
    return trace.select("aircraft_id", "timestamp", "component_name", "component_id", "inference_table",
                        "predicted_anomaly", "alert_severity", "alert_category", "inference_trace_id",
                        "trace_created_at", "alert_date")
