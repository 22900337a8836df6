"""Catalog entries of the alert mart (E3) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from . import alerts as A
from . import components as C
from . import oracle as O
from .catalog import query
from .q_components import view as comp_view
from .q_sensor import _chain

RUN_TS = O.RUN_TS


def predictions_long(spark, sf):
    """Aircraft-level rule predictions ('AC') + component predictions, one long frame."""
    p = _chain(spark, sf)["predictions"]
    ac = p.select(F.lit("AC").alias("component_id"), "aircraft_id", "timestamp",
                  F.lit(None).cast("string").alias("source_component_id"),
                  F.when(F.col("predicted_anomaly") == 1, S.RISK_HIGH).otherwise(S.RISK_NORMAL)
                  .alias("health_status"),
                  F.col("predicted_anomaly").cast("int").alias("predicted_anomaly"))
    return ac.unionByName(C.component_predictions(comp_view(spark, sf)))


def unified(spark, sf):
    alerts = A.alerts_from_predictions(predictions_long(spark, sf), RUN_TS)
    return A.unify_alerts(alerts, spark, RUN_TS)


def trace(spark, sf, sought=None):
    return A.traceability_from_predictions(predictions_long(spark, sf), spark, RUN_TS, sought=sought)


MART = O.with_(*O.mart_ctes())


@query("unified_alerts", MART + "SELECT * FROM unified")
def unified_alerts(spark, sf):
    """T-13 (S-16, P-07, F-05, U-02, F-02, F-04, R-12, R-13)."""
    return unified(spark, sf)


@query("traceability", O.with_(*O.mart_ctes(), O.TRACE) + "SELECT * FROM trace")
def traceability(spark, sf):
    """T-14 (J-07): alert ⟕ its inference row."""
    return trace(spark, sf)


@query("drilldown", O.with_(*O.mart_ctes(), O.TRACE) + """
SELECT aircraft_id, "timestamp", component_name, component_id, inference_table, predicted_anomaly,
       alert_severity, alert_category, inference_trace_id, trace_created_at, alert_date FROM trace""")
def drilldown(spark, sf):
    """T-16 alert_to_inference_drilldown."""
    return A.drilldown(trace(spark, sf))


@query("alerts_sql_view", MART + f"SELECT {', '.join(chr(34) + c + chr(34) for c in A.SQL_VIEW_COLS)} FROM unified")
def alerts_sql_view(spark, sf):
    """T-16 unified_alerts_sql_view."""
    return A.sql_view(unified(spark, sf))


@query("alert_summary", MART + """
SELECT component_name, component_id, alert_category, alert_severity, alert_date,
       count(*) AS alert_count, count(DISTINCT aircraft_id) AS affected_aircraft_count
FROM unified GROUP BY ALL""")
def alert_summary(spark, sf):
    """A-03."""
    return A.alert_summary(unified(spark, sf))


@query("alert_trends", MART + """
SELECT alert_date, component_id, alert_category, alert_severity,
       count(*) AS daily_alert_count, count(DISTINCT aircraft_id) AS daily_affected_aircraft,
       round(avg(predicted_anomaly), 6) AS avg_anomaly_score
FROM unified GROUP BY ALL""")
def alert_trends(spark, sf):
    """A-04."""
    t = A.alert_trends(unified(spark, sf))
    return t.withColumn("avg_anomaly_score", F.round("avg_anomaly_score", 6))


@query("latest_alert", MART + """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY aircraft_id, component_id
                               ORDER BY "timestamp" DESC, predicted_anomaly DESC, alert_day DESC, batch_id DESC,
                                        component_name DESC, component_description DESC, alert_source DESC,
                                        inference_source DESC, inference_trace_id DESC) AS rn
  FROM unified) t WHERE rn = 1""")
def latest_alert(spark, sf):
    """W-04 alert_dashboard_view: latest alert per (aircraft, component)."""
    return A.dashboard_view(unified(spark, sf))


@query("severity_category", MART + """
SELECT component_id, alert_severity, alert_category, count(*) AS alerts FROM unified GROUP BY ALL""")
def severity_category(spark, sf):
    """R-12 / R-13 outcome per component."""
    return unified(spark, sf).groupBy("component_id", "alert_severity", "alert_category").agg(
        F.count(F.lit(1)).alias("alerts"))


@query("trace_id", MART + """
SELECT inference_trace_id, count(*) AS alerts FROM unified GROUP BY inference_trace_id""")
def trace_id(spark, sf):
    """F-05: trace ids and how many alerts share each (ids are not unique)."""
    return unified(spark, sf).groupBy("inference_trace_id").agg(F.count(F.lit(1)).alias("alerts"))
