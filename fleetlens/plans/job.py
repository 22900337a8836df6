"""End-to-end batch refresh: raw frames → gold tables on shared storage.

Each stage is written once and the next stage reads the written table, so a
lost executor only recomputes the current stage and lineage never grows
across the run.  Partitioning follows the query patterns at fleet scale: by month (and
component), never by aircraft id (that would create one small file set per
aircraft) and not by day (years of history would create tens of thousands of
small partitions; date filters still prune by month and by Parquet row-group
statistics).  ``rebalance`` sizes output files evenly (AQE).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..ml import component_models as CM
from ..operators.skew import RangeParts
from . import alerts as A
from . import components as C
from . import maps, sensor

GOLD_PARTITIONS = {
    "quarantine": ["month"],
    "sensor_features": ["month"],
    "prediction_results": ["month"],
    "component_health": ["component_type", "month"],
    "component_alerts": ["month"],
    "unified_alerts": ["component_id", "month"],
    "inference_traceability": ["component_id", "month"],
    "alert_summary": ["month"],
    "alert_trends": ["month"],
}
MONTH_SOURCE = {"sensor_features": "timestamp", "prediction_results": "timestamp",
                "component_health": "event_timestamp", "component_alerts": "alert_timestamp",
                "unified_alerts": "alert_date", "inference_traceability": "alert_date",
                "alert_summary": "alert_date", "alert_trends": "alert_date", "quarantine": "timestamp"}
for _k in S.COMPONENTS:
    GOLD_PARTITIONS[f"features_{_k}"], MONTH_SOURCE[f"features_{_k}"] = ["month"], "event_timestamp"


def _write(df: DataFrame, root: str, name: str) -> str:
    path = f"{root.rstrip('/')}/{name}"
    parts = GOLD_PARTITIONS.get(name)
    if parts:
        df = df.withColumn("month", F.date_format(MONTH_SOURCE[name], "yyyy-MM"))
    out = df.hint("rebalance", *parts) if parts else df.hint("rebalance")
    w = out.write.mode("overwrite")
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)
    return path


def refresh(spark: SparkSession, readings: DataFrame, maintenance: DataFrame, models: DataFrame,
            component_frames: dict, locations: DataFrame, root: str, run_ts: str, skew_bucket=None,
            models_root: str | None = None) -> dict:
    """Run E1 → E2 → E3 and the maps; returns {table: path}.

    Histories are split by ranges of (aircraft, time), so an aircraft with a
    large share of all rows is spread over many tasks; ``skew_bucket`` takes
    another cut (``operators/skew.py``).  For a few new files take
    ``incremental.IncrementalGold``.

    With ``models_root`` the alerts of every component whose model there has
    the alias ``live`` come from that model's predictions (M-12); those of the
    others, and all without it, from the health rule."""
    paths = {}
    read = spark.read.parquet

    # E1: sensor chain
    bucket = skew_bucket or RangeParts()
    chain = sensor.run(readings, maintenance, models, skew_bucket=bucket)
    paths["quarantine"] = _write(chain["quarantined"], root, "quarantine")
    paths["sensor_features"] = _write(chain["features"], root, "sensor_features")
    preds = sensor.prediction_results(read(paths["sensor_features"]).drop("month"))
    paths["prediction_results"] = _write(preds, root, "prediction_results")
    preds = read(paths["prediction_results"]).drop("month")
    paths["engine_view"] = _write(sensor.engine_view(preds), root, "engine_view")

    # E2: component twins
    health = {k: C.health(df, S.COMPONENTS[k]) for k, df in component_frames.items()}
    paths["component_health"] = _write(C.component_view(health), root, "component_health")
    view = read(paths["component_health"]).drop("month")
    for k, df in health.items():
        paths[f"features_{k}"] = _write(C.features(df, S.COMPONENTS[k], skew_bucket=bucket), root, f"features_{k}")
    paths["component_alerts"] = _write(C.component_alerts(view), root, "component_alerts")

    # E3: alert mart from one long prediction table
    ac = preds.select(F.lit("AC").alias("component_id"), "aircraft_id", "timestamp",
                      F.lit(None).cast("string").alias("source_component_id"),
                      F.when(F.col("predicted_anomaly") == 1, S.RISK_HIGH).otherwise(S.RISK_NORMAL)
                      .alias("health_status"), F.col("predicted_anomaly").cast("int").alias("predicted_anomaly"))
    long_preds = ac.unionByName(_component_predictions(spark, view, component_frames, models_root))
    trace = A.traceability_from_predictions(long_preds, spark, run_ts)
    paths["inference_traceability"] = _write(trace, root, "inference_traceability")
    trace = read(paths["inference_traceability"]).drop("month")
    unified = trace.select(*[c for c in trace.columns if not c.startswith("inf_")
                             and c not in ("inference_table", "trace_created_at")])
    paths["unified_alerts"] = _write(unified, root, "unified_alerts")
    unified = read(paths["unified_alerts"]).drop("month")
    paths["alert_summary"] = _write(A.alert_summary(unified), root, "alert_summary")
    paths["alert_trends"] = _write(A.alert_trends(unified), root, "alert_trends")
    paths["alert_dashboard_view"] = _write(A.dashboard_view(unified), root, "alert_dashboard_view")

    # maps
    engine = read(paths["engine_view"])
    ac_alerts = unified.filter(F.col("component_id") == "AC")
    paths["aircraft_status_map"] = _write(maps.status_map(locations, engine, ac_alerts), root, "aircraft_status_map")
    paths["component_status_map"] = _write(
        maps.component_status_map(locations, read(paths["component_alerts"]).drop("month")), root,
        "component_status_map")
    return paths


def _component_predictions(spark: SparkSession, view: DataFrame, twins, models_root: str | None) -> DataFrame:
    """Long predictions of all components: by live models where there are any."""
    live = [k for k in CM.live_twins(spark, models_root) if k in twins] if models_root else []
    if not live:
        return C.component_predictions(view)
    kind = F.col("component_type")
    frames = {k: view.filter(kind == C.COMP_TYPE[k]) for k in live}
    scored = CM.predictions_long(CM.score_live(spark, frames, models_root))
    rest = view.filter(~kind.isin([C.COMP_TYPE[k] for k in live]))
    return C.component_predictions(rest).unionByName(scored)
