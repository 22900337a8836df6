"""Location and map views: T-06, T-07, T-12.

Alert counts are aggregated per key *before* joining to the location rows so
the joins never fan out; the big alert tables are reduced map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import risk_label
from ..operators.joins import ref_join
from ..sources import driver as D


def location_enriched(aircraft_map: DataFrame, airport_ref: DataFrame, version: int = 2) -> DataFrame:
    """T-06.  v1: inner join on base_airport_code = airport_code (both kept);
    v2: left join USING airport_code, six columns."""
    if version == 1:
        return aircraft_map.join(airport_ref, aircraft_map["base_airport_code"] == airport_ref["airport_code"])
    return ref_join(aircraft_map, airport_ref, on="airport_code", how="left").select(
        "aircraft_id", "airport_code", "airport_name", "city", "latitude", "longitude")


def location(spark, sf) -> DataFrame:
    """T-06 v2 on the driver tables (customer → nation → region)."""
    return location_enriched(D.aircraft_airport_map(spark, sf), D.airport_reference(spark, sf))


def aircraft_summary(predictions: DataFrame) -> DataFrame:
    """Latest state and number of alerts per aircraft, in one pass over the
    predictions (rows are unique by aircraft and time; no extra shuffle, as the
    chain is partitioned by aircraft already)."""
    return predictions.groupBy("aircraft_id").agg(
        F.max_by(risk_label(), F.col("timestamp")).alias("engine_health_status"),
        F.max("timestamp").alias("timestamp"),
        F.count_if(F.col("predicted_anomaly") == 1).alias("alert_count"))


def status_map_from(loc: DataFrame, summary: DataFrame, with_airport: bool = True) -> DataFrame:
    """T-07 from ``aircraft_summary``."""
    keys = ["aircraft_id"] + (["airport_code"] if with_airport else []) + ["latitude", "longitude"]
    j = loc.select(*keys).join(summary.select("aircraft_id", "engine_health_status", "alert_count"),
                               "aircraft_id", "left")
    return (j.groupBy(*keys, "engine_health_status")
            .agg(F.sum(F.coalesce(F.col("alert_count"), F.lit(0))).cast("long").alias("alert_count")))


def status_map(loc: DataFrame, twin: DataFrame, alerts: DataFrame, with_airport: bool = True) -> DataFrame:
    """T-07 (J-05, A-01): location ⟕ latest engine state ⟕ alert count.

    Same groups as the original ``groupBy(aircraft, [airport], lat, lon,
    status).count(alerts.aircraft_id)``; the alert count is computed per
    aircraft first and a missing count becomes 0."""
    per_aircraft = alerts.groupBy("aircraft_id").agg(F.count("aircraft_id").alias("alert_count"))
    keys = ["aircraft_id"] + (["airport_code"] if with_airport else []) + ["latitude", "longitude"]
    j = (loc.select(*keys).join(twin.select("aircraft_id", "engine_health_status"), "aircraft_id", "left")
         .join(per_aircraft, "aircraft_id", "left"))
    return (j.groupBy(*keys, "engine_health_status")
            .agg(F.sum(F.coalesce(F.col("alert_count"), F.lit(0))).cast("long").alias("alert_count")))


def component_status_map(loc: DataFrame, comp_alerts: DataFrame, count_mode: str = "rows") -> DataFrame:
    """T-12 (J-06, A-02).  count_mode='rows' reproduces ``count(*)`` after the
    left join (an aircraft without alerts counts 1 with NULL type, K18);
    'alerts' counts matched alerts only."""
    per = comp_alerts.groupBy("aircraft_id", "component_type", "health_status").agg(
        F.count(F.lit(1)).alias("__n"))
    j = loc.select("aircraft_id", "airport_code", "latitude", "longitude").join(per, "aircraft_id", "left")
    n = F.coalesce(F.col("__n"), F.lit(1 if count_mode == "rows" else 0))
    return (j.groupBy("airport_code", "latitude", "longitude", "component_type", "health_status")
            .agg(F.sum(n).cast("long").alias("alert_count")))
