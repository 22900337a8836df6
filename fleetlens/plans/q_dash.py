"""Catalog entries of the dashboard queries (Q-*) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import driver as D
from . import alerts as A
from . import components as C
from . import dashboards as Q
from . import maps
from . import oracle as O
from .catalog import query
from .q_alerts import RUN_TS, unified
from .q_components import view
from .q_sensor import _chain

AS_OF = "2024-01-15"
AS_OF_END = "2024-01-30"
SCHED_AS_OF = "1998-06-30"

COMP = O.with_(*O.comp_ctes(O.COMP_KEYS), O.comp_view())
MART = O.with_(*O.mart_ctes())
E1P = [*O.E1, O.enriched("JOIN"), O.FEATURES, O.PREDICTIONS]


def _r(df, cols, d=6):
    return df.withColumns({c: F.round(c, d) for c in cols})


def comp_daily(spark, sf):
    return Q.component_health_daily(view(spark, sf))


def aircraft_daily(spark, sf):
    return Q.aircraft_health_daily(view(spark, sf))


@query("fleet_summary", O.with_(*O.comp_ctes(O.COMP_KEYS), O.comp_view(), O.AIRCRAFT_DAILY) + f"""
SELECT count(DISTINCT aircraft_id) AS total_aircraft,
       count(*) FILTER (WHERE health_score >= 80) AS healthy_count,
       count(*) FILTER (WHERE health_score < 80 AND health_score >= 60) AS warning_count,
       count(*) FILTER (WHERE health_score < 60) AS critical_count,
       round(avg(health_score), 6) AS avg_fleet_health, CAST(sum(alert_count) AS BIGINT) AS total_active_alerts
FROM aircraft_daily WHERE date = DATE '{AS_OF}'""")
def fleet_summary(spark, sf):
    """Q-01 (A-13, R-15)."""
    return _r(Q.fleet_summary(aircraft_daily(spark, sf), AS_OF), ["avg_fleet_health"])


@query("health_by_group", O.with_(*O.comp_ctes(O.COMP_KEYS), O.comp_view(), O.AIRCRAFT_DAILY, O.MODELS) + f"""
SELECT m.manufacturer, count(DISTINCT d.aircraft_id) AS aircraft_count,
       round(avg(d.health_score), 6) AS avg_health_score, CAST(sum(d.alert_count) AS BIGINT) AS total_alerts
FROM aircraft_daily d LEFT JOIN models m ON m.model = d.aircraft_id
WHERE d.date = DATE '{AS_OF}' GROUP BY m.manufacturer""")
def health_by_group(spark, sf):
    """Q-02."""
    return _r(Q.health_by_group(aircraft_daily(spark, sf), D.model_reference(spark, sf), AS_OF),
              ["avg_health_score"])


@query("trend_30d", O.with_(*O.comp_ctes(O.COMP_KEYS), O.comp_view(), O.AIRCRAFT_DAILY) + f"""
SELECT date, count(DISTINCT aircraft_id) AS active_aircraft, round(avg(health_score), 6) AS avg_health_score,
       CAST(sum(alert_count) AS BIGINT) AS total_alerts
FROM aircraft_daily WHERE date >= DATE '{AS_OF_END}' - 30 AND date <= DATE '{AS_OF_END}' GROUP BY date""")
def trend_30d(spark, sf):
    """Q-03."""
    return _r(Q.trend(aircraft_daily(spark, sf), AS_OF_END, 30), ["avg_health_score"])


@query("alerts_by_component", MART + f"""
SELECT component_name, alert_severity, count(*) AS alert_count FROM unified
WHERE alert_date >= DATE '{AS_OF_END}' - 7 GROUP BY ALL""")
def alerts_by_component(spark, sf):
    """Q-04."""
    return Q.alerts_by_component(unified(spark, sf), AS_OF_END, 7)


@query("daily_alerts", MART + f"""
SELECT alert_date AS date, component_name, count(*) AS daily_alerts FROM unified
WHERE alert_date >= DATE '{AS_OF_END}' - 30 GROUP BY ALL""")
def daily_alerts(spark, sf):
    """Q-05."""
    return Q.daily_alerts(unified(spark, sf), AS_OF_END, 30)


@query("status_map", O.with_(*E1P, O.ENGINE_VIEW, O.AC_ALERTS, O.LOCATION) + """
SELECT l.aircraft_id, l.airport_code, l.latitude, l.longitude, e.engine_health_status,
       count(a.aircraft_id) AS alert_count
FROM location l LEFT JOIN engine_view e ON e.aircraft_id = l.aircraft_id
LEFT JOIN ac_alerts a ON a.aircraft_id = l.aircraft_id
GROUP BY l.aircraft_id, l.airport_code, l.latitude, l.longitude, e.engine_health_status""")
def status_map(spark, sf):
    """T-07 / Q-06 (J-05, A-01): location ⟕ latest state ⟕ alert count."""
    return maps.status_map_from(maps.location(spark, sf), maps.aircraft_summary(_chain(spark, sf)["predictions"]))


@query("location_v1", O.with_(O.LOCATION) + """
SELECT c_custkey AS aircraft_id, c_nationkey AS base_airport_code, a.*
FROM customer JOIN airports a ON c_nationkey = a.airport_code""")
def location_v1(spark, sf):
    """T-06 v1 / J-03: inner join, both key columns kept."""
    m = D.aircraft_airport_map(spark, sf).withColumnRenamed("airport_code", "base_airport_code")
    return maps.location_enriched(m, D.airport_reference(spark, sf), version=1)


@query("location_v2", O.with_(O.LOCATION) + "SELECT * FROM location")
def location_v2(spark, sf):
    """T-06 v2 / J-04: left join USING airport_code."""
    return maps.location(spark, sf)


@query("component_matrix", O.with_(*O.comp_ctes(O.COMP_KEYS), O.comp_view(), O.COMP_DAILY) + """
SELECT aircraft_id, component_type, date AS last_assessment_date, round(health_score, 6) AS health_score,
       alert_count, latest_status AS health_status,
       CASE WHEN health_score >= 80 THEN 'HEALTHY' WHEN health_score >= 60 THEN 'WARNING'
            WHEN health_score IS NOT NULL THEN 'CRITICAL' END AS health_band
FROM (SELECT *, row_number() OVER (PARTITION BY aircraft_id, component_type ORDER BY date DESC) AS rn
      FROM comp_daily) t WHERE rn = 1""")
def component_matrix(spark, sf):
    """Q-08 for the whole fleet."""
    return _r(Q.component_matrix(comp_daily(spark, sf)), ["health_score"])


@query("at_risk_components", O.with_(*O.comp_ctes(O.COMP_KEYS), O.comp_view(), O.COMP_DAILY) + """
SELECT aircraft_id, count(*) FILTER (WHERE latest_status <> 'NOMINAL') AS at_risk_components,
       count(*) AS components
FROM (SELECT *, row_number() OVER (PARTITION BY aircraft_id, component_type ORDER BY date DESC) AS rn
      FROM comp_daily) t WHERE rn = 1 GROUP BY aircraft_id""")
def at_risk_components(spark, sf):
    """Q-27 (at-risk components per aircraft)."""
    return Q.at_risk_components(Q.component_matrix(comp_daily(spark, sf)))


@query("aircraft_header", O.with_(*E1P, O.ENGINE_VIEW, O.LOCATION) + """
SELECT e.aircraft_id, e."timestamp", e.engine_health_status, e.predicted_anomaly, m.manufacturer, m.engine_type,
       l.airport_code, l.city
FROM engine_view e LEFT JOIN models m ON m.model = e.aircraft_id LEFT JOIN location l ON l.aircraft_id = e.aircraft_id""")
def aircraft_header(spark, sf):
    """Q-07 for every aircraft (a single aircraft is a filter on this)."""
    return Q.aircraft_header(_chain(spark, sf)["engine_view"], D.model_reference(spark, sf), maps.location(spark, sf))


@query("component_alert_history", MART + """
SELECT aircraft_id, component_id, count(*) AS alerts, min("timestamp") AS first_alert, max("timestamp") AS last_alert
FROM unified GROUP BY ALL""")
def component_alert_history(spark, sf):
    """Q-10."""
    return Q.component_alert_history(unified(spark, sf))


@query("component_alert_detail", MART + """
SELECT aircraft_id, component_id, component_name, "timestamp", alert_date, alert_severity, alert_category,
       inference_trace_id,
       row_number() OVER (PARTITION BY aircraft_id, component_id ORDER BY alert_date DESC, "timestamp" DESC,
                          inference_trace_id DESC) AS place
FROM (SELECT DISTINCT aircraft_id, component_id, component_name, "timestamp", alert_date, alert_severity,
             alert_category, inference_trace_id FROM unified) t""")
def component_alert_detail(spark, sf):
    """Q-10: the alerts of every aircraft and component, newest first (``place``)."""
    return Q.component_alert_detail(unified(spark, sf))


@query("active_alerts", MART + f"""
SELECT aircraft_id, component_name, alert_date, alert_severity, alert_category, inference_trace_id,
       CASE alert_category WHEN 'CRITICAL' THEN 3 WHEN 'SAFETY' THEN 2 ELSE 1 END AS severity_score, count(*) AS alerts,
       row_number() OVER (PARTITION BY aircraft_id
         ORDER BY alert_date DESC, CASE alert_category WHEN 'CRITICAL' THEN 3 WHEN 'SAFETY' THEN 2 ELSE 1 END DESC,
                  component_name, inference_trace_id) AS place
FROM unified WHERE alert_date > DATE '{AS_OF}' - 7 AND alert_date <= DATE '{AS_OF}'
GROUP BY aircraft_id, component_name, alert_date, alert_severity, alert_category, inference_trace_id""")
def active_alerts(spark, sf):
    """Q-09: active alerts (last 7 days) per aircraft, by date and severity."""
    return Q.active_alerts(unified(spark, sf), AS_OF, 7)


@query("aircraft_alerts_7d", MART + f"""
SELECT "timestamp", aircraft_id, component_name, alert_severity, alert_category, inference_source,
       inference_trace_id, batch_id
FROM unified WHERE alert_date >= DATE '{AS_OF}' - 7 AND alert_date <= DATE '{AS_OF}'""")
def aircraft_alerts_7d(spark, sf):
    """Q-19: alerts of the last seven days with their inference source."""
    return Q.recent_alerts(unified(spark, sf), AS_OF, 7)


@query("critical_sources", O.with_(*O.mart_ctes(), O.TRACE) + f"""
SELECT aircraft_id, "timestamp", component_name, alert_severity, inference_table, inference_trace_id
FROM trace WHERE alert_category = 'CRITICAL' AND alert_date = DATE '{AS_OF}'""")
def critical_sources(spark, sf):
    """Q-19: source inference rows of a day's critical alerts."""
    from .q_alerts import trace
    return Q.critical_alerts(trace(spark, sf), AS_OF).select(
        "aircraft_id", "timestamp", "component_name", "alert_severity", "inference_table", "inference_trace_id")


@query("high_alerts_latest", MART + """
SELECT aircraft_id, component_id, max("timestamp") AS "timestamp" FROM unified WHERE alert_severity = 'HIGH'
GROUP BY aircraft_id, component_id""")
def high_alerts_latest(spark, sf):
    """Q-18: HIGH rows of the latest-alert view."""
    return A.dashboard_view(unified(spark, sf)).filter(F.col("alert_severity") == "HIGH").select(
        "aircraft_id", "component_id", "timestamp")


@query("critical_over_time", COMP + """
SELECT component_type, CAST(event_timestamp AS DATE) AS date, count(*) AS failures,
       count(DISTINCT aircraft_id) AS aircraft
FROM comp_view WHERE health_status = 'CRITICAL' GROUP BY ALL""")
def critical_over_time(spark, sf):
    """Q-27: critical failures per component type and day."""
    return Q.critical_over_time(view(spark, sf))


@query("health_ranking", O.with_(*O.comp_ctes(O.COMP_KEYS), O.comp_view(), O.AIRCRAFT_DAILY) + f"""
SELECT aircraft_id, health_score, alert_count, row_number() OVER (ORDER BY health_score, alert_count DESC, aircraft_id) AS place
FROM aircraft_daily WHERE date = DATE '{AS_OF}'""")
def health_ranking(spark, sf):
    """Q-02 / Q-08 / U-04: aircraft of a day, worst first."""
    return Q.worst_first(aircraft_daily(spark, sf), AS_OF)


@query("component_trend", COMP + f"""
SELECT component_type, date, round(avg(vibration_level), 6) AS avg_vibration_level, count(vibration_level) AS readings
FROM (SELECT *, CAST(event_timestamp AS DATE) AS date FROM comp_view) t
WHERE date > DATE '{AS_OF_END}' - 90 AND date <= DATE '{AS_OF_END}' GROUP BY ALL""")
def component_trend(spark, sf):
    """Q-11."""
    return _r(Q.component_trend(view(spark, sf), "vibration_level", AS_OF_END, 90), ["avg_vibration_level"])


@query("upcoming_maintenance", f"""
SELECT o_custkey AS aircraft_id, o_orderkey AS schedule_id, CAST(o_orderdate AS DATE) AS scheduled_date,
       o_orderpriority AS priority, CAST(date_diff('day', DATE '{SCHED_AS_OF}', CAST(o_orderdate AS DATE)) AS INTEGER)
       AS days_until
FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '{SCHED_AS_OF}'
  AND CAST(o_orderdate AS DATE) <= DATE '{SCHED_AS_OF}' + 30""")
def upcoming_maintenance(spark, sf):
    """Q-14 (schedule mapped to orders)."""
    return Q.upcoming_maintenance(D.table(spark, sf, "orders"), SCHED_AS_OF, 30)


@query("benchmarking", O.with_(*O.E1, O.enriched("JOIN"), O.FEATURES) + """
SELECT manufacturer, count(DISTINCT aircraft_id) AS aircraft, round(avg(engine_temp), 6) AS avg_engine_temp,
       round(avg(vibration), 6) AS avg_vibration, round(avg(fuel_efficiency), 6) AS avg_fuel_efficiency
FROM feat GROUP BY manufacturer""")
def benchmarking(spark, sf):
    """Q-15."""
    return _r(Q.benchmarking(_chain(spark, sf)["features"]),
              ["avg_engine_temp", "avg_vibration", "avg_fuel_efficiency"])


@query("maintenance_cost", """
SELECT o_orderpriority AS component, count(*) AS events, round(sum(o_totalprice), 2) AS total_cost,
       round(avg(o_totalprice), 4) AS avg_cost
FROM orders GROUP BY o_orderpriority""")
def maintenance_cost(spark, sf):
    """Q-16 (cost history mapped to orders)."""
    return _r(_r(Q.maintenance_cost(D.table(spark, sf, "orders")), ["total_cost"], 2), ["avg_cost"], 4)


@query("alerts_per_airport", O.with_(*O.mart_ctes(), O.LOCATION) + """
SELECT l.airport_code, CAST(sum(n) AS BIGINT) AS alerts, count(*) AS aircraft
FROM (SELECT aircraft_id, count(*) AS n FROM unified GROUP BY aircraft_id) u
LEFT JOIN location l ON l.aircraft_id = u.aircraft_id GROUP BY l.airport_code""")
def alerts_per_airport(spark, sf):
    """Q-17."""
    return Q.alerts_per_airport(unified(spark, sf), maps.location(spark, sf))


@query("critical_alerts_today", MART + f"""
SELECT * FROM unified WHERE alert_category = 'CRITICAL' AND alert_date = DATE '{AS_OF}'""")
def critical_alerts_today(spark, sf):
    """Q-18."""
    return Q.critical_alerts(unified(spark, sf), AS_OF)


@query("daily_counts", MART + """
SELECT CAST(date_trunc('day', "timestamp") AS DATE) AS period, count(*) AS alerts FROM unified GROUP BY ALL""")
def daily_counts(spark, sf):
    """Q-21 / A-07."""
    return Q.period_counts(unified(spark, sf), "day")


@query("weekly_counts", MART + """
SELECT CAST(date_trunc('week', "timestamp") AS DATE) AS period, count(*) AS alerts FROM unified GROUP BY ALL""")
def weekly_counts(spark, sf):
    """Q-21."""
    return Q.period_counts(unified(spark, sf), "week")


@query("histogram", O.with_(O.SENSOR) + """
SELECT CAST(floor(engine_temp / 50.0) * 50.0 AS DOUBLE) AS bucket_start, count(*) AS readings FROM sensor GROUP BY ALL""")
def histogram(spark, sf):
    """Q-22: engine temperature histogram, 50-degree buckets."""
    return Q.histogram(D.sensor_readings(spark, sf), "engine_temp", 50.0)


@query("aircraft_status", O.with_(*O.mart_ctes(), O.ENGINE_VIEW) + """
SELECT e.aircraft_id, e.engine_health_status, e."timestamp", COALESCE(a.alert_count, 0) AS alert_count,
       m.last_maintenance
FROM engine_view e
LEFT JOIN (SELECT aircraft_id, count(*) AS alert_count FROM unified GROUP BY aircraft_id) a ON a.aircraft_id = e.aircraft_id
LEFT JOIN (SELECT aircraft_id, max(maint_date) AS last_maintenance FROM maint GROUP BY aircraft_id) m
  ON m.aircraft_id = e.aircraft_id""")
def aircraft_status(spark, sf):
    """Q-23."""
    return Q.aircraft_status(maps.aircraft_summary(_chain(spark, sf)["predictions"]), view(spark, sf),
                             D.maintenance_events(spark, sf))


@query("high_risk_by_airport", O.with_(*E1P, O.ENGINE_VIEW, O.LOCATION) + """
SELECT l.airport_code, count(*) AS high_risk_aircraft
FROM engine_view e LEFT JOIN location l ON l.aircraft_id = e.aircraft_id
WHERE e.engine_health_status = 'HIGH_RISK' GROUP BY l.airport_code""")
def high_risk_by_airport(spark, sf):
    """Q-24."""
    return Q.high_risk_by_airport(_chain(spark, sf)["engine_view"], maps.location(spark, sf))


@query("maintenance_vs_anomaly", O.with_(*E1P) + """
SELECT CAST(floor(days_since_maint / 7) AS INTEGER) AS weeks_since_maint, count(*) AS readings,
       round(avg(predicted_anomaly), 6) AS anomaly_rate, round(avg(anomaly_score), 6) AS label_rate
FROM pred GROUP BY ALL""")
def maintenance_vs_anomaly(spark, sf):
    """Q-25."""
    return _r(Q.maintenance_vs_anomaly(_chain(spark, sf)["predictions"]), ["anomaly_rate", "label_rate"])


@query("rolling_by_group", O.with_(*O.E1, O.enriched("JOIN"), O.FEATURES) + """
SELECT manufacturer, CAST("timestamp" AS DATE) AS date, round(avg(avg_vibration_7d), 6) AS mean_rolling_vibration
FROM feat GROUP BY ALL""")
def rolling_by_group(spark, sf):
    """Q-26."""
    return _r(Q.rolling_by_group(_chain(spark, sf)["features"]), ["mean_rolling_vibration"])


@query("top_k", O.with_(*O.comp_ctes(O.COMP_KEYS), O.comp_view(), O.COMP_ALERTS) + """
SELECT aircraft_id, count(*) FILTER (WHERE health_status = 'CRITICAL') AS critical_alerts,
       count(*) FILTER (WHERE health_status = 'WARNING') AS warning_alerts, count(*) AS total_alerts
FROM comp_alerts GROUP BY aircraft_id ORDER BY total_alerts DESC, aircraft_id LIMIT 10""")
def top_k(spark, sf):
    """Q-28 / A-11: top 10 aircraft by CRITICAL + WARNING alerts."""
    return Q.top_alerting(C.component_alerts(view(spark, sf)), 10)


@query("rows_per_aircraft", O.with_(O.COMP_RAW["fuel"]) + """
SELECT aircraft_id, count(*) AS "rows" FROM fuel_raw GROUP BY aircraft_id""")
def rows_per_aircraft(spark, sf):
    """Q-29: rows per aircraft in a twin table."""
    return Q.rows_per_group(D.fuel_readings(spark, sf))


def _cube_sql():
    dims = Q.CUBE_DIMS
    sets = ", ".join("(" + ", ".join(x) + ")" for x in Q.CUBE_LEVELS)
    return O.with_(*O.comp_ctes(O.COMP_KEYS), O.comp_view()) + f""",
fleet AS (SELECT v.aircraft_id, v.component_type, CAST(v.event_timestamp AS DATE) AS day, v.health_status,
                 c.c_mktsegment AS model, c.c_nationkey AS airport
          FROM comp_view v LEFT JOIN customer c ON c.c_custkey = v.aircraft_id)
SELECT {', '.join(dims)}, GROUPING({', '.join(dims)}) AS level, count(*) AS readings,
       count(*) FILTER (WHERE health_status = 'CRITICAL') AS critical,
       count(*) FILTER (WHERE health_status = 'WARNING') AS warning, round(avg({O.SCORE}), 6) AS mean_health
FROM fleet GROUP BY GROUPING SETS ({sets})"""


def _fleet_cube(spark, sf):
    aircraft = D.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("aircraft_id"), F.col("c_mktsegment").alias("model"),
        F.col("c_nationkey").alias("airport"))
    return Q.fleet_cube(view(spark, sf), aircraft)


@query("fleet_cube", _cube_sql())
def fleet_cube(spark, sf):
    """Q-02 / Q-08 / Q-27: all levels of the fleet cube in one pass."""
    return _fleet_cube(spark, sf).withColumn("mean_health", F.round("mean_health", 6))


@query("heatmap_by_base", O.with_(*O.comp_ctes(O.COMP_KEYS), O.comp_view()) + """
SELECT c.c_nationkey AS airport, v.component_type, count(*) AS readings,
       count(*) FILTER (WHERE v.health_status = 'CRITICAL') AS critical,
       count(*) FILTER (WHERE v.health_status = 'WARNING') AS warning
FROM comp_view v JOIN customer c ON c.c_custkey = v.aircraft_id WHERE c.c_nationkey = 7 GROUP BY ALL""")
def heatmap_by_base(spark, sf):
    """Q-27: the heat map filtered by base, a level of the cube."""
    return Q.cube_level(_fleet_cube(spark, sf), ["airport", "component_type"], airport=7).drop("mean_health")
