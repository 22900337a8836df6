"""Dashboard queries (Q-01 … Q-29) as DataFrame functions.

The views the dashboard design refers to but never defines are built here
from the pipeline tables:

* ``component_health_daily`` – per (aircraft, day, component type): mean
  health score of its readings (NOMINAL 100 / WARNING 70 / CRITICAL 40),
  readings that were not NOMINAL (``alert_count``) and the last status;
* ``aircraft_health_daily`` – the same rolled up per (aircraft, day).

Wall-clock functions are never called; every date window takes ``as_of``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.skew import RangeParts, with_part
from ..functions.scalars import health_band, health_score


def _d(as_of):
    return F.to_date(F.lit(as_of))


def component_health_daily(view: DataFrame) -> DataFrame:
    v = view.select("aircraft_id", "component_type", "component_id", "event_timestamp", "health_status",
                    F.to_date("event_timestamp").alias("date"), health_score().alias("score"))
    return v.groupBy("aircraft_id", "date", "component_type").agg(
        F.avg("score").alias("health_score"),
        F.count_if(F.col("health_status") != S.HEALTH_NOMINAL).alias("alert_count"),
        F.count(F.lit(1)).alias("readings"),
        F.max_by("health_status", F.struct("event_timestamp", "component_id", "health_status"))
        .alias("latest_status"))


def aircraft_health_daily(view: DataFrame) -> DataFrame:
    v = view.select("aircraft_id", F.to_date("event_timestamp").alias("date"), "health_status",
                    health_score().alias("score"))
    return v.groupBy("aircraft_id", "date").agg(
        F.avg("score").alias("health_score"),
        F.count_if(F.col("health_status") != S.HEALTH_NOMINAL).alias("alert_count"))


def fleet_summary(daily: DataFrame, as_of: str) -> DataFrame:
    """Q-01 (A-13, R-15): one row for the fleet on ``as_of``."""
    s = F.col("health_score")
    return daily.filter(F.col("date") == _d(as_of)).agg(
        F.count_distinct("aircraft_id").alias("total_aircraft"),
        F.count_if(s >= S.BAND_HEALTHY).alias("healthy_count"),
        F.count_if((s < S.BAND_HEALTHY) & (s >= S.BAND_WARNING)).alias("warning_count"),
        F.count_if(s < S.BAND_WARNING).alias("critical_count"),
        F.avg(s).alias("avg_fleet_health"),
        F.sum("alert_count").alias("total_active_alerts"))


def health_by_group(daily: DataFrame, models: DataFrame, as_of: str) -> DataFrame:
    """Q-02: health by manufacturer (aircraft → model reference)."""
    d = daily.filter(F.col("date") == _d(as_of)).join(
        models.select(F.col("model").alias("aircraft_id"), "manufacturer"), "aircraft_id", "left")
    return d.groupBy("manufacturer").agg(
        F.count_distinct("aircraft_id").alias("aircraft_count"),
        F.avg("health_score").alias("avg_health_score"),
        F.sum("alert_count").alias("total_alerts"))


def trend(daily: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Q-03: per day of the last ``days`` days."""
    d = daily.filter((F.col("date") >= F.date_sub(_d(as_of), days)) & (F.col("date") <= _d(as_of)))
    return d.groupBy("date").agg(F.count_distinct("aircraft_id").alias("active_aircraft"),
                                 F.avg("health_score").alias("avg_health_score"),
                                 F.sum("alert_count").alias("total_alerts"))


def alerts_by_component(unified: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Q-04: alerts by component × severity over the last ``days`` days."""
    u = unified.filter(F.col("alert_date") >= F.date_sub(_d(as_of), days))
    return u.groupBy("component_name", "alert_severity").agg(F.count(F.lit(1)).alias("alert_count"))


def daily_alerts(unified: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Q-05: daily alerts per component over the last ``days`` days."""
    u = unified.filter(F.col("alert_date") >= F.date_sub(_d(as_of), days))
    return u.groupBy(F.col("alert_date").alias("date"), "component_name").agg(
        F.count(F.lit(1)).alias("daily_alerts"))


def component_matrix(comp_daily: DataFrame) -> DataFrame:
    """Q-08 for every aircraft: latest day's health per component type."""
    latest = comp_daily.groupBy("aircraft_id", "component_type").agg(
        F.max_by(F.struct("date", "health_score", "alert_count", "latest_status"), F.col("date")).alias("x"))
    return latest.select("aircraft_id", "component_type", F.col("x.date").alias("last_assessment_date"),
                         F.col("x.health_score").alias("health_score"), F.col("x.alert_count").alias("alert_count"),
                         F.col("x.latest_status").alias("health_status"),
                         health_band(F.col("x.health_score")).alias("health_band"))


def aircraft_header(engine_view: DataFrame, models: DataFrame, loc: DataFrame, aircraft_id=None) -> DataFrame:
    """Q-07: header row per aircraft (latest state, model, base)."""
    e = engine_view if aircraft_id is None else engine_view.filter(F.col("aircraft_id") == aircraft_id)
    return (e.select("aircraft_id", "timestamp", "engine_health_status", "predicted_anomaly")
            .join(models.select(F.col("model").alias("aircraft_id"), "manufacturer", "engine_type"),
                  "aircraft_id", "left")
            .join(loc.select("aircraft_id", "airport_code", "city"), "aircraft_id", "left"))


def component_alert_history(unified: DataFrame) -> DataFrame:
    """Q-10: per aircraft × component: alert count, first and last alert."""
    return unified.groupBy("aircraft_id", "component_id").agg(
        F.count(F.lit(1)).alias("alerts"), F.min("timestamp").alias("first_alert"),
        F.max("timestamp").alias("last_alert"))


def component_trend(view: DataFrame, metric: str, as_of: str, days: int = 90) -> DataFrame:
    """Q-11: daily mean of one metric per component type over ``days`` days."""
    v = view.withColumn("date", F.to_date("event_timestamp")).filter(
        (F.col("date") > F.date_sub(_d(as_of), days)) & (F.col("date") <= _d(as_of)))
    return v.groupBy("component_type", "date").agg(F.avg(metric).alias(f"avg_{metric}"),
                                                   F.count(metric).alias("readings"))


def upcoming_maintenance(schedule: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Q-14: scheduled events in (as_of, as_of + days]."""
    d = F.to_date("o_orderdate")
    return schedule.filter((d > _d(as_of)) & (d <= F.date_add(_d(as_of), days))).select(
        F.col("o_custkey").alias("aircraft_id"), F.col("o_orderkey").alias("schedule_id"),
        d.alias("scheduled_date"), F.col("o_orderpriority").alias("priority"),
        F.datediff(d, _d(as_of)).alias("days_until"))


def benchmarking(features: DataFrame) -> DataFrame:
    """Q-15: mean sensor metrics by manufacturer."""
    return features.groupBy("manufacturer").agg(
        F.count_distinct("aircraft_id").alias("aircraft"), F.avg("engine_temp").alias("avg_engine_temp"),
        F.avg("vibration").alias("avg_vibration"), F.avg("fuel_efficiency").alias("avg_fuel_efficiency"))


def maintenance_cost(history: DataFrame) -> DataFrame:
    """Q-16: cost per component class (orders: priority as class, total price as cost)."""
    return history.groupBy(F.col("o_orderpriority").alias("component")).agg(
        F.count(F.lit(1)).alias("events"), F.sum("o_totalprice").alias("total_cost"),
        F.avg("o_totalprice").alias("avg_cost"))


def alerts_per_airport(unified: DataFrame, loc: DataFrame) -> DataFrame:
    """Q-17 (second part): alerts per base airport; unmapped aircraft → NULL airport."""
    per = unified.groupBy("aircraft_id").agg(F.count(F.lit(1)).alias("n"))
    return (per.join(loc.select("aircraft_id", "airport_code"), "aircraft_id", "left")
            .groupBy("airport_code").agg(F.sum("n").alias("alerts"), F.count(F.lit(1)).alias("aircraft")))


def critical_alerts(unified: DataFrame, as_of: str) -> DataFrame:
    """Q-18: CRITICAL-category alerts of one day."""
    return unified.filter((F.col("alert_category") == "CRITICAL") & (F.col("alert_date") == _d(as_of)))


def period_counts(unified: DataFrame, unit: str) -> DataFrame:
    """Q-21: alerts per day / week (``date_trunc``)."""
    return unified.groupBy(F.to_date(F.date_trunc(unit, "timestamp")).alias("period")).agg(
        F.count(F.lit(1)).alias("alerts"))


def histogram(df: DataFrame, col: str, width: float) -> DataFrame:
    """Q-22: fixed-width histogram."""
    b = (F.floor(F.col(col) / width) * width).cast("double")
    return df.groupBy(b.alias("bucket_start")).agg(F.count(F.lit(1)).alias("readings"))


def aircraft_status(summary: DataFrame, component_view: DataFrame, maintenance: DataFrame) -> DataFrame:
    """Q-23: status, alert count (own and of all components) and last
    maintenance per aircraft.  ``summary``: ``maps.aircraft_summary``."""
    parts = component_view.groupBy("aircraft_id").agg(
        F.count_if(F.col("health_status") != S.HEALTH_NOMINAL).alias("__parts"))
    maint = maintenance.groupBy("aircraft_id").agg(F.max("event_date").alias("last_maintenance"))
    return (summary.join(parts, "aircraft_id", "left").join(maint, "aircraft_id", "left")
            .select("aircraft_id", "engine_health_status", "timestamp",
                    (F.col("alert_count") + F.coalesce("__parts", F.lit(0))).alias("alert_count"),
                    "last_maintenance"))


def high_risk_by_airport(engine_view: DataFrame, loc: DataFrame) -> DataFrame:
    """Q-24."""
    return (engine_view.filter(F.col("engine_health_status") == S.RISK_HIGH).select("aircraft_id")
            .join(loc.select("aircraft_id", "airport_code"), "aircraft_id", "left")
            .groupBy("airport_code").agg(F.count(F.lit(1)).alias("high_risk_aircraft")))


def maintenance_vs_anomaly(predictions: DataFrame, bucket_days: int = 7) -> DataFrame:
    """Q-25: anomaly rate by weeks since maintenance."""
    b = F.floor(F.col("days_since_maint") / bucket_days).cast("int")
    return predictions.groupBy(b.alias("weeks_since_maint")).agg(
        F.count(F.lit(1)).alias("readings"), F.avg("predicted_anomaly").alias("anomaly_rate"),
        F.avg("anomaly_score").alias("label_rate"))


def rolling_by_group(features: DataFrame) -> DataFrame:
    """Q-26: mean rolling vibration by manufacturer and day."""
    return features.groupBy("manufacturer", F.to_date("timestamp").alias("date")).agg(
        F.avg("avg_vibration_7d").alias("mean_rolling_vibration"))


def at_risk_components(comp_matrix: DataFrame) -> DataFrame:
    """Q-27: components whose latest status is not NOMINAL, per aircraft."""
    return comp_matrix.groupBy("aircraft_id").agg(
        F.count_if(F.col("health_status") != S.HEALTH_NOMINAL).alias("at_risk_components"),
        F.count(F.lit(1)).alias("components"))


def top_alerting(comp_alerts: DataFrame, k: int = 10) -> DataFrame:
    """Q-28: top-k aircraft by CRITICAL/WARNING alerts (ties by aircraft id)."""
    c = comp_alerts.groupBy("aircraft_id").agg(
        F.count_if(F.col("health_status") == S.HEALTH_CRITICAL).alias("critical_alerts"),
        F.count_if(F.col("health_status") == S.HEALTH_WARNING).alias("warning_alerts"),
        F.count(F.lit(1)).alias("total_alerts"))
    return c.orderBy(F.col("total_alerts").desc(), F.col("aircraft_id")).limit(k)


def rows_per_group(df: DataFrame, key: str = "aircraft_id") -> DataFrame:
    """Q-29 / A-05."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))


def component_alert_detail(unified: DataFrame) -> DataFrame:
    """Q-10: distinct alerts per aircraft and component, newest first."""
    cols = ["aircraft_id", "component_id", "component_name", "timestamp", "alert_date", "alert_severity",
            "alert_category", "inference_trace_id"]
    w = Window.partitionBy("aircraft_id", "component_id").orderBy(
        F.col("alert_date").desc(), F.col("timestamp").desc(), F.col("inference_trace_id").desc())
    return unified.select(*cols).distinct().withColumn("place", F.row_number().over(w).cast("long"))


def severity_score():
    """Alert category as a sort key: critical before safety before the rest."""
    return F.when(F.col("alert_category") == "CRITICAL", 3).when(F.col("alert_category") == "SAFETY", 2).otherwise(1)


def active_alerts(unified: DataFrame, as_of: str, days: int = 7, aircraft_id=None) -> DataFrame:
    """Q-09: alerts of the last ``days`` days per aircraft, by date, then severity."""
    day = F.lit(as_of).cast("date")
    u = unified.filter((F.col("alert_date") > F.date_sub(day, days)) & (F.col("alert_date") <= day))
    if aircraft_id is not None:
        u = u.filter(F.col("aircraft_id") == aircraft_id)
    w = Window.partitionBy("aircraft_id").orderBy(F.col("alert_date").desc(), F.col("severity_score").desc(),
                                                  "component_name", "inference_trace_id")
    return (u.withColumn("severity_score", severity_score())
            .groupBy("aircraft_id", "component_name", "alert_date", "alert_severity", "alert_category",
                     "inference_trace_id", "severity_score").agg(F.count(F.lit(1)).alias("alerts"))
            .withColumn("place", F.row_number().over(w).cast("long")))


def recent_alerts(unified: DataFrame, as_of: str, days: int = 7, aircraft_id=None) -> DataFrame:
    """Q-19: alerts from ``days`` days before ``as_of`` on, with their source."""
    day = F.lit(as_of).cast("date")
    u = unified.filter((F.col("alert_date") >= F.date_sub(day, days)) & (F.col("alert_date") <= day))
    if aircraft_id is not None:
        u = u.filter(F.col("aircraft_id") == aircraft_id)
    return u.select("timestamp", "aircraft_id", "component_name", "alert_severity", "alert_category",
                    "inference_source", "inference_trace_id", "batch_id")


def critical_over_time(view: DataFrame) -> DataFrame:
    """Q-27: critical readings and affected aircraft per component type and day."""
    return (view.filter(F.col("health_status") == "CRITICAL")
            .groupBy("component_type", F.to_date("event_timestamp").alias("date"))
            .agg(F.count(F.lit(1)).alias("failures"), F.count_distinct("aircraft_id").alias("aircraft")))


def worst_first(aircraft_daily: DataFrame, as_of: str) -> DataFrame:
    """Q-02 / Q-08: one day's aircraft in order of health, worst first.

    The rows are cut into ranges of the order itself; a place is the number of
    rows in the ranges before (a window over one row per range) and the rank
    inside the range, so neither the fleet nor a class of equal health meets
    in one task."""
    d = aircraft_daily.filter(F.col("date") == F.lit(as_of).cast("date")).select(
        "aircraft_id", "health_score", "alert_count")
    order = [F.col("health_score").asc(), F.col("alert_count").desc(), F.col("aircraft_id").asc()]
    d = with_part(d, [], order, RangeParts(), "__part")
    sizes = d.groupBy(F.col("__part").alias("__of")).agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__of").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("__of", F.coalesce(before, F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return (d.withColumn("__in", inside).join(F.broadcast(offsets), F.col("__part") == F.col("__of"))
            .select("aircraft_id", "health_score", "alert_count",
                    (F.col("__before") + F.col("__in")).cast("long").alias("place")))


#: levels of :func:`fleet_cube`, from the whole fleet to one aircraft's component on one day
CUBE_DIMS = ["model", "airport", "aircraft_id", "component_type", "day"]
CUBE_LEVELS = [[], ["component_type"], ["model", "component_type"], ["airport", "component_type"],
               ["aircraft_id", "component_type"], ["model", "component_type", "day"], ["airport", "component_type", "day"],
               ["component_type", "day"], ["aircraft_id", "component_type", "day"]]


def fleet_cube(view: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Q-02 / Q-08 / Q-27: readings, alerts and mean health of every level of
    ``CUBE_LEVELS`` in one pass over the component view.

    ``aircraft``: aircraft_id, model, airport (an aircraft without a row has
    NULL for both).  ``level`` is ``grouping_id`` over ``CUBE_DIMS``, so a NULL
    value and a dimension that is rolled up are told apart.  Readings are
    summed per (aircraft, component, day) first; those sums are the finest level
    as they stand (times the rows that an aircraft has), and what the grouping
    sets multiply for the other levels, so that no task holds the finest level's
    groups beside the sums."""
    daily = view.groupBy("aircraft_id", "component_type", F.to_date("event_timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("r"), F.count_if(F.col("health_status") == S.HEALTH_CRITICAL).alias("c"),
        F.count_if(F.col("health_status") == S.HEALTH_WARNING).alias("w"))
    known = aircraft.select(F.col("aircraft_id").alias("__a"), "model", "airport")
    rows = daily.join(known, F.col("aircraft_id") == F.col("__a"), "left").drop("__a")
    def measures(r, c, w):
        return [r.alias("readings"), c.alias("critical"), w.alias("warning"),
                (((r - c - w) * 100.0 + w * 70.0 + c * 40.0) / r).alias("mean_health")]

    finest = ["aircraft_id", "component_type", "day"]
    dims = [F.col(c) for c in CUBE_DIMS]
    coarse = rows.groupingSets([[F.col(c) for c in level] for level in CUBE_LEVELS if level != finest], *dims).agg(
        F.grouping_id().cast("long").alias("level"), *measures(F.sum("r"), F.sum("c"), F.sum("w")))
    times = known.groupBy("__a").agg(F.count(F.lit(1)).alias("__m"))
    m = F.coalesce(F.col("__m"), F.lit(1))
    types = {f.name: f.dataType for f in rows.schema.fields}
    single = daily.join(times, F.col("aircraft_id") == F.col("__a"), "left").select(
        *[F.col(c) if c in finest else F.lit(None).cast(types[c]).alias(c) for c in CUBE_DIMS],
        F.lit(_level(finest)).cast("long").alias("level"), *measures(F.col("r") * m, F.col("c") * m, F.col("w") * m))
    return coarse.unionByName(single)


def _level(dims) -> int:
    """``grouping_id`` of a level: a bit for every dimension that is rolled up."""
    return sum(1 << (len(CUBE_DIMS) - 1 - i) for i, c in enumerate(CUBE_DIMS) if c not in dims)


def cube_level(cube: DataFrame, dims, **where) -> DataFrame:
    """One level of the cube, filtered: ``cube_level(cube, ["airport",
    "component_type"], airport=7)`` is the heat map of a base (Q-27)."""
    if sorted(dims) not in [sorted(level) for level in CUBE_LEVELS]:
        raise ValueError(f"no level {dims}")
    if unknown := set(where) - set(dims):
        raise ValueError(f"not dimensions of this level: {sorted(unknown)}")
    out = cube.filter(F.col("level") == _level(dims))
    for c, v in where.items():
        out = out.filter(F.col(c) == v)
    return out.select(*dims, "readings", "critical", "warning", "mean_health")
