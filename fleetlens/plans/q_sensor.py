"""Catalog entries of the aircraft sensor chain (E1) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.quality import clean
from ..operators.windows import rolling_features
from ..sources import driver as D
from . import oracle as O
from . import sensor
from .catalog import query

R6 = ["avg_engine_temp_7d", "avg_vibration_7d", "avg_rpm_7d"]


def _round(df, cols, d=6):
    return df.withColumns({c: F.round(c, d) for c in cols})


def _inputs(spark, sf):
    return D.sensor_readings(spark, sf), D.maintenance_events(spark, sf), D.model_reference(spark, sf)


def _chain(spark, sf, how="inner", skew_bucket=None):
    r, m, mo = _inputs(spark, sf)
    return sensor.run(r, m, mo, how=how, skew_bucket=skew_bucket)


def _sql_round(cols, d=6):
    return ", ".join(f"round({c}, {d}) AS {c}" for c in cols)


@query("clean_filter", O.with_(O.SENSOR, O.CLEANED) + "SELECT * FROM cleaned")
def clean_filter(spark, sf):
    return clean(D.sensor_readings(spark, sf))[0]


@query("clean_quarantine", O.with_(O.SENSOR, O.QUARANTINED) + "SELECT * FROM quarantined")
def clean_quarantine(spark, sf):
    return clean(D.sensor_readings(spark, sf))[1]


@query("asof_join", O.with_(*O.E1, O.enriched("JOIN")) + "SELECT * EXCLUDE (reading_id) FROM enr")
def asof_join(spark, sf):
    return _chain(spark, sf)["enriched"].drop("reading_id")


@query("asof_left", O.with_(*O.E1, O.enriched("LEFT JOIN")) + "SELECT * EXCLUDE (reading_id) FROM enr")
def asof_left(spark, sf):
    return _chain(spark, sf, how="left")["enriched"].drop("reading_id")


@query("asof_join_bucketed", O.with_(*O.E1, O.enriched("JOIN")) + "SELECT * EXCLUDE (reading_id) FROM enr")
def asof_join_bucketed(spark, sf):
    """Same result through the skew-safe two-level plan (range parts)."""
    return _chain(spark, sf, skew_bucket=sensor.RangeParts())["enriched"].drop("reading_id")


_FEAT_SQL = (O.with_(*O.E1, O.enriched("JOIN"), O.FEATURES)
             + f"SELECT * EXCLUDE ({', '.join(R6)}), {_sql_round(R6)} FROM feat")


@query("sensor_features", _FEAT_SQL)
def sensor_features(spark, sf):
    return _round(_chain(spark, sf)["features"], R6)


@query("sensor_features_bucketed", _FEAT_SQL)
def sensor_features_bucketed(spark, sf):
    """Same features through the skew-safe split plan (range parts)."""
    return _round(_chain(spark, sf, skew_bucket=sensor.RangeParts())["features"], R6)


@query("rule_score", O.with_(*O.E1, O.enriched("JOIN"), O.FEATURES, O.PREDICTIONS)
       + "SELECT aircraft_id, \"timestamp\", prev_anomaly, days_since_maint, predicted_anomaly FROM pred")
def rule_score(spark, sf):
    return _chain(spark, sf)["predictions"].select(
        "aircraft_id", "timestamp", "prev_anomaly", "days_since_maint", "predicted_anomaly")


@query("latest_state", O.with_(*O.E1, O.enriched("JOIN"), O.FEATURES, O.PREDICTIONS, O.ENGINE_VIEW)
       + f"SELECT * EXCLUDE ({', '.join(R6)}), {_sql_round(R6)} FROM engine_view")
def latest_state(spark, sf):
    return _round(_chain(spark, sf)["engine_view"], R6)


@query("aircraft_view", O.with_(*O.E1, O.enriched("JOIN"), O.FEATURES, O.PREDICTIONS, O.ENGINE_VIEW)
       + "SELECT aircraft_id, \"timestamp\", engine_health_status, predicted_anomaly FROM engine_view")
def aircraft_view(spark, sf):
    return _chain(spark, sf)["aircraft_view"]


@query("lag_feature", O.with_(O.SENSOR) + """
SELECT aircraft_id, "timestamp", reading_id,
       lag(engine_temp, 1) OVER (PARTITION BY aircraft_id ORDER BY "timestamp", reading_id) AS prev_temp,
       lag(vibration, 1) OVER (PARTITION BY aircraft_id ORDER BY "timestamp", reading_id) AS prev_vibration
FROM sensor""")
def lag_feature(spark, sf):
    """W-05 on all readings (uncleaned), total order (timestamp, reading_id)."""
    r = D.sensor_readings(spark, sf)
    out = rolling_features(r, ["aircraft_id"], ["timestamp", "reading_id"],
                           lags={"prev_temp": "engine_temp", "prev_vibration": "vibration"},
                           bucket=sensor.day_bucket)
    return out.select("aircraft_id", "timestamp", "reading_id", "prev_temp", "prev_vibration")


@query("rolling_rows", O.with_(O.SENSOR) + """
SELECT aircraft_id, "timestamp", reading_id,
       round(avg(engine_temp) OVER w, 6) AS avg_temp_7r,
       round(avg(oil_pressure) OVER w, 6) AS avg_oil_7r
FROM sensor
WINDOW w AS (PARTITION BY aircraft_id ORDER BY "timestamp", reading_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def rolling_rows(spark, sf):
    """W-06: 7-row trailing means."""
    r = D.sensor_readings(spark, sf)
    out = rolling_features(r, ["aircraft_id"], ["timestamp", "reading_id"],
                           avgs={"avg_temp_7r": "engine_temp", "avg_oil_7r": "oil_pressure"},
                           bucket=sensor.day_bucket)
    return _round(out.select("aircraft_id", "timestamp", "reading_id", "avg_temp_7r", "avg_oil_7r"),
                  ["avg_temp_7r", "avg_oil_7r"])


@query("rolling_rows_bucketed", O.with_(O.SENSOR) + """
SELECT aircraft_id, "timestamp", reading_id,
       round(avg(engine_temp) OVER w, 6) AS avg_temp_7r,
       lag(engine_temp, 1) OVER (PARTITION BY aircraft_id ORDER BY "timestamp", reading_id) AS prev_temp
FROM sensor
WINDOW w AS (PARTITION BY aircraft_id ORDER BY "timestamp", reading_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def rolling_rows_bucketed(spark, sf):
    """W-06 through the skew-safe split plan (daily buckets, many tiny parts)."""
    r = D.sensor_readings(spark, sf)
    out = rolling_features(r, ["aircraft_id"], ["timestamp", "reading_id"],
                           lags={"prev_temp": "engine_temp"}, avgs={"avg_temp_7r": "engine_temp"},
                           bucket=sensor.day_bucket)
    return _round(out.select("aircraft_id", "timestamp", "reading_id", "avg_temp_7r", "prev_temp"),
                  ["avg_temp_7r"])


@query("rolling_range", O.with_(O.SENSOR) + """
SELECT aircraft_id, "timestamp", reading_id,
       round(avg(engine_temp) OVER (PARTITION BY aircraft_id ORDER BY CAST(floor(epoch("timestamp")) AS BIGINT)
                                    RANGE BETWEEN 604799 PRECEDING AND CURRENT ROW), 6) AS avg_temp_7d_range
FROM sensor""")
def rolling_range(spark, sf):
    """W-06 with frame='range': a true 7-day time window (K2 option)."""
    r = D.sensor_readings(spark, sf)
    out = rolling_features(r, ["aircraft_id"], ["timestamp"], avgs={"avg_temp_7d_range": "engine_temp"},
                           frame="range", range_col="timestamp", range_seconds=7 * 86400,
                           bucket=sensor.day_bucket)
    return _round(out.select("aircraft_id", "timestamp", "reading_id", "avg_temp_7d_range"),
                  ["avg_temp_7d_range"])


@query("days_since_event", O.with_(*O.E1, O.enriched("LEFT JOIN")) + """
SELECT aircraft_id, "timestamp",
       CAST(date_diff('day', COALESCE(maint_date, DATE '1970-01-01'), CAST("timestamp" AS DATE)) AS INTEGER)
         AS days_since_maint
FROM enr""")
def days_since_event(spark, sf):
    """F-03 with the 1970-01-01 default, exercised by the left as-of join."""
    from ..functions.scalars import days_since
    e = _chain(spark, sf, how="left")["enriched"]
    return e.select("aircraft_id", "timestamp",
                    days_since(F.to_date("timestamp"), "maint_date").cast("int").alias("days_since_maint"))
