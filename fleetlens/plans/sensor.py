"""Aircraft sensor pipeline E1: T-01 … T-05.

Plan shape: the model-reference join happens at the scan (broadcast when the
reference is bounded); afterwards the as-of join, PK dedupe, lag/rolling
features and the latest-state pick all run on one hash partitioning by
``aircraft_id`` – a single shuffle for the whole chain.

With ``skew_bucket`` (``RangeParts()``, or a time bucket such as ``day_bucket``)
the as-of join and the rolling windows run per (aircraft, part) instead, so an
aircraft holding a large share of all readings is spread across many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.scalars import days_since, risk_label, rule_score
from ..operators.asof import asof_join
from ..operators.joins import ref_join
from ..operators.quality import clean
from ..operators.skew import RangeParts, day_bucket, month_bucket  # noqa: F401
from ..operators.windows import dedupe, latest_by, rolling_features


def cleaned(raw: DataFrame) -> DataFrame:
    """P-01 kept rows."""
    return clean(raw)[0]


def enriched(readings: DataFrame, maintenance: DataFrame, models: DataFrame,
             how: str = "inner", skew_bucket=None) -> DataFrame:
    """T-01: latest maintenance at or before the reading day (J-01/W-01),
    model metadata (J-02), one row per (aircraft_id, timestamp) (W-02)."""
    r = readings.drop("_rescued_data")
    m = maintenance.drop("_rescued_data").withColumnRenamed("event_date", "maint_date")
    tie = ["maint_id"] if "maint_id" in m.columns else ["event_type"]
    r = ref_join(r, models, on="model", how="left")
    j = asof_join(r, m, keys=["aircraft_id"], left_on=F.to_date("timestamp"), right_on="maint_date",
                  right_cols=["maint_date", "event_type"], tie=tie, how=how, bucket=skew_bucket)
    return dedupe(j, ["aircraft_id", "timestamp"])


def sensor_features(enriched_df: DataFrame, skew_bucket=None, frame: str = "rows") -> DataFrame:
    """T-02: casts (P-03), lag of the anomaly flag (W-05), 7-row means (W-06),
    days since maintenance (F-03), fixed projection (P-04)."""
    df = enriched_df.select(
        "*", F.to_date("timestamp").alias("date"))
    casts = {"anomaly_score": "int", "engine_rpm": "int", "battery_voltage": "double",
             "engine_temp": "double", "fuel_efficiency": "double", "vibration": "double",
             "altitude": "double", "airspeed": "double", "oil_pressure": "double",
             "capacity": "int", "range_km": "int"}
    df = df.withColumns({c: F.col(c).cast(t) for c, t in casts.items()})
    # (aircraft_id, timestamp) is unique after T-01, so timestamp is a total order
    df = rolling_features(
        df, keys=["aircraft_id"], order=["timestamp"],
        lags={"prev_anomaly": "anomaly_score"},
        avgs={"avg_engine_temp_7d": "engine_temp", "avg_vibration_7d": "vibration",
              "avg_rpm_7d": "engine_rpm"},
        n=S.ROLLING_ROWS, frame=frame, range_col="timestamp", range_seconds=7 * 86400,
        bucket=skew_bucket)
    df = df.withColumn("prev_anomaly", F.col("prev_anomaly").cast("double")) \
           .withColumn("days_since_maint", days_since("date", "maint_date").cast("int"))
    return df.select(*S.SENSOR_FEATURE_COLS)


def prediction_results(features: DataFrame) -> DataFrame:
    """T-03: R-01 rule score."""
    return features.withColumn("predicted_anomaly", rule_score())


def engine_view(predictions: DataFrame) -> DataFrame:
    """T-04: R-02 label and the latest reading per aircraft (W-03)."""
    df = predictions.withColumn("engine_health_status", risk_label())
    return latest_by(df, ["aircraft_id"], ["timestamp"])


def aircraft_view(engine: DataFrame) -> DataFrame:
    """T-05."""
    return engine.select("aircraft_id", "timestamp", "engine_health_status", "predicted_anomaly")


class SensorChain:
    """The E1 chain with every stage built lazily, once (``chain["features"]``)."""

    STAGES = ("cleaned", "quarantined", "enriched", "features", "predictions", "engine_view", "aircraft_view")

    def __init__(self, readings, maintenance, models, how="inner", skew_bucket=None, training=False):
        self._in = (readings, maintenance, models)
        self._how, self._bucket, self._training = how, skew_bucket, training
        self._built = {}

    def _build(self, stage):
        r, m, mo = self._in
        if stage in ("cleaned", "quarantined"):
            kept, q = clean(r)
            if self._training:
                # K25: the cleaning filter removes every injected anomaly, so
                # labelled training features use kept and quarantined rows
                kept = r
            self._built.update(cleaned=kept, quarantined=q)
            return self._built[stage]
        if stage == "enriched":
            return enriched(self["cleaned"], m, mo, how=self._how, skew_bucket=self._bucket)
        if stage == "features":
            return sensor_features(self["enriched"], skew_bucket=self._bucket)
        if stage == "predictions":
            return prediction_results(self["features"])
        if stage == "engine_view":
            return engine_view(self["predictions"])
        if stage == "aircraft_view":
            return aircraft_view(self["engine_view"])
        raise KeyError(stage)

    def __getitem__(self, stage):
        if stage not in self._built:
            self._built[stage] = self._build(stage)
        return self._built[stage]


def run(readings, maintenance, models, how="inner", skew_bucket=None, training=False) -> SensorChain:
    """Whole E1 chain; stages are built on first access (all lazy DataFrames).
    ``training=True`` computes features over kept + quarantined readings (K25)."""
    return SensorChain(readings, maintenance, models, how=how, skew_bucket=skew_bucket, training=training)
