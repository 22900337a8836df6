"""Component twins E2: T-08 … T-12 generated from ``schemas.COMPONENTS``.

One spec-driven function replaces the nine near-identical per-component
tables of the original.  Everything up to the feature windows is narrow
(map-only); the features shuffle once by aircraft.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.rules import classify
from ..operators.sets import union_by_name
from ..operators.windows import rolling_features


def health(df: DataFrame, spec: S.ComponentSpec) -> DataFrame:
    """T-08: ``health_status`` by the component's rule, id renamed to component_id."""
    return df.select(
        F.col("aircraft_id"), F.col(spec.id_col).alias("component_id"), F.col("event_timestamp"),
        *[F.col(m) for m in spec.metric_names],
        classify(spec.critical, spec.warning).alias("health_status"))


def features(health_df: DataFrame, spec: S.ComponentSpec, keys=("aircraft_id",), n: int = S.ROLLING_ROWS,
             skew_bucket=None) -> DataFrame:
    """T-09 (W-07 … W-15): lags and 7-row means in one window pass.

    Default partition is the aircraft (as the original, K5); pass
    ``keys=("aircraft_id", "component_id")`` for per-component history.
    Rows are totally ordered by timestamp, then component id, then every
    metric, so duplicates of a reading cannot change the result."""
    order = ["event_timestamp", "component_id", *spec.metric_names]
    return rolling_features(health_df, list(keys), order, lags=dict(spec.lags), avgs=dict(spec.avgs),
                            n=n, bucket=skew_bucket)


def component_view(frames: dict) -> DataFrame:
    """T-10 (U-01): health frames tagged with component_type, unioned by name."""
    return union_by_name([df.withColumn("component_type", F.lit(COMP_TYPE[k])) for k, df in frames.items()])


COMP_TYPE = {k: s.component_type for k, s in S.COMPONENTS.items()}


def component_alerts(view: DataFrame) -> DataFrame:
    """T-11: CRITICAL / WARNING rows; alert_timestamp = event_timestamp."""
    return (view.filter(F.col("health_status").isin(S.HEALTH_CRITICAL, S.HEALTH_WARNING))
            .select("aircraft_id", "component_id", "component_type", "health_status",
                    F.col("event_timestamp").alias("alert_timestamp")))


def component_predictions(view: DataFrame) -> DataFrame:
    """K12/K13: one long prediction table for every component, keyed by the
    alert-mart component id; predicted_anomaly = status is not NOMINAL."""
    ids = F.create_map(*[x for k, s in S.COMPONENTS.items()
                         for x in (F.lit(s.component_type), F.lit(s.alert_id))])
    return view.select(
        ids[F.col("component_type")].alias("component_id"),
        F.col("aircraft_id"), F.col("event_timestamp").alias("timestamp"),
        F.col("component_id").alias("source_component_id"), F.col("health_status"),
        (F.col("health_status") != S.HEALTH_NOMINAL).cast("int").alias("predicted_anomaly"))
