"""Scalar column builders (F-01 … F-10, R-01, R-02, R-12, R-13, R-15).

All return ``Column`` expressions built from ``pyspark.sql.functions`` so they
stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S


def col_or(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c, pattern: str = S.TS_PATTERN) -> Column:
    """F-01: tolerant timestamp parse; malformed text becomes NULL (K4)."""
    return F.try_to_timestamp(col_or(c), F.lit(pattern))


def parse_date(c) -> Column:
    """F-02 on text input: malformed dates become NULL instead of failing the job."""
    return F.try_to_date(col_or(c), "yyyy-MM-dd")


def typed_null(dtype) -> Column:
    """P-07: a NULL of a real type (a bare ``lit(None)`` is ``void``)."""
    return F.lit(None).cast(dtype)


def days_since(day, event_date, default: str = S.EPOCH_DEFAULT_DATE) -> Column:
    """F-03: ``datediff(day, coalesce(event_date, default))``."""
    return F.datediff(col_or(day), F.coalesce(col_or(event_date), F.to_date(F.lit(default))))


def trace_id(aircraft, component, ts) -> Column:
    """F-05: ``{aircraft}_{component}_{yyyyMMdd_HHmmss}`` (not unique; lookup only)."""
    return F.concat(col_or(aircraft).cast("string"), F.lit("_"), col_or(component).cast("string"),
                    F.lit("_"), F.date_format(col_or(ts), S.TRACE_TS_PATTERN))


def batch_id(run_ts) -> Column:
    """F-09: batch id ``yyyyMMdd_HHmmss`` of the run time (passed in, F-06)."""
    return F.date_format(F.lit(run_ts).cast("timestamp"), S.TRACE_TS_PATTERN)


def rule_score(avg_temp="avg_engine_temp_7d", avg_vib="avg_vibration_7d",
               prev="prev_anomaly", days="days_since_maint", params=None) -> Column:
    """R-01: the simulated aircraft model; NULL ``prev`` gives NULL."""
    p = {**S.RULE_SCORE, **(params or {})}
    score = ((col_or(avg_temp) / p["temp_div"] + col_or(avg_vib) / p["vib_div"]) * p["sensor_w"]
             + col_or(prev) * p["prev_w"]
             + (col_or(days) / p["days_div"]) * p["days_w"])
    return (score.cast("double") > p["cut"]).cast("int")


def risk_label(pred="predicted_anomaly") -> Column:
    """R-02: 1 → HIGH_RISK, anything else (NULL included) → NORMAL."""
    return F.when(col_or(pred) == 1, S.RISK_HIGH).otherwise(S.RISK_NORMAL)


def alert_severity(pred="predicted_anomaly") -> Column:
    """R-12."""
    return F.when(col_or(pred) == 1, S.SEVERITY_HIGH).otherwise(S.SEVERITY_LOW)


def alert_category(component_id="component_id") -> Column:
    """R-13."""
    c = col_or(component_id)
    return (F.when(c.isin(*S.CATEGORY_CRITICAL_IDS), "CRITICAL")
            .when(c.isin(*S.CATEGORY_SAFETY_IDS), "SAFETY")
            .otherwise("OPERATIONAL"))


def health_score(status="health_status") -> Column:
    """R-15 helper: numeric score of a health status (our definition)."""
    c = col_or(status)
    expr = None
    for k, v in S.STATUS_SCORE.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr.otherwise(F.lit(None).cast(T.DoubleType()))


def health_band(score) -> Column:
    """R-15: ≥80 healthy, 60–80 warning, <60 critical."""
    c = col_or(score)
    return (F.when(c >= S.BAND_HEALTHY, "HEALTHY").when(c >= S.BAND_WARNING, "WARNING")
            .when(c.isNotNull(), "CRITICAL"))


def json_number(c, key: str) -> Column:
    """Numeric field of a JSON text column (``{"k": n}``) as double."""
    return F.get_json_object(col_or(c), f"$.{key}").cast("double")
