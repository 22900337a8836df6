"""Data-quality operators (P-01, P-02, P-09 … P-17).

Every report is one aggregation pass per input table; multi-table reports are
assembled from long (metric, value) rows and pivoted into one row, so no
cartesian products appear in the plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S


def clean_condition(rules=None):
    r = {**S.CLEAN_RULES, **(rules or {})}
    return ((F.col("engine_temp") <= r["max_engine_temp"])
            & (F.col("fuel_efficiency") >= r["min_fuel_efficiency"])
            & (F.col("vibration") <= r["max_vibration"]))


def clean(df: DataFrame, condition=None):
    """P-01: split into (kept, quarantined); a NULL operand fails the filter.

    Both are lazy filters of the same input (streaming-safe)."""
    cond = clean_condition() if condition is None else condition
    ok = F.coalesce(cond, F.lit(False))
    return df.filter(ok), df.filter(~ok)


def _expectation_cols(expectations):
    return {name: F.coalesce(F.expr(sql), F.lit(False)) for name, sql in expectations.items()}


def observe_expectations(df: DataFrame, expectations=None, name="expectations"):
    """P-02 (warn-only): rows pass through; violation counts are reported as
    observed metrics of the query.  ``name`` is a string (streaming: metrics
    appear in the query progress) or a ``pyspark.sql.Observation`` (batch:
    ``observation.get`` after the first action).  Note: on Spark 4.1 a batch
    ``Observation`` leaves the session unable to serialize some later Spark ML
    tasks (``ObservationManager`` is not serializable); prefer the string
    form in sessions that also train models."""
    exps = _expectation_cols(expectations or S.EXPECTATIONS)
    return df.observe(name, F.count(F.lit(1)).alias("rows"),
                      *[F.count_if(~c).alias(n) for n, c in exps.items()])


def expectation_report(df: DataFrame, expectations=None) -> DataFrame:
    """P-02 as a table: (expectation, total_rows, failed_rows), one scan."""
    exps = _expectation_cols(expectations or S.EXPECTATIONS)
    agg = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(~c).alias(n) for n, c in exps.items()])
    stack = ", ".join(f"'{n}', `{n}`" for n in exps)
    return agg.selectExpr(f"stack({len(exps)}, {stack}) AS (expectation, failed_rows)", "__n AS total_rows") \
        .select("expectation", "total_rows", "failed_rows")


def null_profile(df: DataFrame, cols=None, prefix: str = "") -> DataFrame:
    """P-12: one row, ``{prefix}{c}_nulls`` per column."""
    cols = cols or df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{prefix}{c}_nulls") for c in cols])


def range_violations(df: DataFrame, condition=None, name: str = "out_of_range") -> DataFrame:
    """P-11: count of rows matching a violation predicate (default sensor rule)."""
    cond = condition if condition is not None else (
        (F.col("engine_temp") > 1000) | (F.col("engine_temp") < 0) | (F.col("vibration") < 0))
    return df.agg(F.count_if(F.coalesce(cond, F.lit(False))).alias(name))


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """P-13 listing: keys that occur more than once, with their count."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_count")).filter("dup_count > 1")


def duplicate_key_count(df: DataFrame, keys, name: str = "duplicate_pk") -> DataFrame:
    """P-13 summary: number of keys occurring more than once."""
    return duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias(name))


def null_key_count(df: DataFrame, keys, name: str = "null_keys") -> DataFrame:
    """P-14."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cond = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return df.agg(F.count_if(cond).alias(name))


def drop_null_keys(df: DataFrame, keys) -> DataFrame:
    """P-09."""
    return df.dropna(subset=[keys] if isinstance(keys, str) else list(keys))


def validate_not_null(df: DataFrame, keys, label: str = "check") -> DataFrame:
    """P-16: CHECK (keys NOT NULL) enforced row by row; the job fails on a violation."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    ok = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    # a filter predicate is always evaluated (a dropped column would be pruned)
    return df.filter(F.when(ok, F.lit(True)).otherwise(
        F.raise_error(F.lit(f"CHECK constraint {label} violated: NULL in {keys}")).cast("boolean")))


def row_counts(tables: dict) -> DataFrame:
    """P-15: (table_name, row_count) for many frames, one union job."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def metrics_long(df_one_row: DataFrame) -> DataFrame:
    """One-row frame → (metric, value) rows with value as bigint."""
    cols = df_one_row.columns
    stack = ", ".join(f"'{c}', CAST(`{c}` AS BIGINT)" for c in cols)
    return df_one_row.selectExpr(f"stack({len(cols)}, {stack}) AS (metric, value)")


def one_row(long_df: DataFrame, metrics) -> DataFrame:
    """(metric, value) rows → a single wide row with a fixed column list."""
    return long_df.agg(*[F.coalesce(F.max(F.when(F.col("metric") == m, F.col("value"))), F.lit(0))
                         .cast(T.LongType()).alias(m) for m in metrics])


def one_row_sum(long_df: DataFrame, metrics) -> DataFrame:
    """(metric, value) rows → one wide row, summing repeated metrics."""
    return long_df.agg(*[F.expr(f"CAST(coalesce(sum(CASE WHEN metric = '{m}' THEN value END), 0) AS BIGINT) "
                                f"AS `{m}`") for m in metrics])


def sanity_row(sensor: DataFrame, twins: dict, component_alerts: DataFrame | None = None,
               sensor_cols=("timestamp", "aircraft_id", "engine_temp", "fuel_efficiency", "vibration"),
               statuses=(S.HEALTH_CRITICAL, S.HEALTH_WARNING), specs=None,
               check_time: str | None = None) -> DataFrame:
    """P-17: one wide row of nulls, counts, range violations, duplicate PKs and
    alert counts per status (statuses pivoted to columns, K19), and the time of
    the check if given (F-06).

    The sensor frame is reduced to one row per key first, which carries its
    counts, so duplicates and all other figures come from one evaluation.

    With ``component_alerts=None`` the alert counts are taken in the same
    aggregation pass as each twin's NULL counts (health rule applied inline,
    ``specs[prefix]``), so every twin source is scanned once."""
    parts, names = [], []

    def add(one):
        parts.append(metrics_long(one))
        names.extend(one.columns)

    outside = F.coalesce((F.col("engine_temp") > 1000) | (F.col("engine_temp") < 0) | (F.col("vibration") < 0),
                         F.lit(False))
    figures = [*(f"sensor_{c}_nulls" for c in sensor_cols), "sensor_out_of_range", "sensor_row_count"]
    per_key = sensor.groupBy("aircraft_id", "timestamp").agg(
        *[F.count_if(F.col(c).isNull()).alias(f"sensor_{c}_nulls") for c in sensor_cols],
        F.count_if(outside).alias("sensor_out_of_range"), F.count(F.lit(1)).alias("sensor_row_count"))
    add(per_key.agg(*[F.sum(c).alias(c) for c in figures],
                    F.count_if(F.col("sensor_row_count") > 1).alias("sensor_duplicate_pk")))
    alert_names = [f"component_alerts_{s.lower()}" for s in statuses]
    for prefix, df in twins.items():
        extra = []
        if component_alerts is None:
            from ..functions.rules import classify
            spec = specs[prefix]
            st = classify(spec.critical, spec.warning)
            extra = [F.count_if(st == s_).alias(f"__{prefix}_{s_}") for s_ in statuses]
        one = df.agg(*[F.expr(f"count_if(`{c}` IS NULL) AS `{prefix}_{c}_nulls`") for c in df.columns],
                     F.count(F.lit(1)).alias(f"{prefix}_row_count"), *extra)
        parts.append(metrics_long(one).withColumn("metric", F.regexp_replace(
            "metric", f"^__{prefix}_(.*)$", "component_alerts_$1")))
        names.extend(c for c in one.columns if not c.startswith("__"))
    names.extend(alert_names)
    if component_alerts is not None:
        parts.append(component_alerts.groupBy("health_status").agg(F.count(F.lit(1)).alias("value"))
                     .select(F.concat(F.lit("component_alerts_"), F.col("health_status")).alias("metric"),
                             "value"))
    long_df = reduce(DataFrame.unionByName, parts).withColumn(
        "metric", F.when(F.col("metric").startswith("component_alerts_"),
                         F.lower("metric")).otherwise(F.col("metric")))
    row = one_row_sum(long_df, names)
    return row if check_time is None else row.withColumn("check_time", F.lit(check_time).cast("timestamp_ntz"))


def profile(df: DataFrame, sample_rows: int = 5):
    """P-18: (one-row frame of row count + per-column NULL counts, a small
    sample).  Both stay lazy; the sample is a bounded ``limit``."""
    stats = df.agg(F.count(F.lit(1)).alias("row_count"),
                   *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in df.columns])
    return stats, df.limit(sample_rows)


def malformed_counts(raw: DataFrame, parsed: dict) -> DataFrame:
    """K4: row count and, per text column, the texts that do not parse
    (``parsed``: column → parsed expression, NULL where malformed)."""
    return raw.agg(F.count(F.lit(1)).alias("row_count"),
                   *[F.count_if(F.col(c).isNotNull() & p.isNull()).alias(f"{c}_malformed") for c, p in parsed.items()])
