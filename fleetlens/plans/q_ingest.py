"""Catalog entries of file ingest, streams, stored tables and component models.

Files are derived from the given tables by Spark and written to the shared
folder first; every entry then reads those files the way production does.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.nested import flatten_json_deep
from ..functions.scalars import parse_date
from ..ml import component_models as CM
from ..ml import model as M
from ..operators import quality as Q
from ..operators.quality import clean
from ..operators.sampling import hash_uniform_sql
from ..sinks import tables as X
from ..sources import driver as D
from ..sources import files
from ..streaming import ingest as I
from ..streaming.expectations import ExpectationLog, totals
from ..streaming.state import features_stream
from . import alerts as A
from . import components as C
from . import oracle as O
from .catalog import query
from .incremental import IncrementalGold
from .q_alerts import RUN_TS, predictions_long
from .q_components import health_frames
from .q_quality import _exp_sql
from .q_sensor import _FEAT_SQL, R6, _round

_TS = "date_trunc('second', CAST({} AS TIMESTAMP))"


def _csv_drop(df, columns, path, times=()):
    """Write ``df`` as header CSV files of text times and ids."""
    cols = [F.date_format(c, S.TS_PATTERN).alias(c) if c in times else F.col(c).cast(t).alias(c) for c, t in columns]
    df.select(*cols).write.option("header", True).csv(path)


def _ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


# ------------------------------------------------------------------ CSV streams
@query("stream_csv_sensor", O.with_(O.SENSOR, O.CLEANED) + f"""
SELECT {_TS.format('"timestamp"')} AS "timestamp", CAST(aircraft_id AS VARCHAR) AS aircraft_id,
       CAST(model AS VARCHAR) AS model, engine_temp, fuel_efficiency, vibration, altitude, airspeed, anomaly_score,
       oil_pressure, engine_rpm, battery_voltage
FROM cleaned""")
def stream_csv_sensor(spark, sf):
    """S-01 / S-12 / X-01 / F-01: sensor CSV files as a stream, cleaned into a sink."""
    loc = I.scratch_location(spark, "csv-sensor")
    _csv_drop(D.sensor_readings(spark, sf), S.RAW_SENSOR_COLS, f"{loc}/raw", ["timestamp"])
    out = I.clean_stream(I.sensor_stream(spark, f"{loc}/raw"))
    I.run_available(out, f"{loc}/sink", f"{loc}/checkpoint")
    return _ntz(spark.read.schema(out.schema).parquet(f"{loc}/sink"), "timestamp")


@query("stream_csv_maintenance", O.with_(O.MAINT) + """
SELECT CAST(aircraft_id AS VARCHAR) AS aircraft_id, maint_date AS event_date, event_type FROM maint""")
def stream_csv_maintenance(spark, sf):
    """S-02: maintenance CSV files as a stream."""
    loc = I.scratch_location(spark, "csv-maintenance")
    _csv_drop(D.maintenance_events(spark, sf), S.MAINTENANCE_COLS, f"{loc}/raw")
    out = I.maintenance_stream(spark, f"{loc}/raw")
    I.run_available(out, f"{loc}/sink", f"{loc}/checkpoint")
    return spark.read.schema(out.schema).parquet(f"{loc}/sink")


def _register_twin_stream(key):
    spec = S.COMPONENTS[key]

    @query(f"stream_csv_{key}", O.with_(*O.comp_ctes([key])) + f"""
SELECT CAST(aircraft_id AS VARCHAR) AS aircraft_id, component_id, {_TS.format('event_timestamp')} AS event_timestamp,
       {O.HEALTH[key][1]}, health_status FROM {key}_health""")
    def _stream(spark, sf):
        loc = I.scratch_location(spark, f"csv-{key}")
        _csv_drop(D.COMPONENT_SOURCES[key](spark, sf), spec.raw_cols, f"{loc}/raw", ["event_timestamp"])
        out = C.health(I.component_stream(spark, spec, f"{loc}/raw"), spec)
        I.run_available(out, f"{loc}/sink", f"{loc}/checkpoint")
        return _ntz(spark.read.schema(out.schema).parquet(f"{loc}/sink"), "event_timestamp")

    _stream.__doc__ = f"S-03 … S-11: {key} CSV files as a stream, with their health status."


for _k in O.COMP_KEYS:
    _register_twin_stream(_k)


# ------------------------------------------------------------ stream → tables
def _events_stream(spark, sf):
    return I.parquet_stream(spark, sf, "events.parquet", D.table(spark, sf, "events").schema)


@query("stream_to_gold", O.with_(*O.E1, O.enriched("JOIN"), O.FEATURES, O.PREDICTIONS, O.ENGINE_VIEW) + """
SELECT aircraft_id, "timestamp", engine_health_status, predicted_anomaly,
       """ + ", ".join(f"round({c}, 6) AS {c}" for c in R6) + " FROM engine_view")
def stream_to_gold(spark, sf):
    """X-03: readings and maintenance arrive as streams in two drops; each
    micro-batch refreshes the gold cells that it touches."""
    gold = _gold_from_streams(spark, sf)
    return _round(gold.engine_view(), R6).select(
        "aircraft_id", "timestamp", "engine_health_status", "predicted_anomaly", *R6)


@query("gold_features_incremental", _FEAT_SQL)
def gold_features_incremental(spark, sf):
    """X-03 / T-02: the gold feature table that those refreshes leave."""
    return _round(_gold_from_streams(spark, sf).table("sensor_features").drop("month", "bucket"), R6)


def _gold_from_streams(spark, sf):
    loc, gold = I.scratch_location(spark, "gold"), None
    for events in _event_drops(spark, sf, loc, drops=2):
        streams = {"maintenance": D.maintenance_events_from(events), "readings": D.sensor_readings_from(events)}
        gold = gold or IncrementalGold(spark, f"{loc}/gold", D.model_reference(spark, sf), streams["readings"].schema,
                                       streams["maintenance"].schema, RUN_TS)
        for kind, stream in streams.items():
            gold.follow(stream, f"{loc}/checkpoint-{kind}", kind)
    return gold


def _event_drops(spark, sf, loc, drops=4):
    """The events written as ``drops`` folders of whole days in order of time;
    yields after each, so that a stream can take it up before the next is there."""
    events = D.table(spark, sf, "events")
    day = F.unix_date(F.to_date("ts"))
    first, last = events.agg(F.min(day), F.max(day)).first()
    if first is None:                                  # an empty table is one empty drop
        first = last = 0
    drop = F.least(F.floor((day - first) * drops / (last - first + 1)), F.lit(drops - 1))
    for k in range(drops):
        events.filter(F.coalesce(drop, F.lit(0)) == k).write.mode("append").parquet(f"{loc}/raw")
        yield I.parquet_stream(spark, f"{loc}/raw", "*.parquet", events.schema)


@query("stream_features", _FEAT_SQL)
def stream_features(spark, sf):
    """X-05 / T-02: lag, 7-row means and latest maintenance from keyed stream
    state, over four drops, the query restarted for each."""
    loc = I.scratch_location(spark, "features")
    for events in _event_drops(spark, sf, loc):
        readings = clean(D.sensor_readings_from(events))[0].join(D.model_reference(spark, sf), "model", "left")
        out = features_stream(readings, D.maintenance_events_from(events))
        I.run_available(out, f"{loc}/sink", f"{loc}/checkpoint")
    rows = spark.read.schema(out.schema).parquet(f"{loc}/sink")
    return _round(rows.filter(~F.col("late")).drop("late"), R6)


@query("stream_expectations", _exp_sql())
def stream_expectations(spark, sf):
    """P-02 / X-02: the counts that a cleaning stream observes, logged per
    micro-batch over three drops and added up."""
    loc = I.scratch_location(spark, "expectations")
    with ExpectationLog(spark, f"{loc}/log") as log:
        for events in _event_drops(spark, sf, loc, drops=3):
            log.wait(I.run_available(I.clean_stream(D.sensor_readings_from(events)), f"{loc}/sink", f"{loc}/checkpoint"))
    return totals(spark, f"{loc}/log").select("expectation", "total_rows", "failed_rows")


@query("stream_latest_state", O.with_(O.SENSOR) + """
SELECT aircraft_id, "timestamp", engine_temp, reading_id FROM (
  SELECT *, row_number() OVER (PARTITION BY aircraft_id ORDER BY "timestamp" DESC, reading_id DESC) AS rn
  FROM sensor) t WHERE rn = 1""")
def stream_latest_state(spark, sf):
    """X-05: a table of the latest reading per aircraft, kept by a stream."""
    loc = I.scratch_location(spark, "latest")
    readings = D.sensor_readings_from(_events_stream(spark, sf)).select(
        "aircraft_id", "timestamp", "engine_temp", "reading_id")
    I.latest_state_stream(readings, f"{loc}/table", f"{loc}/checkpoint", ["aircraft_id"], ["timestamp", "reading_id"])
    return X.read_current(spark, f"{loc}/table")


# -------------------------------------------------------------- files, tables
@query("malformed_rows", """
SELECT count(*) AS row_count, count(*) FILTER (WHERE o_orderstatus = 'P') AS event_date_malformed FROM orders""")
def malformed_rows(spark, sf):
    """F-01 / K4: texts that do not parse become NULL and are counted."""
    o = D.table(spark, sf, "orders")
    text = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    return Q.malformed_counts(o.select(text.alias("event_date")), {"event_date": parse_date("event_date")})


@query("header_report", """
SELECT month(o_orderdate) % 4 <> 0 AS matches, count(DISTINCT strftime(o_orderdate, '%Y-%m')) AS files
FROM orders GROUP BY 1""")
def header_report(spark, sf):
    """P-19: CSV drops, one a month, whose header has the expected columns;
    in every fourth month two of them are swapped."""
    loc = I.scratch_location(spark, "headers")
    names = ["o_orderkey", "o_custkey", "o_totalprice"]
    o = D.table(spark, sf, "orders").select(*names, F.date_format("o_orderdate", "yyyy-MM").alias("drop"),
                                            (F.month("o_orderdate") % 4 == 0).alias("swapped"))
    for swapped, cols in ((False, names), (True, [names[1], names[0], names[2]])):
        (o.filter(F.col("swapped") == swapped).select(*cols, "drop").repartition("drop").write.mode("append")
         .option("header", True).partitionBy("drop").csv(f"{loc}/raw"))
    report = files.header_report(spark, f"{loc}/raw/*", names)
    return report.groupBy("matches").agg(F.count(F.lit(1)).alias("files"))


@query("batch_append", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CASE WHEN o_orderstatus = 'P' THEN 'second' ELSE 'first' END AS batch_id FROM orders""")
def batch_append(spark, sf):
    """O-02: two batches appended; a batch id that is there already is refused."""
    loc = I.scratch_location(spark, "append")
    o = D.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    X.append_batch(spark, o.filter("o_orderstatus <> 'P'"), f"{loc}/t", "first", partition_by=())
    X.append_batch(spark, o.filter("o_orderstatus = 'P'"), f"{loc}/t", "second", partition_by=())
    try:
        X.append_batch(spark, o, f"{loc}/t", "first", partition_by=())
    except ValueError:
        return spark.read.parquet(f"{loc}/t").select(*o.columns, "batch_id")
    raise RuntimeError("a repeated batch was appended")


_ABSENT = ("ENG", "FS")


@query("mart_missing_tables", O.with_(*O.mart_ctes()) + "SELECT * FROM unified WHERE component_id NOT IN ('ENG', 'FS')")
def mart_missing_tables(spark, sf):
    """S-16 / T-13: one alert table per component, of which some do not exist."""
    loc = I.scratch_location(spark, "mart")
    alerts = A.alerts_from_predictions(predictions_long(spark, sf), RUN_TS)
    alerts.filter(~F.col("component_id").isin(*_ABSENT)).write.partitionBy("component_id").parquet(f"{loc}/alerts")
    schema = T.StructType([f for f in alerts.schema.fields if f.name != "component_id"])
    tables = {cid: files.read_path_or_empty(spark, f"{loc}/alerts/component_id={cid}", schema)
              for _, cid, _ in S.ALERT_COMPONENTS}
    return A.unify_alert_tables(spark, tables, RUN_TS)


@query("flatten_nested", """
SELECT event_id, config_key, config_value FROM (
  SELECT event_id, unnest(['id', 'env.name', 'limits.k', 'limits.range.user']) AS config_key,
         unnest([CAST(event_id AS VARCHAR), event_type, json_extract_string(props, '$.k'),
                 CAST(user_id AS VARCHAR)]) AS config_value
  FROM events) t""")
def flatten_nested(spark, sf):
    """F-10: nested JSON objects flattened to dotted keys."""
    e = D.table(spark, sf, "events")
    text = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("id"), F.struct(F.col("event_type").alias("name")).alias("env"),
        F.struct(F.get_json_object("props", "$.k").alias("k"),
                 F.struct(F.col("user_id").cast("string").alias("user")).alias("range")).alias("limits")))
    return flatten_json_deep(e.select("event_id", text.alias("config")), ["event_id"], "config")


@query("date_shift_random", f"""
SELECT o_orderkey, o_orderdate + to_days(CAST(floor({hash_uniform_sql('o_orderkey', 42)} * 31) AS INTEGER)) AS o_orderdate
FROM orders""")
def date_shift_random(spark, sf):
    """O-11 / F-07: dates shifted by a seeded random number of days."""
    return X.random_shift(D.table(spark, sf, "orders"), ["o_orderdate"], "o_orderkey", 30, 42).select(
        "o_orderkey", "o_orderdate")


# ------------------------------------------------------------ component models
@query("model_component_scores", O.with_(*O.comp_ctes(O.COMP_KEYS)) + "\nUNION ALL\n".join(
    f"SELECT '{k}' AS component, aircraft_id, component_id, event_timestamp, health_status, TRUE AS in_range "
    f"FROM {k}_health" for k in O.COMP_KEYS))
def model_component_scores(spark, sf):
    """M-11: a forest per twin, fitted on its rows and applied to all of them
    (the prediction itself is checked for its range only)."""
    frames = health_frames(spark, sf)
    models = M.train_component_models(frames, S.COMPONENTS, num_trees=10)
    scored = M.score_components(frames, models)
    return scored.withColumn("in_range", F.col("predicted_anomaly").isin(0, 1)).drop("predicted_anomaly")


def _held_out_sql(k: str) -> str:
    held = "CAST(round(n1 * CAST(0.3 AS DOUBLE)) AS BIGINT)"
    return f"""SELECT '{k}' AS component, CASE WHEN fitted THEN n ELSE 0 END AS scored_rows,
       CAST(round((n - n1) * CAST(0.3 AS DOUBLE)) AS BIGINT) + {held} AS held_out_rows, {held} AS held_out_anomalies,
       fitted AS recorded, TRUE AS alerts_match
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE health_status <> 'NOMINAL') AS n1,
             count(DISTINCT health_status <> 'NOMINAL') = 2 AS fitted FROM {k}_health) t"""


@query("model_component_mart", O.with_(*O.comp_ctes(O.COMP_KEYS)) + "\nUNION ALL\n".join(map(_held_out_sql, O.COMP_KEYS)))
def model_component_mart(spark, sf):
    """M-11 → M-12 → T-13: twins split, fitted, scored and registered; per twin
    the rows scored and held out, whether the registry holds the precision and
    recall of the written held-out predictions, and whether the mart has
    exactly the alerts that the predictions raise."""
    loc = I.scratch_location(spark, "component-models")
    CM.train_all(spark, health_frames(spark, sf), loc, version=1, num_trees=10)
    preds = CM.predictions(spark, loc, 1)
    held, y, p = F.col("is_test"), F.col("label"), F.col("predicted_anomaly")
    per = preds.groupBy("component").agg(
        F.count(p).alias("scored_rows"), F.count_if(held).alias("held_out_rows"),
        F.count_if(held & (y == 1)).alias("held_out_anomalies"), F.count_if(p == 1).alias("raised"),
        F.count_if(held & (y == 1) & (p == 1)).alias("tp"), F.count_if(held & (y == 0) & (p == 1)).alias("fp"))
    registry = spark.read.parquet(f"{loc}/registry").select(
        F.substring("model", len(CM.model_name("")) + 1, 99).alias("component"), "precision", "recall")
    mart = A.traceability_from_predictions(CM.predictions_long(preds), spark, RUN_TS)
    ids = F.create_map(*[F.lit(x) for k, s in S.COMPONENTS.items() for x in (s.alert_id, k)])
    alerts = mart.groupBy(ids[F.col("component_id")].alias("component")).agg(F.count(F.lit(1)).alias("alerts"))

    def same(got, part, whole):
        return F.abs(F.col(got) - F.when(whole > 0, part / whole).otherwise(0.0)) < 1e-12

    return (per.join(registry, "component", "left").join(alerts, "component", "left")
            .select("component", "scored_rows", "held_out_rows", "held_out_anomalies",
                    F.coalesce(same("precision", F.col("tp"), F.col("tp") + F.col("fp"))
                               & same("recall", F.col("tp"), F.col("held_out_anomalies")), F.lit(False)).alias("recorded"),
                    (F.coalesce("alerts", F.lit(0)) == F.col("raised")).alias("alerts_match")))


@query("model_sensor_keys", O.with_(*O.E1, O.enriched("JOIN"), O.FEATURES) + """
SELECT aircraft_id, "timestamp", anomaly_score, TRUE AS in_range FROM feat WHERE prev_anomaly IS NOT NULL""")
def model_sensor_keys(spark, sf):
    """M-03 … M-10: keys, labels and prediction range of ``rf_score``."""
    from .q_ops import rf_score
    return rf_score(spark, sf).withColumn("in_range", F.col("predicted_anomaly").isin(0, 1)).drop("predicted_anomaly")
