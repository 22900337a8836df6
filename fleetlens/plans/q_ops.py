"""Catalog entries of joins, aggregates, ML, sinks and streaming operators."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.nested import flatten_json_kv
from ..functions.scalars import rule_score
from ..ml import model as M
from ..operators.joins import mapped_keys, ref_join, unmapped_keys
from ..ml import drift as DR
from ..operators import distinct as DC
from ..operators.skew import day_bucket
from ..session import ensure_checkpoint_dir, stored
from ..operators.sampling import hash_uniform_sql, sample_n, stratified_split
from ..operators.windows import rolling_features
from ..sinks import tables as X
from ..sources import driver as D
from . import components as C
from . import oracle as O
from .catalog import query
from .q_components import view
from .q_sensor import _chain, _inputs

E1F = [*O.E1, O.enriched("JOIN"), O.FEATURES]


def _r(df, cols, d=6):
    return df.withColumns({c: F.round(c, d) for c in cols})


# ------------------------------------------------------------------ joins
@query("ref_join_left", O.with_(O.SENSOR, O.MODELS) + """
SELECT s.aircraft_id, s."timestamp", s.reading_id, m.manufacturer, m.capacity
FROM sensor s LEFT JOIN models m ON m.model = s.model""")
def ref_join_left(spark, sf):
    """J-02: readings ⟕ model reference (AQE picks broadcast when small)."""
    j = ref_join(D.sensor_readings(spark, sf), D.model_reference(spark, sf), on="model", how="left")
    return j.select("aircraft_id", "timestamp", "reading_id", "manufacturer", "capacity")


@query("unmapped_keys", """
SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = o.o_custkey)""")
def unmapped_keys_q(spark, sf):
    """J-12: scheduled aircraft without any telemetry (anti join)."""
    return unmapped_keys(D.table(spark, sf, "orders"), D.table(spark, sf, "events"), "o_custkey", "user_id")


@query("mapped_keys", """
SELECT * FROM orders o WHERE EXISTS (SELECT 1 FROM events e WHERE e.user_id = o.o_custkey)""")
def mapped_keys_q(spark, sf):
    """J-13: scheduled aircraft that do have telemetry (semi join)."""
    return mapped_keys(D.table(spark, sf, "orders"), D.table(spark, sf, "events"), "o_custkey", "user_id")


@query("point_in_time_lookup", O.with_(O.SENSOR, O.MAINT) + """,
feat AS (SELECT aircraft_id, "timestamp",
                avg(engine_temp) OVER (PARTITION BY aircraft_id ORDER BY "timestamp", reading_id
                                       ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS avg_temp_7r FROM sensor),
lab AS (SELECT e.user_id AS aircraft_id, e.ts, e.event_id FROM events e WHERE e.event_type = 'signup')
SELECT aircraft_id, ts, event_id, feature_ts, round(avg_temp_7r, 6) AS avg_temp_7r FROM (
  SELECT l.*, f."timestamp" AS feature_ts, f.avg_temp_7r,
         row_number() OVER (PARTITION BY l.event_id ORDER BY f."timestamp" DESC NULLS LAST) AS rn
  FROM lab l LEFT JOIN feat f ON f.aircraft_id = l.aircraft_id AND f."timestamp" <= l.ts) t WHERE rn = 1""")
def point_in_time_lookup(spark, sf):
    """J-10: for each maintenance event, the latest rolling feature at or before it."""
    r = D.sensor_readings(spark, sf)
    feats = rolling_features(r, ["aircraft_id"], ["timestamp", "reading_id"], avgs={"avg_temp_7r": "engine_temp"},
                             bucket=day_bucket)
    labels = D.table(spark, sf, "events").filter(F.col("event_type") == "signup").select(
        F.col("user_id").alias("aircraft_id"), "ts", "event_id")
    out = M.point_in_time(labels, feats, "aircraft_id", "ts", "timestamp", ["avg_temp_7r"],
                          tie=["reading_id"], bucket=day_bucket)
    return _r(out, ["avg_temp_7r"])


_TRAIN_FEATS = ["avg_engine_temp_7d", "avg_vibration_7d", "prev_anomaly", "days_since_maint"]


_LOOKUP_SQL = O.with_(*E1F) + f"""
SELECT s.aircraft_id, s."timestamp", CAST(s.anomaly_score AS INTEGER) AS label,
       {', '.join((f'round(f.{c}, 6) AS {c}' if c.startswith('avg_') else f'f.{c}') for c in _TRAIN_FEATS)}
FROM sensor s LEFT JOIN feat f ON f.aircraft_id = s.aircraft_id AND f."timestamp" = s."timestamp"
WHERE {' AND '.join(f'f.{c} IS NOT NULL' for c in _TRAIN_FEATS)}"""


@query("feature_lookup", _LOOKUP_SQL)
def feature_lookup(spark, sf):
    """J-09 / M-01 / P-10: label rows ⟕ feature table on (aircraft, timestamp), NULLs dropped."""
    labels = D.sensor_readings(spark, sf).select("aircraft_id", "timestamp",
                                                 F.col("anomaly_score").cast("int").alias("label"))
    ts = M.training_set(labels, _chain(spark, sf)["features"], ["aircraft_id", "timestamp"], _TRAIN_FEATS, "label")
    return _r(ts, ["avg_engine_temp_7d", "avg_vibration_7d"])


@query("feature_lookup_bucketed", _LOOKUP_SQL)
def feature_lookup_bucketed(spark, sf):
    """J-09 / O-06: the same look-up from a stored feature table bucketed by its keys."""
    name = f"features_{uuid.uuid4().hex}"
    keys = ["aircraft_id", "timestamp"]
    X.write_bucketed(_chain(spark, sf)["features"].select(*keys, *_TRAIN_FEATS), name,
                     f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}", keys, 16)
    labels = D.sensor_readings(spark, sf).select(*keys, F.col("anomaly_score").cast("int").alias("label"))
    ts = M.training_set(labels, spark.table(name), keys, _TRAIN_FEATS, "label")
    return _r(ts, ["avg_engine_temp_7d", "avg_vibration_7d"])


# ------------------------------------------------------------- aggregates
@query("conditional_counts", """
SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS healthy,
       count(*) FILTER (WHERE o_orderstatus = 'O') AS warning, count(*) FILTER (WHERE o_orderstatus = 'P') AS critical
FROM orders GROUP BY o_orderpriority""")
def conditional_counts(spark, sf):
    """A-13: SUM(CASE …) style counts."""
    s = F.col("o_orderstatus")
    return D.table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.count_if(s == "F").alias("healthy"), F.count_if(s == "O").alias("warning"),
        F.count_if(s == "P").alias("critical"))


@query("label_distribution", "SELECT quality, count(*) AS n FROM labels GROUP BY quality")
def label_distribution(spark, sf):
    """A-10."""
    return D.table(spark, sf, "labels").groupBy("quality").agg(F.count(F.lit(1)).alias("n"))


@query("distinct_per_group", "SELECT event_type, count(DISTINCT user_id) AS aircraft FROM events GROUP BY event_type")
def distinct_per_group(spark, sf):
    """A-08."""
    return D.table(spark, sf, "events").groupBy("event_type").agg(F.count_distinct("user_id").alias("aircraft"))


@query("date_range", "SELECT min(ts) AS first_reading, max(ts) AS last_reading FROM events")
def date_range(spark, sf):
    """A-09."""
    return D.table(spark, sf, "events").agg(F.min("ts").alias("first_reading"), F.max("ts").alias("last_reading"))


@query("event_breakdown", O.with_(O.MAINT) + "SELECT event_type, count(*) AS events FROM maint GROUP BY event_type")
def event_breakdown(spark, sf):
    """A-12."""
    return D.maintenance_events(spark, sf).groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


@query("whole_table_distinct", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def whole_table_distinct(spark, sf):
    """A-14."""
    return D.table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query("records_per_type", O.with_(*O.comp_ctes(O.COMP_KEYS), O.comp_view()) + """
SELECT aircraft_id, component_type, count(*) AS records FROM comp_view GROUP BY ALL""")
def records_per_type(spark, sf):
    """A-05."""
    return view(spark, sf).groupBy("aircraft_id", "component_type").agg(F.count(F.lit(1)).alias("records"))


@query("alerts_per_status", O.with_(*O.comp_ctes(O.COMP_KEYS), O.comp_view(), O.COMP_ALERTS) + """
SELECT aircraft_id, health_status, count(*) AS alerts FROM comp_alerts GROUP BY ALL""")
def alerts_per_status(spark, sf):
    """A-06."""
    return C.component_alerts(view(spark, sf)).groupBy("aircraft_id", "health_status").agg(
        F.count(F.lit(1)).alias("alerts"))


@query("group_avg_topk", O.with_(O.SENSOR) + """
SELECT aircraft_id, round(avg(engine_temp), 6) AS avg_temp FROM sensor WHERE anomaly_score = 0
GROUP BY aircraft_id ORDER BY avg(engine_temp) DESC, aircraft_id LIMIT 10""")
def group_avg_topk(spark, sf):
    """A-11: average temperature of normal readings, hottest 10 aircraft."""
    r = D.sensor_readings(spark, sf).filter(F.col("anomaly_score") == 0)
    g = r.groupBy("aircraft_id").agg(F.avg("engine_temp").alias("avg_temp"))
    return _r(g.orderBy(F.col("avg_temp").desc(), "aircraft_id").limit(10), ["avg_temp"])


# ------------------------------------------------------------------- ML
@query("confusion_matrix", """
SELECT quality AS label, count(*) FILTER (WHERE toxic = 0) AS pred_0, count(*) FILTER (WHERE toxic = 1) AS pred_1
FROM labels GROUP BY quality""")
def confusion_matrix(spark, sf):
    """M-06 (labels: quality as truth, toxic as prediction)."""
    return M.confusion_matrix(D.table(spark, sf, "labels"), "quality", "toxic")


_PRF_SQL = """
SELECT tp, fp, fn, tn, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END, 6) AS f1
FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall
      FROM (SELECT count(*) FILTER (WHERE {y} = 1 AND {p} = 1) AS tp, count(*) FILTER (WHERE {y} = 0 AND {p} = 1) AS fp,
                   count(*) FILTER (WHERE {y} = 1 AND {p} = 0) AS fn, count(*) FILTER (WHERE {y} = 0 AND {p} = 0) AS tn
            FROM {src}) c) m"""


@query("precision_recall_f1", _PRF_SQL.format(y="quality", p="toxic", src="labels"))
def precision_recall_f1(spark, sf):
    """M-05."""
    return _r(M.precision_recall_f1(D.table(spark, sf, "labels"), "quality", "toxic"), ["precision", "recall", "f1"])


_CUTS = (0.4, 0.5, 0.6)


def _champion_sql():
    score = ("((avg_engine_temp_7d / 700.0) + (avg_vibration_7d / 25.0)) * 0.5 + prev_anomaly * 0.3 "
             "+ (days_since_maint / 100.0) * 0.2")
    parts = []
    for i, c in enumerate(_CUTS):
        src = (f"(SELECT anomaly_score AS y, CAST(CAST({score} AS DOUBLE) > {c} AS INTEGER) AS p "
               f"FROM feat WHERE prev_anomaly IS NOT NULL)")
        parts.append(f"SELECT 'aircraft_rule' AS model, {i + 1} AS version, f1 FROM ("
                     + _PRF_SQL.format(y="y", p="p", src=src) + ") x")
    reg = "\nUNION ALL\n".join(parts)
    return (O.with_(*E1F) + "SELECT model, version AS champion_version, f1 FROM (SELECT *, row_number() OVER "
            "(PARTITION BY model ORDER BY f1 DESC, version DESC) AS rn FROM (" + reg + ") r) t WHERE rn = 1")


def _versions(spark, sf):
    """Metrics of the rule model at each cut-off, from one pass over the features."""
    feats = _chain(spark, sf)["features"].filter(F.col("prev_anomaly").isNotNull())
    return M.metrics_by_version(feats, "anomaly_score", {
        i + 1: rule_score(params={"cut": c}) for i, c in enumerate(_CUTS)}, "aircraft_rule")


@query("champion_select", _champion_sql())
def champion_select(spark, sf):
    """M-07 … M-09: versions of the rule model (cut 0.4 / 0.5 / 0.6) evaluated
    against the anomaly label; the registry row with the best F1 is champion."""
    m = _versions(spark, sf).withColumns({"path": F.lit(""), "f1": F.round("f1", 6)})
    return M.champion(m).select("model", "champion_version", "f1")


_REF_END = "2024-01-11"


_DRIFT = ["engine_temp", "vibration", "anomaly_score"]


def _drift_sql():
    """Figures of the unrounded values, written out per feature."""
    def figures(c):
        return (f"avg({c}) AS m, stddev_samp({c}) AS s, quantile_disc({c}, 0.5) AS q5, quantile_disc({c}, 0.95) AS q9")
    parts = [f"""SELECT day, c."rows", '{f}' AS feature, round(c.m, 6) AS mean, round(c.s, 6) AS stddev,
       round(c.q5, 6) AS p50, round(c.q9, 6) AS p95, round(r.m, 6) AS ref_mean, round(r.s, 6) AS ref_stddev,
       round(r.q5, 6) AS ref_p50, round(r.q9, 6) AS ref_p95, round((c.m - r.m) / r.s, 6) AS shift
FROM (SELECT CAST("timestamp" AS DATE) AS day, count(*) AS "rows", {figures(f)} FROM sensor
      WHERE "timestamp" >= TIMESTAMP '{_REF_END}' GROUP BY ALL) c,
     (SELECT {figures(f)} FROM sensor WHERE "timestamp" < TIMESTAMP '{_REF_END}') r""" for f in _DRIFT]
    return O.with_(O.SENSOR) + "\nUNION ALL\n".join(parts)


@query("drift_report", _drift_sql())
def drift_report(spark, sf):
    """M-13: per day after the reference window, each feature's mean, stddev
    and quantiles against those of the window, from stored daily sketches."""
    r = D.sensor_readings(spark, sf).withColumn("day", F.to_date("timestamp"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/drift-{uuid.uuid4().hex}"
    DR.feature_sketches(r, "day", _DRIFT).write.parquet(path)
    d = DR.drift_report(spark.read.parquet(path), "day", F.col("day") < F.lit(_REF_END).cast("date"))
    return _r(d, [c for c in d.columns if c not in ("day", "rows", "feature")])


@query("alert_distinct_windows", O.with_(*O.mart_ctes()) + """,
d AS (SELECT DISTINCT component_id, alert_date FROM unified),
a AS (SELECT component_id, alert_date, aircraft_id, count(*) AS c FROM unified GROUP BY ALL)
SELECT d.component_id, d.alert_date AS window_end, CAST(w.days AS INTEGER) AS days, CAST(sum(a.c) AS BIGINT) AS "rows",
       count(DISTINCT a.aircraft_id) AS affected_aircraft
FROM d, (VALUES (7), (30)) w(days), a
WHERE a.component_id = d.component_id AND a.alert_date BETWEEN d.alert_date - (w.days - 1) AND d.alert_date
GROUP BY ALL""")
def alert_distinct_windows(spark, sf):
    """A-03 / A-04 / A-08: aircraft with alerts in the last 7 and 30 days of
    every day, from one stored sketch per component and day."""
    from .q_alerts import unified
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/alert-sketches-{uuid.uuid4().hex}"
    DC.daily_sketches(unified(spark, sf), ["component_id"], "alert_date", "aircraft_id").write.parquet(path)
    return DC.rolling_distinct(spark.read.parquet(path), ["component_id"], (7, 30), "affected_aircraft")


@query("stratified_split", f"""
SELECT doc_id, quality, toxic,
       row_number() OVER (PARTITION BY quality ORDER BY u, doc_id)
         <= round(count(*) OVER (PARTITION BY quality) * 0.3) AS is_test
FROM (SELECT *, {hash_uniform_sql('doc_id', 42)} AS u FROM labels) t""")
def stratified_split_q(spark, sf):
    """M-02: exact per-class 70/30 split by a keyed hash (seed 42)."""
    return stratified_split(D.table(spark, sf, "labels"), "quality", "doc_id", 0.3, 42)


@query("sample_n", f"""
SELECT * FROM events ORDER BY {hash_uniform_sql('event_id', 7)}, event_id LIMIT 100""")
def sample_n_q(spark, sf):
    """U-06: deterministic 100-row sample."""
    return sample_n(D.table(spark, sf, "events"), 100, "event_id", seed=7)


_SCEN = [("baseline", 1.0, 1.0), ("hot_engine", 1.1, 1.0), ("rough_ride", 1.0, 1.2)]


@query("whatif", O.with_(*E1F) + """
SELECT scenario, count(*) AS readings,
       count(*) FILTER (WHERE CAST(((avg_engine_temp_7d * t / 700.0) + (avg_vibration_7d * v / 25.0)) * 0.5
                                 + prev_anomaly * 0.3 + (days_since_maint / 100.0) * 0.2 AS DOUBLE) > 0.5) AS predicted_anomalies
FROM feat, (VALUES """ + ", ".join(f"('{n}', {t}, {v})" for n, t, v in _SCEN) + """) s(scenario, t, v)
GROUP BY scenario""")
def whatif(spark, sf):
    """R-14: re-score every feature row under modified sensor values; the
    scenarios are a fixed literal list exploded per row (no join)."""
    f = _chain(spark, sf)["features"]
    scen = F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(t).alias("t"), F.lit(v).alias("v"))
                     for n, t, v in _SCEN])
    x = f.select("*", F.explode(scen).alias("s")).select(
        "s.scenario", rule_score(F.col("avg_engine_temp_7d") * F.col("s.t"),
                                 F.col("avg_vibration_7d") * F.col("s.v")).alias("p"))
    return x.groupBy("scenario").agg(F.count(F.lit(1)).alias("readings"),
                                     F.count_if(F.col("p") == 1).alias("predicted_anomalies"))


# ---------------------------------------------------------------- sinks
_SRC_SQL = """src AS (
  SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderstatus = 'O'
  UNION ALL
  SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderstatus = 'P')"""


def _upsert_source(orders):
    changed = orders.filter(F.col("o_orderstatus") == "O").withColumn("o_orderstatus", F.lit("F"))
    new = orders.filter(F.col("o_orderstatus") == "P").withColumn(
        "o_orderkey", F.col("o_orderkey") + F.lit(1_000_000_000))
    return changed.unionByName(new)


@query("keyed_upsert", O.with_(_SRC_SQL) + """
SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src) UNION ALL SELECT * FROM src""")
def keyed_upsert(spark, sf):
    """O-07: keyed upsert (changed rows replace, new keys append)."""
    orders = D.table(spark, sf, "orders")
    return X.upsert_frame(orders, _upsert_source(orders), ["o_orderkey"])


@query("keyed_delete", "SELECT * FROM orders WHERE o_orderkey NOT IN "
       "(SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')")
def keyed_delete(spark, sf):
    """O-08: delete by key list."""
    orders = D.table(spark, sf, "orders")
    return X.delete_keys(orders, orders.filter(F.col("o_orderstatus") == "P"), ["o_orderkey"])


@query("flatten_kv", """
SELECT event_id, event_type AS env, k AS config_key, json_extract_string(props, '$.' || k) AS config_value
FROM events, unnest(json_keys(props)) AS t(k)""")
def flatten_kv(spark, sf):
    """F-10: JSON object → (id, env, key, value) rows, as the config store flattening."""
    e = D.table(spark, sf, "events").withColumnRenamed("event_type", "env")
    return flatten_json_kv(e, ["event_id", "env"], "props")


@query("case_update", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_totalprice > 400000 THEN '1-URGENT' WHEN o_orderstatus = 'P' THEN '2-HIGH'
            ELSE o_orderpriority END AS o_orderpriority
FROM orders""")
def case_update(spark, sf):
    """O-10: UPDATE … SET priority = CASE … as a projection."""
    o = D.table(spark, sf, "orders")
    return X.case_update(o, "o_orderpriority", [(F.col("o_totalprice") > 400000, F.lit("1-URGENT")),
                                                (F.col("o_orderstatus") == "P", F.lit("2-HIGH"))])


@query("date_shift", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate + INTERVAL 30 DAY AS o_orderdate, o_orderpriority
FROM orders""")
def date_shift(spark, sf):
    """O-11: rewrite with dates shifted by 30 days."""
    return X.shift_dates(D.table(spark, sf, "orders"), ["o_orderdate"], 30)


# ------------------------------------------------------------- streaming
def _events_stream(spark, sf):
    from ..streaming.ingest import parquet_stream
    schema = D.table(spark, sf, "events").schema
    return parquet_stream(spark, sf, "events.parquet", schema)


@query("stream_ingest_clean", O.with_(O.SENSOR, O.CLEANED) + "SELECT * EXCLUDE (reading_id) FROM cleaned")
def stream_ingest_clean(spark, sf):
    """X-01 / X-02: exactly-once stream ingest → expectations → clean → Parquet sink."""
    from ..streaming import ingest as I
    readings = D.sensor_readings_from(_events_stream(spark, sf)).drop("reading_id")
    loc = I.scratch_location(spark, "ingest")
    I.run_available(I.clean_stream(readings), f"{loc}/sink", f"{loc}/checkpoint")
    return spark.read.schema(readings.schema).parquet(f"{loc}/sink")


@query("stream_alerts", O.with_(O.COMP_RAW["engine"], O.comp_health("engine")) + """
SELECT aircraft_id, component_id, 'Engine' AS component_type, health_status, event_timestamp AS alert_timestamp
FROM engine_health WHERE health_status IN ('CRITICAL', 'WARNING')""")
def stream_alerts(spark, sf):
    """X-04: health rule on a stream, CRITICAL/WARNING appended per micro-batch."""
    from ..streaming import ingest as I
    readings = D.engine_readings_from(_events_stream(spark, sf))
    loc = I.scratch_location(spark, "alerts")
    I.alert_stream(readings, S.COMPONENTS["engine"], f"{loc}/sink", f"{loc}/checkpoint")
    schema = T.StructType([T.StructField("aircraft_id", T.LongType()), T.StructField("component_id", T.StringType()),
                           T.StructField("component_type", T.StringType()),
                           T.StructField("health_status", T.StringType()),
                           T.StructField("alert_timestamp", T.TimestampNTZType())])
    return spark.read.schema(schema).parquet(f"{loc}/sink").select(*schema.names)


# ------------------------------------------------------------------- model
@query("rf_score")
def rf_score(spark, sf):
    """M-03 … M-10: random forest (100 trees, seed 42) on scaled sensor
    features, trained on the 70 % split of the labelled features (kept +
    quarantined readings, K25) and scored on every cleaned row (rows-only)."""
    from . import sensor as SN
    r, m, mo = _inputs(spark, sf)
    train_all = SN.run(r, m, mo, training=True)["features"].dropna(
        subset=M.SENSOR_MODEL_FEATURES + ["anomaly_score"])
    keyed = train_all.withColumn("__key", F.xxhash64("aircraft_id", "timestamp"))
    split = stratified_split(keyed, "anomaly_score", "__key", 0.3, 42)
    # a forest reads its rows many times: the chain and the split are evaluated once for all of them
    train = stored(split.filter(~F.col("is_test")).select(*M.SENSOR_MODEL_FEATURES, "anomaly_score"), "rf-train")
    model = M.fit(train, M.SENSOR_MODEL_FEATURES, "anomaly_score", classes=2, num_trees=100)
    feats = _chain(spark, sf)["features"].dropna(subset=M.SENSOR_MODEL_FEATURES + ["anomaly_score"])
    return M.score(model, feats).select("aircraft_id", "timestamp", "anomaly_score", "predicted_anomaly")


# ----------------------------------------------------------- more coverage
@query("sql_records_per_type", O.with_(*O.comp_ctes(O.COMP_KEYS), O.comp_view()) + """
SELECT aircraft_id, component_type, count(*) AS total_records FROM comp_view
GROUP BY aircraft_id, component_type""")
def sql_records_per_type(spark, sf):
    """S-21 / A-05: the post-run summary as embedded SQL over a temp view."""
    from ..sources.files import sql_over
    return sql_over(spark, {"digital_twin_component_view": view(spark, sf)}, """
        SELECT aircraft_id, component_type, COUNT(*) AS total_records
        FROM digital_twin_component_view GROUP BY aircraft_id, component_type""")


@query("daily_status_counts", O.with_(*O.comp_ctes(O.COMP_KEYS), O.comp_view()) + """
SELECT CAST(event_timestamp AS DATE) AS day, aircraft_id, health_status, count(*) AS readings
FROM comp_view GROUP BY ALL""")
def daily_status_counts(spark, sf):
    """A-07: readings per day, aircraft and health status."""
    return view(spark, sf).groupBy(F.to_date("event_timestamp").alias("day"), "aircraft_id", "health_status") \
        .agg(F.count(F.lit(1)).alias("readings"))


@query("profile", "SELECT count(*) AS row_count, " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls"
    for c in ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
    + " FROM orders")
def profile_q(spark, sf):
    """P-18: row count and NULL counts (the sample part is a bounded limit)."""
    from ..operators.quality import profile
    return profile(D.table(spark, sf, "orders"))[0]


@query("config_lookup", """
SELECT k AS config_key, json_extract_string(props, '$.' || k) AS config_value, event_id
FROM events, unnest(json_keys(props)) AS t(k) WHERE event_type = 'click'""")
def config_lookup(spark, sf):
    """O-09: one environment of the flattened key/value store as a lookup frame."""
    e = D.table(spark, sf, "events").withColumnRenamed("event_type", "env")
    kv = flatten_json_kv(e, ["event_id", "env"], "props")
    return kv.filter(F.col("env") == "click").select("config_key", "config_value", "event_id")


def _model_metrics_sql():
    score = ("((avg_engine_temp_7d / 700.0) + (avg_vibration_7d / 25.0)) * 0.5 + prev_anomaly * 0.3 "
             "+ (days_since_maint / 100.0) * 0.2")
    parts = []
    for i, c in enumerate(_CUTS):
        src = (f"(SELECT anomaly_score AS y, CAST(CAST({score} AS DOUBLE) > {c} AS INTEGER) AS p "
               f"FROM feat WHERE prev_anomaly IS NOT NULL)")
        parts.append(f"SELECT 'aircraft_rule' AS model, {i + 1} AS version, tp, fp, fn, tn, precision, recall, f1 "
                     "FROM (" + _PRF_SQL.format(y="y", p="p", src=src) + ") x")
    return O.with_(*E1F) + "\nUNION ALL\n".join(parts)


@query("model_metrics", _model_metrics_sql())
def model_metrics(spark, sf):
    """Q-13 / M-05: metrics by model version (versions = cut-offs of the rule model)."""
    return _r(_versions(spark, sf), ["precision", "recall", "f1"])


@query("trace_lookup", O.with_(*O.mart_ctes(), O.TRACE) + """
SELECT t.* FROM trace t WHERE t.inference_trace_id IN (
  SELECT inference_trace_id FROM unified WHERE alert_category = 'CRITICAL')""")
def trace_lookup(spark, sf):
    """J-11 / Q-12 / Q-20: alert details with their inference rows for the
    trace ids of every CRITICAL-category alert, in one evaluation."""
    from .q_alerts import trace
    return trace(spark, sf, sought=F.col("alert_category") == "CRITICAL")


@query("ref_join_inner", O.with_(O.COMP_RAW["fuel"]) + """
SELECT f.aircraft_id, f.fuel_system_id, f.event_timestamp, s.s_suppkey, s.s_name, s.s_nationkey
FROM fuel_raw f JOIN supplier s ON f.aircraft_id = s.s_suppkey""")
def ref_join_inner(spark, sf):
    """J-03: inner reference join keeping both key columns (fuel readings × supplier)."""
    f = D.fuel_readings(spark, sf)
    s = D.table(spark, sf, "supplier")
    return ref_join(f, s, on=f["aircraft_id"] == s["s_suppkey"], how="inner").select(
        "aircraft_id", "fuel_system_id", "event_timestamp", "s_suppkey", "s_name", "s_nationkey")
