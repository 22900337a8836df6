"""Family D: domain-shaped CSV drops through the real readers and plans."""

import csv
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fleetlens import schemas as S
from fleetlens.plans import alerts as A
from fleetlens.plans import components as C
from fleetlens.plans import maps, sensor
from fleetlens.sources import files, reference

SENSOR_HEADER = [c for c, _ in S.RAW_SENSOR_COLS]


def _write(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


def _reading(ts, ac, model="A320", temp=600.0, fuel=80.0, vib=4.0, anomaly=0.0):
    return [ts, ac, model, temp, fuel, vib, 30000, 450, anomaly, 50, 3000, 24.5]


@pytest.fixture(scope="module")
def drop(tmp_path_factory):
    d = tmp_path_factory.mktemp("drop")
    rows = []
    t0 = dt.datetime(2024, 3, 1, 6, 0, 0)
    for i in range(20):
        ts = (t0 + dt.timedelta(days=i)).strftime("%Y-%m-%d %H:%M:%S")
        rows.append(_reading(ts, "A320_101", temp=600 + i))
        rows.append(_reading(ts, "E190_501", model="E190", temp=550 + i))
    rows.append(_reading("2024-03-02 06:00:00", "A320_101", temp=999.0))     # duplicate PK, removed by clean
    rows.append(_reading("not a time", "A320_101"))                           # malformed timestamp
    rows.append(_reading("2024-03-03 06:00:00", "A320_101", temp=750.0))     # quarantined
    _write(f"{d}/raw/part1.csv", SENSOR_HEADER, rows)
    _write(f"{d}/maint/m.csv", ["aircraft_id", "event_date", "event_type"],
           [["A320_101", "2024-03-05", "Routine Check"], ["A320_101", "2024-03-10", "Engine Repair"],
            ["E190_501", "2024-02-01", "Routine Check"], ["E190_501", "bad-date", "Routine Check"]])
    return str(d)


def test_ingest_parses_and_cleans(spark, drop):
    raw = files.read_sensor_csv(spark, f"{drop}/raw")
    assert raw.filter(F.col("timestamp").isNull()).count() == 1
    kept, quarantined = sensor.clean(raw) if hasattr(sensor, "clean") else (None, None)
    kept = sensor.cleaned(raw)
    assert kept.filter("engine_temp > 700").count() == 0
    maint = files.read_maintenance_csv(spark, f"{drop}/maint")
    assert maint.filter(F.col("event_date").isNull()).count() == 1


def test_sensor_chain_semantics(spark, drop):
    raw = files.read_sensor_csv(spark, f"{drop}/raw")
    maint = files.read_maintenance_csv(spark, f"{drop}/maint")
    models = reference.aircraft_models(spark)
    ch = sensor.run(raw, maint, models)
    enr = ch["enriched"]
    # K1: readings before the first maintenance of A320_101 (Mar 1-4) are dropped
    a = enr.filter("aircraft_id = 'A320_101'").orderBy("timestamp").collect()
    assert a[0].timestamp.date() == dt.date(2024, 3, 5)
    assert {r.maint_date for r in a if r.timestamp.date() >= dt.date(2024, 3, 10)} == {dt.date(2024, 3, 10)}
    assert enr.groupBy("aircraft_id", "timestamp").count().filter("count > 1").count() == 0
    assert enr.filter(F.col("manufacturer").isNull()).count() == 0
    left = sensor.run(raw, maint, models, how="left")["features"]
    early = left.filter("aircraft_id = 'A320_101' AND timestamp < '2024-03-05'").collect()
    assert early and all(r.days_since_maint > 19000 for r in early)     # 1970 default
    ev = ch["engine_view"].collect()
    assert len(ev) == 2
    f = ch["features"].filter("aircraft_id = 'E190_501'").orderBy("timestamp").collect()
    assert f[0].prev_anomaly is None and f[1].prev_anomaly == 0.0
    assert f[6].avg_engine_temp_7d == pytest.approx(sum(550 + i for i in range(7)) / 7)


def test_status_and_component_maps(spark, drop):
    raw = files.read_sensor_csv(spark, f"{drop}/raw")
    maint = files.read_maintenance_csv(spark, f"{drop}/maint")
    ch = sensor.run(raw, maint, reference.aircraft_models(spark))
    loc = maps.location_enriched(reference.aircraft_bases(spark, 2), reference.airports(spark, 2))
    sea = loc.filter("airport_code = 'SEA'").collect()
    assert sea and all(r.latitude is None for r in sea)               # K21
    alerts = A.alerts_from_predictions(ch["predictions"], "2024-04-01 00:00:00")
    sm = maps.status_map(loc, ch["engine_view"], alerts)
    assert sm.count() == len(S.AIRCRAFT_AIRPORTS_V2)
    no_twin = sm.filter("aircraft_id = 'B777_401'").first()
    assert no_twin.alert_count == 0 and no_twin.engine_health_status is None
    comp = spark.createDataFrame([("A320_101", "E1", "Engine", "CRITICAL", dt.datetime(2024, 3, 1))],
                                 "aircraft_id string, component_id string, component_type string, "
                                 "health_status string, alert_timestamp timestamp")
    cm = maps.component_status_map(loc, comp)
    assert cm.filter("component_type IS NULL").agg(F.sum("alert_count")).first()[0] == len(S.AIRCRAFT_AIRPORTS_V2) - 1
    cm2 = maps.component_status_map(loc, comp, count_mode="alerts")
    assert cm2.agg(F.sum("alert_count")).first()[0] == 1


def test_component_csv_and_union(spark, tmp_path):
    frames = {}
    for key, spec in S.COMPONENTS.items():
        cols = [c for c, _ in spec.raw_cols]
        row = []
        for c, t in spec.raw_cols:
            row.append({"aircraft_id": "A320_101", "event_timestamp": "2024-03-01 00:00:00",
                        spec.id_col: f"{key}-1"}.get(c, "NONE" if t == S.S else "1"))
        _write(f"{tmp_path}/{key}/a.csv", cols, [row])
        frames[key] = C.health(files.read_component_csv(spark, spec, f"{tmp_path}/{key}"), spec)
    view = C.component_view(frames)
    assert view.count() == len(S.COMPONENTS)
    assert set(view.columns) >= {"component_type", "health_status", "fault_code", "extreme_event"}
    assert C.component_alerts(view).count() == view.filter("health_status != 'NOMINAL'").count()


def test_header_report_and_latest_file(spark, tmp_path):
    _write(f"{tmp_path}/raw/a.csv", SENSOR_HEADER, [_reading("2024-03-01 00:00:00", "X")])
    swapped = SENSOR_HEADER[1:2] + SENSOR_HEADER[:1] + SENSOR_HEADER[2:]
    _write(f"{tmp_path}/raw/b.csv", swapped, [_reading("2024-03-02 00:00:00", "Y")])
    os.utime(f"{tmp_path}/raw/a.csv", (1_700_000_000, 1_700_000_000))
    rep = {os.path.basename(r.file_path): r.matches
           for r in files.header_report(spark, f"{tmp_path}/raw", SENSOR_HEADER).collect()}
    assert rep == {"a.csv": True, "b.csv": False}
    latest = files.read_latest_file(spark, f"{tmp_path}/raw", S.RAW_SENSOR_SCHEMA).collect()
    assert len(latest) == 1 and latest[0].aircraft_id == "Y"      # positional mapping (K8)


def test_unify_alert_tables_missing_component(spark):
    ac = spark.createDataFrame([(dt.datetime(2024, 3, 1, 5, 6, 7), "A320_101", 1)],
                               "timestamp timestamp, aircraft_id string, predicted_anomaly int")
    eng = A.alerts_from_predictions(ac, "2024-03-02 00:00:00")
    u = A.unify_alert_tables(spark, {"AC": eng, "ENG": eng}, "2024-03-02 00:00:00").collect()
    assert {r.component_id for r in u} == {"AC", "ENG"}
    r = [x for x in u if x.component_id == "ENG"][0]
    assert r.inference_trace_id == "A320_101_ENG_20240301_050607"
    assert r.alert_category == "CRITICAL" and r.alert_severity == "HIGH" and r.alert_hour == 5
    empty = files.read_table_or_empty(spark, "no_such_table_xyz", ac.schema)
    assert empty.count() == 0 and empty.columns == ac.columns


def test_read_path_or_empty(spark, tmp_path):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    assert files.read_path_or_empty(spark, str(tmp_path / "missing"), schema).count() == 0
    spark.createDataFrame([(1,)], schema).write.parquet(str(tmp_path / "t"))
    assert files.read_path_or_empty(spark, str(tmp_path / "t"), schema).count() == 1


def test_observed_expectations_stream(spark, drop, tmp_path):
    from fleetlens.streaming import ingest as I
    raw = files.read_sensor_csv(spark, f"{drop}/raw")
    q = I.run_available(I.clean_stream(I.sensor_stream(spark, f"{drop}/raw")), str(tmp_path / "out"),
                        str(tmp_path / "ck"))
    m = {}
    for p in q.recentProgress:
        row = (p.observedMetrics or {}).get("sensor_expectations")
        for k, v in (row.asDict() if row is not None else {}).items():
            m[k] = m.get(k, 0) + int(v)
    assert m["rows"] == raw.count()
    assert m["valid_engine_temp"] == raw.filter("NOT COALESCE(engine_temp BETWEEN 0 AND 1000, FALSE)").count()


def test_recreate_and_append(spark, tmp_path):
    from fleetlens.sinks import tables as X
    df = spark.createDataFrame([("A", 1, dt.date(2024, 3, 1)), ("B", 0, dt.date(2024, 3, 1))],
                               "aircraft_id string, predicted_anomaly int, alert_day date")
    path = str(tmp_path / "engine_alerts")
    X.recreate_and_append(spark, df, path, F.col("predicted_anomaly") == 1, "20240301_000000")
    X.recreate_and_append(spark, df, path, F.col("predicted_anomaly") == 1, "20240302_000000")
    got = spark.read.parquet(path).collect()
    assert [(r.aircraft_id, r.batch_id) for r in got] == [("A", "20240302_000000")]


def test_generated_drop_through_stream(spark, tmp_path):
    import generate as G
    from fleetlens.streaming import ingest as I
    fleet = spark.createDataFrame([("A320_101", "A320"), ("E190_501", "E190")], "aircraft_id string, model string")
    days = G.sensor_days(fleet, "2024-01-01", "2024-12-31", seed=7)
    maint = G.maintenance(fleet, "2024-01-01", "2024-12-31", seed=7).collect()
    assert days.count() == 2 * 366 and len(maint) == 4
    anomalies = days.filter("anomaly_score = 1").collect()
    assert len(anomalies) == 2 and all(r.engine_temp > 700 for r in anomalies)     # K25: cleaning removes them
    assert days.select("timestamp").collect() == G.sensor_days(fleet.repartition(3), seed=7).select("timestamp").collect()
    G.write_csv_drop(days, str(tmp_path / "raw"), "raw_sensor_data", "20240101_000000")
    out = str(tmp_path / "bronze")
    I.run_available(I.clean_stream(I.sensor_stream(spark, str(tmp_path / "raw") + "/*")), out, str(tmp_path / "ck"))
    assert spark.read.parquet(out).count() == days.filter(
        "engine_temp <= 700 AND fuel_efficiency >= 50 AND vibration <= 25").count()
    comp = G.component_records("hydraulic", fleet, "2024-12-31 00:00:00", n=50)
    assert comp.count() == 100 and set(comp.columns) == {c for c, _ in __import__("fleetlens").schemas.COMPONENTS["hydraulic"].raw_cols}
