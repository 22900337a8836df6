import pytest
"""Stream ≡ batch: two drops in two availableNow runs, rerun adds nothing."""

import csv
import os

from fleetlens import schemas as S
from fleetlens.sources import files
from fleetlens.streaming import ingest as I

HEADER = [c for c, _ in S.RAW_SENSOR_COLS]


def _drop(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(HEADER)
        w.writerows(rows)


def _row(i, temp):
    return [f"2024-03-01 00:00:{i:02d}", f"AC{i % 3}", "A320", temp, 80, 4, 30000, 450, 0, 50, 3000, 24]


def test_stream_equals_batch(spark, tmp_path):
    src, sink, ck = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck"
    _drop(f"{src}/a.csv", [_row(i, 600 + i * 20) for i in range(10)])
    I.run_available(I.clean_stream(I.sensor_stream(spark, src)), sink, ck)
    n1 = spark.read.parquet(sink).count()
    _drop(f"{src}/b.csv", [_row(i + 10, 500) for i in range(5)])
    I.run_available(I.clean_stream(I.sensor_stream(spark, src)), sink, ck)
    I.run_available(I.clean_stream(I.sensor_stream(spark, src)), sink, ck)    # nothing new
    streamed = sorted(tuple(r) for r in spark.read.parquet(sink).collect())
    batch = sorted(tuple(r) for r in files.read_sensor_csv(spark, src).transform(
        lambda d: d.filter("engine_temp <= 700 AND fuel_efficiency >= 50 AND vibration <= 25")).collect())
    assert n1 == 6 and streamed == batch and len(streamed) == 11


def test_alert_stream(spark, tmp_path):
    spec = S.COMPONENTS["engine"]
    rows = [[f"e{i}", "AC1", f"2024-03-01 00:00:{i:02d}", 1, 1, 700 + i * 10, 1.0, 60] for i in range(8)]
    _drop(f"{tmp_path}/eng/a.csv", [])
    with open(f"{tmp_path}/eng/a.csv", "w", newline="") as f:
        w = csv.writer(f)
        w.writerow([c for c, _ in spec.raw_cols])
        w.writerows(rows)
    I.alert_stream(I.component_stream(spark, spec, f"{tmp_path}/eng"), spec, f"{tmp_path}/alerts", f"{tmp_path}/ck")
    got = spark.read.parquet(f"{tmp_path}/alerts")
    assert got.count() == 7      # temperature 700 is not > 700
    assert got.filter("health_status = 'CRITICAL'").count() == 2


def test_latest_state_stream(spark, tmp_path):
    from fleetlens.sinks.tables import read_current
    from pyspark.sql import functions as F
    src = f"{tmp_path}/in"
    _drop(f"{src}/a.csv", [_row(i, 600 + i) for i in range(6)])
    stream = I.sensor_stream(spark, src).select("aircraft_id", "timestamp", "engine_temp")
    I.latest_state_stream(stream, f"{tmp_path}/state", f"{tmp_path}/ck", ["aircraft_id"], ["timestamp"])
    _drop(f"{src}/b.csv", [_row(30 + i, 500) for i in range(3)])
    stream = I.sensor_stream(spark, src).select("aircraft_id", "timestamp", "engine_temp")
    I.latest_state_stream(stream, f"{tmp_path}/state", f"{tmp_path}/ck", ["aircraft_id"], ["timestamp"])
    cur = {r.aircraft_id: r.engine_temp for r in read_current(spark, f"{tmp_path}/state").collect()}
    batch = files.read_sensor_csv(spark, src)
    exp = {r.aircraft_id: r.engine_temp for r in batch.groupBy("aircraft_id").agg(
        F.max_by("engine_temp", "timestamp").alias("engine_temp")).collect()}
    assert cur == exp


def test_swapped_header_fails_on_stream_and_batch(spark, tmp_path):
    from fleetlens import schemas as S
    names = [c for c, _ in S.COMPONENTS["fuel"].raw_cols]
    src = tmp_path / "fuel"
    src.mkdir()
    swapped = [names[1], names[0], *names[2:]]
    (src / "a.csv").write_text(",".join(swapped) + "\n" + ",".join("1" for _ in names) + "\n")
    spec = S.COMPONENTS["fuel"]
    with pytest.raises(Exception):
        files.read_component_csv(spark, spec, str(src)).collect()
    with pytest.raises(Exception):
        I.run_available(I.component_stream(spark, spec, str(src)), f"{tmp_path}/out", f"{tmp_path}/ck")


def test_every_twin_and_maintenance_stream(spark, tmp_path):
    from fleetlens import schemas as S
    for key, spec in S.COMPONENTS.items():
        names = [c for c, _ in spec.raw_cols]
        src = tmp_path / key
        src.mkdir()
        line = ["2024-03-01 00:00:00" if n == "event_timestamp" else "5" for n in names]
        (src / "a.csv").write_text(",".join(names) + "\n" + ",".join(line) + "\n")
        I.run_available(I.component_stream(spark, spec, str(src)), f"{tmp_path}/{key}-out", f"{tmp_path}/{key}-ck")
        got = spark.read.parquet(f"{tmp_path}/{key}-out")
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(
            map(tuple, files.read_component_csv(spark, spec, str(src)).select(*got.columns).collect()), key=repr)
    src = tmp_path / "maint"
    src.mkdir()
    (src / "a.csv").write_text("aircraft_id,event_date,event_type\nA,2024-01-02,Routine Check\nB,bad,Engine Repair\n")
    I.run_available(I.maintenance_stream(spark, str(src)), f"{tmp_path}/m-out", f"{tmp_path}/m-ck")
    assert spark.read.parquet(f"{tmp_path}/m-out").filter("event_date is null").count() == 1


def _sensor_rows(spark, path):
    return sorted((tuple(r) for r in spark.read.parquet(path).collect()), key=repr)


def _maintenance(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("aircraft_id,event_date,event_type\n" + "".join(",".join(r) + "\n" for r in rows))


def _reading(aircraft, day, hour, temp, anomaly=0, rpm=3000):
    return [f"2024-03-{day:02d} {hour:02d}:00:00", aircraft, "A320", temp, 80, 4, 30000, 450, anomaly, 50, rpm, 24]


def test_features_from_state_equal_batch_over_restarts(spark, tmp_path):
    """Four runs of one checkpoint: NULL metrics, more readings than the tail
    holds, a new aircraft, maintenance between drops, a repeated reading."""
    from pyspark.sql import functions as F
    from fleetlens.plans import sensor
    from fleetlens.streaming.state import features_stream
    src, maint, sink, ck = (f"{tmp_path}/{x}" for x in ("in", "maint", "out", "ck"))
    _maintenance(f"{maint}/a.csv", [("AC0", "2024-03-01", "Routine Check"), ("AC1", "2024-03-02", "Engine Repair")])
    drops = [[_reading("AC0", 1, h, 500 + h, h % 2) for h in range(5)] + [_reading("AC1", 1, 3, 600)],
             [_reading("AC0", 2, h, "" if h == 2 else 510 + h, 1, "" if h == 3 else 2000 + h) for h in range(9)]
             + [_reading("AC1", 2, h, 640 + h) for h in (8, 2, 5)] + [_reading("AC1", 2, 5, 600)],
             [_reading("AC2", 3, 1, 520), _reading("AC0", 3, 1, 530)],
             [_reading("AC2", 4, 1, 521), _reading("AC2", 4, 2, 522), _reading("AC1", 4, 1, 501, 1)]]
    for k, rows in enumerate(drops):
        _drop(f"{src}/{k}.csv", rows)
        if k == 2:
            _maintenance(f"{maint}/b.csv", [("AC2", "2024-03-04", "Engine Repair"), ("AC0", "2024-03-03", "Engine Repair")])
        readings = I.clean_stream(I.sensor_stream(spark, src))
        out = features_stream(readings, I.maintenance_stream(spark, maint))
        I.run_available(out, sink, ck)
        I.run_available(features_stream(I.clean_stream(I.sensor_stream(spark, src)), I.maintenance_stream(spark, maint)),
                        sink, ck)                                            # nothing new
    none = spark.createDataFrame([], "model string, manufacturer string, engine_type string, capacity int, range_km int")
    batch = sensor.run(files.read_sensor_csv(spark, src), files.read_maintenance_csv(spark, maint), none)["features"]
    cols = [c for c in S.SENSOR_FEATURE_COLS if c not in ("manufacturer", "engine_type", "capacity", "range_km")]
    got = sorted((tuple(r) for r in spark.read.parquet(sink).filter(~F.col("late")).select(*cols).collect()), key=repr)
    want = sorted((tuple(r) for r in batch.select(*cols).collect()), key=repr)
    assert got == want and len(got) > 15


def test_late_readings_are_marked_not_lost(spark, tmp_path):
    from fleetlens.streaming.state import features_stream
    src, maint, sink, ck = (f"{tmp_path}/{x}" for x in ("in", "maint", "out", "ck"))
    _maintenance(f"{maint}/a.csv", [("AC0", "2024-03-01", "Routine Check")])
    for k, hours in enumerate([(1, 5), (3, 5, 7)]):
        _drop(f"{src}/{k}.csv", [_reading("AC0", 1, h, 500 + h) for h in hours])
        out = features_stream(I.sensor_stream(spark, src), I.maintenance_stream(spark, maint), ttl_ms=3_600_000)
        I.run_available(out, sink, ck)
    got = {(r.timestamp.hour, r.engine_temp): (r.late, r.avg_engine_temp_7d) for r in spark.read.parquet(sink).collect()
           if r.late or r.timestamp.hour == 7}
    assert got == {(3, 503.0): (True, None), (5, 505.0): (True, None), (7, 507.0): (False, (501 + 505 + 507) / 3)}


def test_trailing_mean_against_plain_loop():
    import numpy as np
    from fleetlens.streaming.state import trailing_mean
    rng = np.random.Generator(np.random.PCG64(1))
    for n in (1, 3, 7):
        for size in (0, 1, 5, 40):
            x = np.where(rng.random(size) < .3, np.nan, rng.random(size))
            want = [np.nan if not len(k := w[~np.isnan(w)]) else sum(k) / len(k)
                    for w in (x[max(0, i - n + 1):i + 1] for i in range(size))]
            assert np.allclose(trailing_mean(x, n), want, equal_nan=True)


class _Map(dict):
    getValue, updateValue = dict.get, dict.__setitem__


def test_a_group_of_aircraft_is_one_call_with_rows_of_each():
    """Many aircraft in one call give what each of them gives alone, over two
    micro-batches: late and repeated readings, none, old and new maintenance."""
    import numpy as np
    import pandas as pd
    from types import SimpleNamespace
    from fleetlens.streaming.state import MEANS, SensorState
    rng = np.random.Generator(np.random.PCG64(3))
    columns = ["aircraft_id", "timestamp", "anomaly_score", *MEANS.values()]

    def batch(at):
        rows = []
        for a in range(40):
            for us in rng.integers(at, at + 12, rng.integers(0, 14)) if a % 9 else []:
                temp = None if us % 5 == 0 else float(rng.integers(0, 50))
                rows.append((a, int(us), int(rng.integers(0, 2)), temp, float(a), 3.0, 1, int(us), int(us), None, None, None))
            if rng.random() < .5:
                rows.append((a, None, None, None, None, None, 0, None, None, int(rng.integers(at, at + 9)), str(a), "Repair"))
        return pd.DataFrame(rows, columns=[*columns, "side_", "us_", "day_", "maint_day_", "tie_", "event_type"])

    first, second = batch(0), batch(8)
    one = SensorState(columns)
    one.init(SimpleNamespace(getMapState=lambda *a: _Map()))
    together = pd.concat([f for b in (first, second) for f in one.handleInputRows((0,), iter([b]), None)])
    apart = []
    for a in range(40):
        alone = SensorState(columns)
        alone.init(SimpleNamespace(getMapState=lambda *a: _Map()))
        for b in (first, second):
            mine = b[b["aircraft_id"] == a].reset_index(drop=True)
            if len(mine):
                apart += alone.handleInputRows((0,), iter([mine]), None)
    apart = pd.concat(apart)
    assert sorted(map(repr, together.astype(object).where(together.notna(), None).values.tolist())) == sorted(
        map(repr, apart.astype(object).where(apart.notna(), None).values.tolist()))
    assert together["late"].any() and together["prev_anomaly"].notna().any() and len(together) > 100


def test_expectation_log_per_batch(spark, tmp_path):
    from fleetlens.operators.quality import expectation_report
    from fleetlens.streaming.expectations import ExpectationLog, counts, totals
    src, sink, ck, log_at = (f"{tmp_path}/{x}" for x in ("in", "out", "ck", "log"))
    with ExpectationLog(spark, log_at) as log:
        for k in range(3):
            _drop(f"{src}/{k}.csv", [_row(i, t) for i, t in enumerate([500, -5 * k, 1200, ""][:k + 2])])
            log.wait(I.run_available(I.clean_stream(I.sensor_stream(spark, src)), sink, ck))
    report = expectation_report(files.read_sensor_csv(spark, src))
    assert sorted(map(tuple, totals(spark, log_at).collect())) == sorted(map(tuple, report.collect()))
    per_batch = {(r.batch_id, r.expectation): (r.total_rows, r.failed_rows) for r in counts(spark, log_at).collect()}
    assert per_batch[0, "valid_engine_temp"] == (2, 0) and per_batch[2, "valid_engine_temp"] == (4, 3)
    assert len(per_batch) == 9


def test_latest_state_writes_changes_and_one_version_a_run(spark, tmp_path):
    """Three files in one run are three micro-batches but one version; an
    unmerged change (a run that broke off) is read, and merged by the next run."""
    from fleetlens.sinks.tables import read_current
    src, root, ck = f"{tmp_path}/in", f"{tmp_path}/state", f"{tmp_path}/ck"
    keys, order = ["aircraft_id"], ["timestamp"]

    def run():
        stream = I.csv_stream(spark, src, S.RAW_SENSOR_SCHEMA, max_files=1).select("aircraft_id", "timestamp", "engine_temp")
        I.latest_state_stream(stream, root, ck, keys, order)
        return stream.schema

    for k in range(3):
        _drop(f"{src}/{k}.csv", [_row(i + 6 * k, 600 + i) for i in range(3)])
    schema = run()
    run()                                                                    # nothing new, no new version
    assert [d.split("-")[0] for d in os.listdir(root)] == ["v=000000000000"]
    changes, merged = I._change_folders(root, ck)
    assert len([d for d in os.listdir(changes) if d.startswith("epoch=")]) == 3
    (spark.createDataFrame([("AC0", "2024-03-09 00:00:00", 1.0)], schema).selectExpr("*", "7L AS epoch").write
     .mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(changes))
    assert {r.engine_temp for r in I.read_latest(spark, root, ck, keys, order, schema).collect()} == {1.0, 601.0, 602.0}
    run()
    assert {r.engine_temp for r in read_current(spark, root).collect()} == {1.0, 601.0, 602.0}
    assert len(os.listdir(root)) == 2
