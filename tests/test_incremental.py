"""Incremental gold refresh: only touched cells are rewritten, and the tables
equal a full recompute."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fleetlens.plans import sensor
from fleetlens.plans.incremental import IncrementalGold

R = ("timestamp timestamp_ntz, aircraft_id string, model string, engine_temp double, fuel_efficiency double, "
     "vibration double, altitude double, airspeed double, anomaly_score double, oil_pressure double, "
     "engine_rpm int, battery_voltage double")
M = "aircraft_id string, event_date date, event_type string"
MODELS = "model string, manufacturer string, engine_type string, capacity int, range_km int"


def reading(aircraft, month, day, temp=600.0, anomaly=0.0, hour=0):
    return (dt.datetime(2024, month, day, hour), aircraft, "A320", temp, 80.0, 4.0, 3e4, 450.0, anomaly, 50.0, 3000, 24.0)


def files(root, name):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{root}/{name}") for f in names if f.endswith(".parquet")}


def months_of(paths):
    return {p.split("month=")[1][:7] for p in paths}


@pytest.mark.parametrize("how", ["inner"])
def test_only_touched_cells_and_equal_to_full(spark, tmp_path, how):
    root = str(tmp_path / "gold")
    models = spark.createDataFrame([("A320", "Airbus", "CFM", 180, 6000)], MODELS)
    first = [reading(f"AC{a}", m, d, 500.0 + 10 * a + d + m) for a in range(4) for m in (1, 2, 3) for d in range(1, 13)]
    first += [reading("AC9", m, 5, 550.0 + m) for m in range(1, 10)]                # one a month: windows span 7 months
    first += [reading("AC0", 1, 1, 750.0, hour=3), reading(None, 1, 1), reading("AC0", 1, 2, 502.0)]
    maint = [(f"AC{a}", dt.date(2024, 1, 1 + a), "Routine Check") for a in range(3)] + [("AC9", dt.date(2023, 5, 5), "x")]
    gold = IncrementalGold(spark, root, models, spark.createDataFrame([], R).schema, spark.createDataFrame([], M).schema,
                           "2024-12-01 00:00:00", buckets=2, how=how)
    seen_r, seen_m = [], []

    def apply(tag, readings=(), maintenance=()):
        seen_r.extend(readings)
        seen_m.extend(maintenance)
        return gold.apply(tag, readings=spark.createDataFrame(list(readings), R) if readings else None,
                          maintenance=spark.createDataFrame(list(maintenance), M) if maintenance else None)

    def check():
        r, m = spark.createDataFrame(seen_r, R), spark.createDataFrame(seen_m, M)
        chain = sensor.run(r, m, models, how=how)
        for name, want in (("sensor_features", chain["features"]), ("prediction_results", chain["predictions"])):
            got = gold.table(name).select(*want.columns)
            assert sorted(map(tuple, got.collect()), key=repr) == sorted(
                map(tuple, want.filter(F.col("aircraft_id").isNotNull()).collect()), key=repr)
        view = chain["engine_view"]
        assert sorted(map(tuple, gold.engine_view().select(*view.columns).collect()), key=repr) == sorted(
            map(tuple, view.filter(F.col("aircraft_id").isNotNull()).collect()), key=repr)
        assert gold.alerts().count() == chain["predictions"].filter(
            "predicted_anomaly = 1 AND aircraft_id IS NOT NULL").count()
        assert gold.table("quarantine").count() == r.filter("engine_temp > 700").count()

    apply("b0", first, maint)
    check()
    before = files(root, "sensor_features")
    cells = apply("b1", [reading("AC1", 3, 20, 690.0, 1.0), reading("AC1", 3, 21, 695.0)])
    after = files(root, "sensor_features")
    assert {m for m, _ in cells} == {"2024-03"} and len(cells) == 1
    assert months_of(after ^ before) == {"2024-03"}               # the other files are the same files
    check()
    # a late reading of AC9 moves its next six readings, one a month
    cells = apply("b2", [reading("AC9", 2, 20, 400.0)])
    assert {m for m, _ in cells} == {f"2024-{m:02d}" for m in range(2, 9)}
    check()
    # maintenance between two events, a new aircraft's first event, and the same batch once more
    apply("b3", maintenance=[("AC0", dt.date(2024, 2, 3), "Engine Repair"), ("AC3", dt.date(2024, 3, 2), "Engine Repair")])
    check()
    gold.apply("b1", readings=spark.createDataFrame([reading("AC1", 3, 20, 690.0, 1.0), reading("AC1", 3, 21, 695.0)], R))
    check()
