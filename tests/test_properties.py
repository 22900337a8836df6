"""Properties from the test strategy."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlens.operators.asof import asof_join
from fleetlens.plans import components as C
from fleetlens.plans import maps
from fleetlens.plans.oracle import COMP_KEYS
from fleetlens.plans.q_components import health_frames
from fleetlens.plans.q_sensor import _inputs
from fleetlens.plans import sensor
from fleetlens.sources import driver as D


def test_union_rows_equal_sum_of_inputs(spark, sf):
    frames = health_frames(spark, sf)
    total = sum(D.COMPONENT_SOURCES[k](spark, sf).count() for k in COMP_KEYS)
    assert C.component_view(frames).count() == total


def test_map_alert_totals_equal_mapped_alerts(spark, sf):
    alerts = C.component_alerts(C.component_view(health_frames(spark, sf)))
    loc = maps.location(spark, sf)
    cm = maps.component_status_map(loc, alerts, count_mode="alerts")
    mapped = alerts.join(loc.select("aircraft_id"), "aircraft_id", "left_semi").count()
    assert cm.agg(F.sum("alert_count")).first()[0] == mapped


def test_shuffled_input_same_features(spark, sf):
    r, m, mo = _inputs(spark, sf)
    a = sensor.run(r, m, mo)["features"]
    b = sensor.run(r.repartition(7, "engine_temp"), m.repartition(3), mo.repartition(5))["features"]
    key = ["aircraft_id", "timestamp"]
    assert sorted(map(tuple, a.orderBy(*key).collect())) == sorted(map(tuple, b.orderBy(*key).collect()))


day = st.integers(min_value=0, max_value=20)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(readings=st.lists(st.tuples(st.sampled_from("ABC"), day, st.integers(0, 23)), min_size=1, max_size=25),
       events=st.lists(st.tuples(st.sampled_from("ABC"), day), max_size=10),
       how=st.sampled_from(["inner", "left"]))
def test_asof_against_brute_force(spark, readings, events, how):
    base = dt.datetime(2024, 1, 1)
    rrows = [(a, base + dt.timedelta(days=d, hours=h), i) for i, (a, d, h) in enumerate(readings)]
    mrows = [(a, (base + dt.timedelta(days=d)).date(), j) for j, (a, d) in enumerate(events)]
    r = spark.createDataFrame(rrows, "aircraft_id string, ts timestamp, rid int")
    m = spark.createDataFrame(mrows, "aircraft_id string, d date, mid int")
    got = {row.rid: row.mid for row in asof_join(r, m, ["aircraft_id"], F.to_date("ts"), "d", ["d", "mid"],
                                                   tie=["mid"], how=how).collect()}
    exp = {}
    for a, ts, rid in rrows:
        cands = [(d, j) for (b, d, j) in mrows if b == a and d <= ts.date()]
        if cands:
            exp[rid] = max(cands)[1]
        elif how == "left":
            exp[rid] = None
    assert got == exp


def test_training_features_include_quarantined(spark, sf):
    r, m, mo = _inputs(spark, sf)
    kept = sensor.run(r, m, mo)["features"].count()
    train = sensor.run(r, m, mo, training=True)["features"].count()
    quarantined_matched = sensor.run(r, m, mo)["quarantined"].join(
        m.select("aircraft_id").distinct(), "aircraft_id", "left_semi").count()
    assert kept < train <= kept + quarantined_matched


def test_traceability_join_equals_window(spark, sf):
    from fleetlens.plans import alerts as A
    from fleetlens.plans.q_alerts import RUN_TS, predictions_long, unified
    w = A.traceability_from_predictions(predictions_long(spark, sf), spark, RUN_TS)
    j = A.traceability(unified(spark, sf), predictions_long(spark, sf), RUN_TS)
    cols = sorted(w.columns)
    assert cols == sorted(j.columns)
    assert sorted(map(tuple, w.select(*cols).collect()), key=str) == \
        sorted(map(tuple, j.select(*cols).collect()), key=str)
