"""Component models: split, held-out metrics, registry, alias and alerts."""

import duckdb
import pytest
from pyspark.sql import functions as F

from fleetlens import schemas as S
from fleetlens.ml import component_models as CM
from fleetlens.ml import model as M
from fleetlens.plans import job, maps
from fleetlens.plans.oracle import COMP_KEYS, RUN_TS
from fleetlens.plans.q_components import health_frames
from fleetlens.sources import driver as D

SF = "/root/testdata/sf0.01"
TWINS = ("engine", "fuel")


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("models"))
    frames = health_frames(spark, SF, TWINS)
    return root, frames, CM.train_all(spark, frames, root, 1, num_trees=10, parallel=2)


def test_split_is_exact_and_stable(spark):
    health = health_frames(spark, SF, ("engine",))["engine"]
    spec = S.COMPONENTS["engine"]
    a = CM.split_rows(health, spec)
    got = {r.label: (r.n, r.t) for r in a.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert sum(n for n, _ in got.values()) == health.count()
    assert all(t == int(n * 0.3 + 0.5) for n, t in got.values())
    b = CM.split_rows(health.repartition(5), spec)
    assert a.exceptAll(b.select(a.columns)).count() == 0


def test_metrics_are_those_of_the_written_predictions(spark, trained):
    root, frames, metrics = trained
    con = duckdb.connect()
    for twin in TWINS:
        tp, fp, fn, tn = con.execute(f"""
            SELECT count(*) FILTER (WHERE label = 1 AND p = 1), count(*) FILTER (WHERE label = 0 AND p = 1),
                   count(*) FILTER (WHERE label = 1 AND p = 0), count(*) FILTER (WHERE label = 0 AND p = 0)
            FROM (SELECT *, predicted_anomaly AS p FROM
                  read_parquet('{root}/component_predictions/v=1/component={twin}/*.parquet') WHERE is_test) t""").fetchone()
        m = metrics[twin]
        assert (m["tp"], m["fp"], m["fn"], m["tn"]) == (tp, fp, fn, tn)
        assert (tp + tn) / (tp + fp + fn + tn) > max(tp + fn, fp + tn) / (tp + fp + fn + tn) - 1e-9
        assert m["recall"] > 0.5
        reg = M._record(spark, root, CM.model_name(twin), 1)
        assert (reg["precision"], reg["recall"], reg["f1"]) == (m["precision"], m["recall"], m["f1"])


def test_alias_moves_to_the_champion(spark, trained):
    root, frames, metrics = trained
    assert CM.live_twins(spark, root) == [k for k in S.COMPONENTS if k in TWINS]
    model = M.load(spark, root, CM.model_name("fuel"), "live")
    M.register(spark, model, root, CM.model_name("fuel"), 2, {"f1": -1.0})
    CM.promote(spark, root)
    assert {r["version"] for r in M.aliases(spark, root).collect()} == {1}
    M.register(spark, model, root, CM.model_name("fuel"), 3, {"f1": 2.0})
    CM.promote(spark, root)
    CM.promote(spark, root)                                       # nothing left to move
    now = {r["model"]: r["version"] for r in M.aliases(spark, root).collect()}
    assert now == {"component_fuel": 3, "component_engine": 1}
    with pytest.raises(ValueError, match="signature"):
        CM.score_live(spark, {"engine": frames["engine"].drop("oil_pressure")}, root)


def test_odd_rows(spark, tmp_path):
    """Missing features and statuses are not scored; repeated rows, one class
    and no rows at all do not crash; a repeated run replaces its tables."""
    spec = S.COMPONENTS["engine"]
    schema = ("aircraft_id string, component_id string, event_timestamp timestamp_ntz, thrust_level double, "
              "fuel_consumption_rate double, temperature_reading double, vibration_level double, "
              "oil_pressure double, health_status string")
    rows = [("A", f"e{i % 40}", None, 50.0, 3.0, 600.0 + 5 * (i % 40), 1.0, 60.0,
             "CRITICAL" if i % 40 > 30 else "NOMINAL") for i in range(80)]
    rows += [("A", "x", None, None, 3.0, 600.0, 1.0, 60.0, "NOMINAL"), (None, None, None, 50.0, 3.0, 600.0, 1.0, 60.0, None)]
    df = spark.createDataFrame(rows, schema)
    root = str(tmp_path)
    seen = []
    for _ in range(2):
        seen.append(CM.train_all(spark, {"engine": df}, root, 1, num_trees=5))
        preds = CM.predictions(spark, root, 1)
        assert preds.count() == 82 and preds.filter("predicted_anomaly IS NULL").count() == 2
    assert seen[0] == seen[1] and seen[0]["engine"]["tp"] + seen[0]["engine"]["fn"] == 5       # 0.3 x 18 rows
    other = str(tmp_path / "other")
    for empty in (df.filter("health_status = 'NOMINAL'"), df.limit(0)):
        assert CM.train_all(spark, {"engine": empty}, other, 1) == {"engine": None}
        assert CM.predictions(spark, other, 1).filter("predicted_anomaly IS NOT NULL").count() == 0
    assert CM.live_twins(spark, other) == []
    assert spec.alert_id == "ENG"


def test_refresh_takes_alerts_from_live_models(spark, sf, tmp_path):
    root = str(tmp_path / "models")
    frames = health_frames(spark, sf, COMP_KEYS)
    CM.train_all(spark, {k: frames[k] for k in TWINS}, root, 1, num_trees=5, parallel=2)
    paths = job.refresh(
        spark, D.sensor_readings(spark, sf), D.maintenance_events(spark, sf), D.model_reference(spark, sf),
        {k: D.COMPONENT_SOURCES[k](spark, sf) for k in COMP_KEYS}, maps.location(spark, sf),
        str(tmp_path / "gold"), RUN_TS, models_root=root)
    got = {r["component_id"]: r["count"] for r in spark.read.parquet(paths["unified_alerts"]).groupBy(
        "component_id").count().collect()}
    live = CM.live_twins(spark, root)
    scored = CM.score_live(spark, {k: frames[k] for k in live}, root)
    want = {k: scored.filter((F.col("component") == k) & (F.col("predicted_anomaly") == 1)).count() for k in live}
    for k in COMP_KEYS:
        n = want[k] if k in want else frames[k].filter("health_status <> 'NOMINAL'").count()
        assert got.get(S.COMPONENTS[k].alert_id, 0) == n, k
