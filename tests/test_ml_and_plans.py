"""ML round trip and physical-plan shape guards."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from fleetlens.ml import model as M
from fleetlens.plans.catalog import queries


def test_fit_register_champion(spark, sf, tmp_path):
    from fleetlens.plans.q_sensor import _chain
    feats = _chain(spark, sf)["features"].dropna(subset=M.SENSOR_MODEL_FEATURES + ["anomaly_score"])
    m1 = M.fit(feats, M.SENSOR_MODEL_FEATURES, "anomaly_score", num_trees=10)
    scored = M.score(m1, feats)
    assert scored.count() == feats.count()
    met = M.precision_recall_f1(scored, "anomaly_score", "predicted_anomaly").first().asDict()
    root = str(tmp_path)
    M.register(spark, m1, root, "engine", 1, met)
    M.register(spark, m1, root, "engine", 2, {**met, "f1": met["f1"] + 0.1})
    M.register(spark, m1, root, "engine", 3, {**met, "f1": -1.0})
    M.register(spark, m1, root, "engine", 3, {**met, "f1": -1.0})        # registered again: still one record
    reg = spark.read.parquet(f"{root}/registry")
    assert reg.count() == 3
    champ = M.champion(reg).first()
    assert champ.champion_version == 2
    assert M.newest(reg).first().newest_version == 3
    M.load(spark, root, "engine", "newest")
    loaded = M.load(spark, root, "engine")
    assert M.score(loaded, feats).filter("predicted_anomaly IS NULL").count() == 0


def test_confusion_metrics_brute_force(spark, sf):
    from fleetlens.sources import driver as D
    lab = D.table(spark, sf, "labels")
    pdf = lab.toPandas()
    tp = int(((pdf.quality == 1) & (pdf.toxic == 1)).sum())
    fp = int(((pdf.quality == 0) & (pdf.toxic == 1)).sum())
    fn = int(((pdf.quality == 1) & (pdf.toxic == 0)).sum())
    m = M.precision_recall_f1(lab, "quality", "toxic").first()
    assert (m.tp, m.fp, m.fn) == (tp, fp, fn)
    assert m.precision == pytest.approx(tp / (tp + fp) if tp + fp else 0.0)


def _plan(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_cartesian_products(spark, sf, name):
    if name.startswith(("stream_", "model_component_", "model_sensor_")) or name in ("rf_score", "header_report", "batch_append",
                                                          "mart_missing_tables"):
        pytest.skip("runs a job while building")
    p = _plan(queries()[name](spark, sf))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_sensor_chain_single_shuffle(spark, sf):
    p = _plan(queries()["latest_state"](spark, sf))
    assert p.count("Exchange hashpartitioning") == 1, p


def test_pushdown_and_pruning(spark, sf):
    p = _plan(queries()["clean_filter"](spark, sf))
    assert "PushedFilters: [IsNotNull(event_type), Not(EqualTo(event_type,signup))]" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>" in p
    p2 = _plan(queries()["null_key_count"](spark, sf))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in p2


def test_component_models(spark, sf):
    from fleetlens import schemas as S
    from fleetlens.plans.q_components import health_frames
    frames = health_frames(spark, sf, ["engine", "electrical"])
    models = M.train_component_models(frames, S.COMPONENTS, num_trees=5)
    assert set(models) == {"engine", "electrical"}
    train, feats = M.component_training_frame(frames["engine"], S.COMPONENTS["engine"])
    assert M.score(models["engine"], train).count() == train.count()


def test_chain_evaluated_once(spark, sf):
    # one scan each of readings and maintenance (events) and models (customer) for the chain
    for name in ("champion_select", "model_metrics", "status_map"):
        p = _plan(queries()[name](spark, sf))
        assert p.count("Window [") + p.count("Window(") <= 4, name
        assert p.count("events.parquet") <= 2, name


def test_scored_components_keep_rows_without_features(spark, sf):
    from fleetlens import schemas as S
    from fleetlens.plans.q_components import health_frames
    frames = health_frames(spark, sf, ["engine"])
    models = M.train_component_models(frames, S.COMPONENTS, num_trees=3)
    holed = {"engine": frames["engine"].withColumn(
        "oil_pressure", F.when(F.col("oil_pressure") > 50, F.col("oil_pressure")))}
    got = M.score_components(holed, models)
    assert got.count() == frames["engine"].count()
    assert got.filter("predicted_anomaly is null").count() == holed["engine"].filter("oil_pressure is null").count()


def test_nested_json():
    from fleetlens.functions.nested import flatten_json_deep
    from fleetlens.session import local_session
    s = local_session("*", 8)
    text = '{"a": {"b": {"c": "1"}, "e": {}}, "d": null, "l": [1, 2]}'
    got = {(r.config_key, r.config_value) for r in
           flatten_json_deep(s.createDataFrame([(1, text), (2, None)], "i int, j string"), ["i"], "j").collect()}
    assert got == {("a.b.c", "1"), ("a.e", "{}"), ("d", None), ("l", "[1,2]")}


def test_scoring_keeps_rows_with_a_missing_feature_in_one_scan(spark):
    """NULL and NaN features: the row stays, without a prediction; training
    with known classes takes a single-class table too."""
    rows = [(i, float(i % 2), float(i % 2)) for i in range(20)] + [(20, None, 1.0), (21, float("nan"), 0.0)]
    df = spark.createDataFrame(rows, "id int, a double, y double")
    model = M.fit(df, ["a"], "y", classes=2, num_trees=2)
    scored = M.score_every(model, df)
    got = {r.id: r.predicted_anomaly for r in scored.collect()}
    assert len(got) == 22 and got[20] is None and got[21] is None
    assert all(got[i] == i % 2 for i in range(20))
    assert "Union" not in scored._jdf.queryExecution().optimizedPlan().toString()


def test_stored_rows_are_evaluated_once(spark):
    from fleetlens.session import stored
    df = spark.range(50).selectExpr("id", "id % 3 AS k")
    kept = stored(df, "t")
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, df.collect()))
    assert "Range" not in kept._jdf.queryExecution().optimizedPlan().toString()


def test_finest_cube_level_is_not_expanded(spark):
    """An aircraft with two rows in the reference, one with none, a NULL one."""
    from fleetlens.plans import dashboards as Q
    view = spark.createDataFrame([(a, t, f"2024-01-0{d} 01:00:00", s) for a in (1, 2, None) for t in "xy" for d in (1, 2)
                                  for s in ("CRITICAL", "WARNING", "NOMINAL")],
                                 "aircraft_id long, component_type string, event_timestamp string, health_status string")
    view = view.selectExpr("aircraft_id", "component_type", "CAST(event_timestamp AS timestamp) event_timestamp", "health_status")
    cube = Q.fleet_cube(view, spark.createDataFrame([(1, "m", 7), (1, "n", 8)], "aircraft_id long, model string, airport int"))
    level = {(r.aircraft_id, r.component_type, r.day.day): (r.readings, r.critical, r.warning, r.mean_health)
             for r in Q.cube_level(cube, ["aircraft_id", "component_type", "day"]).collect()}
    assert len(level) == 12 and level[1, "x", 1] == (6, 2, 2, 70.0) and level[2, "y", 2] == level[None, "x", 1] == (3, 1, 1, 70.0)
    plan = cube._jdf.queryExecution().optimizedPlan().toString()
    expand = next(x for x in plan.splitlines() if "Expand" in x)
    assert expand.count("], [") == len(Q.CUBE_LEVELS) - 1      # all levels but one, and the list of outputs


def test_traces_and_summaries_sort_by_a_hash_and_keep_their_width(spark):
    from fleetlens.plans import alerts as A
    preds = spark.createDataFrame([("FS", a, "2024-01-01", "s", "CRITICAL", 1) for a in (1, 1, 2, None)],
                                  "component_id string, aircraft_id long, t string, source_component_id string, "
                                  "health_status string, predicted_anomaly int")
    preds = preds.selectExpr("component_id", "aircraft_id", "CAST(t AS timestamp_ntz) AS timestamp",
                             "source_component_id", "health_status", "predicted_anomaly")
    trace = A.traceability_from_predictions(preds, spark, "2024-02-01 00:00:00")
    found = A.lookup(trace, trace["aircraft_id"] == 1)
    assert trace.count() == 4 and found.count() == 2
    assert "xxhash64" in trace._jdf.queryExecution().optimizedPlan().toString()
    unified = A.unify_alerts(A.alerts_from_predictions(preds, "2024-02-01 00:00:00"), spark, "2024-02-01 00:00:00")
    summary = A.alert_summary(unified)
    assert [(r.alert_count, r.affected_aircraft_count) for r in summary.collect()] == [(4, 2)]
    assert "REPARTITION_BY_NUM" in summary._jdf.queryExecution().executedPlan().toString()


def test_lookup_inside_the_traceability_finds_the_same_rows(spark):
    """Ids shared by several keys, keys with several alerts, NULL keys, an unknown component."""
    from fleetlens.plans import alerts as A
    t = "2024-01-01 05:00:00"
    rows = [("ENG", 1, t, "e1", "CRITICAL", 1), ("ENG", 1, t, "e2", "WARNING", 1), ("ENG", 1, t, "e3", "NOMINAL", 0),
            ("ENG", 1, t + ".5", "e4", "WARNING", 1), ("ENG", 1, t + ".7", "e5", "NOMINAL", 0), ("FS", 1, t, "f", "WARNING", 1),
            ("LG", 2, t, "l", "WARNING", 1), ("LG", 2, t + ".5", None, None, None), ("XX", 1, t, "x", "WARNING", 1)]
    odd = [("FS", None, t, "n", "WARNING", 1), ("AF", 3, None, "n", "WARNING", 1)]
    run_ts = "2024-02-01 00:00:00"
    for kept, sought, found in ((rows, F.col("alert_category") == "CRITICAL", 4), (rows, F.col("timestamp") == t, 5),
                                (rows, F.col("component_id") == "XX", 0), (rows + odd, F.col("component_id") == "AF", None),
                                (rows + odd, F.col("aircraft_id") == 1, 4)):
        preds = spark.createDataFrame(kept, "component_id string, aircraft_id long, t string, source_component_id string, "
                                            "health_status string, predicted_anomaly int")
        preds = preds.select("component_id", "aircraft_id", F.col("t").cast("timestamp_ntz").alias("timestamp"),
                             *preds.columns[3:])
        want = A.lookup(A.traceability_from_predictions(preds, spark, run_ts), sought)
        got = A.traceability_from_predictions(preds, spark, run_ts, sought=sought)
        assert got.columns == want.columns and found in (None, got.count())
        assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)


def test_trace_lookup_shuffles_the_predictions_once(spark, tmp_path):
    import datetime as dt
    day = dt.datetime(2024, 1, 2)
    tables = {
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_mktsegment string", [(1, "c", 3, "m")]),
        "events": ("event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
                   [(1, day, 1, "signup", 200.0, '{"k": 1}'), (2, day, 1, "click", 600.0, '{"k": 99}'),
                    (3, day, 1, "view", 600.0, '{"k": 99}'), (4, day, None, "click", 10.0, '{"k": 60}')]),
        "orders": ("o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz",
                   [(1, 1, 500000.0, day), (2, 1, 500000.0, day), (3, 2, 1000.0, day)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz",
                     [(1, 1, 1, 1, 5.0, 100.0, 0.0, 0.0, "R", day)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    found = queries()["trace_lookup"](spark, str(tmp_path))
    got = sorted((r.component_id, r.aircraft_id, r.inf_source_component_id, r.inf_matches) for r in found.collect())
    assert got == [("AF", 1, "2", 2), ("AF", 1, "2", 2), ("ENG", 1, "2", 1), ("LG", 1, "2", 2), ("LG", 1, "2", 2),
                   ("LG", 2, "3", 1)]
    above = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].split("Union")[0]
    assert above.count("Exchange hashpartitioning") == 1
