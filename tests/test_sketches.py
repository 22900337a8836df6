"""Mergeable sketches, the fleet cube, bucketed look-ups and the registry."""

import io
from contextlib import redirect_stdout

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.ml import drift as DR
from fleetlens.ml import model as M
from fleetlens.operators import distinct as DC
from fleetlens.plans import dashboards as Q
from fleetlens.sinks import tables as X


def test_quantiles_of_merged_sketches_within_the_stated_error(spark):
    """Far more rows than a sketch keeps, in 30 windows of unequal size."""
    k = 256
    df = spark.range(120_000).select(
        F.floor(F.sqrt(F.col("id") / 140)).alias("day"), (F.rand(3) ** 4).alias("share"),
        F.when(F.col("id") % 7 > 0, F.randn(5) * 50 + 600).alias("temp"), F.lit(None).cast("double").alias("none"))
    df = df.cache()
    s = DR.feature_sketches(df, "day", ["share", "temp", "none"], k).cache()
    quantiles = (0.05, 0.5, 0.95)
    got = {r.feature: r for r in DR.figures(DR.merged(s.filter("day >= 3"), k=k), quantiles).collect()}
    pdf = df.filter("day >= 3").toPandas()
    for c in ("share", "temp"):
        values = np.sort(pdf[c].dropna().to_numpy())
        assert got[c].mean == pytest.approx(values.mean()) and got[c].stddev == pytest.approx(values.std(ddof=1))
        for q in quantiles:
            rank = np.searchsorted(values, got[c][f"p{round(100 * q)}"], side="right") / len(values)
            assert abs(rank - q) < DR.rank_error(k)
    assert got["none"].mean is None and got["none"].p50 is None and got["none"].stddev is None


def test_small_windows_are_exact_and_need_no_readings(spark):
    rows = [(d, float(x * x % 17) / 17) for d in range(6) for x in range(d)] + [(9, None)]
    df = spark.createDataFrame(rows, "day int, v double")
    s = DR.feature_sketches(df, "day", ["v"])
    report = {r.day: r for r in DR.drift_report(s, "day", F.col("day") < 4).collect()}
    ref = sorted(v for d, v in rows if d < 4)
    assert report[5].ref_p50 == ref[-(-len(ref) // 2) - 1] and report[9].p50 is None and set(report) == {4, 5, 9}
    assert DR.drift_report(s.limit(0), "day", F.col("day") < 4).count() == 0


def test_rolling_distinct_equals_exact(spark):
    import datetime as dt
    rng = np.random.Generator(np.random.PCG64(2))
    rows = [(["a", "b", None][int(rng.integers(3))], dt.date(2024, 1, 1) + dt.timedelta(int(d)), int(v))
            for d, v in zip(rng.integers(0, 60, 900), rng.integers(0, 70, 900))] + [("a", dt.date(2024, 1, 4), None)]
    df = spark.createDataFrame(rows, "k string, d date, v long")
    got = {(r.k, r.window_end, r.days): (r.rows, r.distinct_values) for r in DC.rolling_distinct(
        DC.daily_sketches(df, ["k"], "d", "v"), ["k"], (1, 7, 30)).collect()}
    want = {}
    for k, end in {(r[0], r[1]) for r in rows}:
        for days in (1, 7, 30):
            held = [r[2] for r in rows if r[0] == k and 0 <= (end - r[1]).days < days]
            want[k, end, days] = (len(held), len({v for v in held if v is not None}))
    assert got == want


def test_cube_levels_and_filters(spark, sf):
    from fleetlens.plans.q_components import view
    from fleetlens.plans.q_dash import _fleet_cube
    cube = _fleet_cube(spark, sf).cache()
    total = view(spark, sf).count()
    assert Q.cube_level(cube, []).first().readings == total
    assert Q.cube_level(cube, ["component_type"]).agg(F.sum("readings")).first()[0] == total
    one = Q.cube_level(cube, ["model", "component_type", "day"], component_type="ENGINE")
    assert one.columns[:3] == ["model", "component_type", "day"]
    with pytest.raises(ValueError):
        Q.cube_level(cube, ["day"])
    with pytest.raises(ValueError):
        Q.cube_level(cube, ["component_type"], airport=1)


def test_bucketed_table_is_not_shuffled_for_a_look_up(spark, sf, tmp_path):
    from fleetlens.sources import driver as D
    feats = D.sensor_readings(spark, sf).select("aircraft_id", "timestamp", "engine_temp").dropDuplicates(
        ["aircraft_id", "timestamp"])
    X.write_bucketed(feats, "look_up_features", str(tmp_path / "f"), ["aircraft_id", "timestamp"], 16)
    labels = D.sensor_readings(spark, sf).select("aircraft_id", "timestamp", F.col("anomaly_score").alias("label"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = M.training_set(labels, spark.table("look_up_features"), ["aircraft_id", "timestamp"], ["engine_temp"],
                                "label")
        buf = io.StringIO()
        with redirect_stdout(buf):
            joined.explain()
        plan = buf.getvalue()
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan     # the label side only
        assert joined.count() == M.training_set(labels, feats, ["aircraft_id", "timestamp"], ["engine_temp"],
                                                "label").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE look_up_features")


def test_signature_and_alias(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(60).select(F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("int").alias("b"),
                                (F.col("id") % 2).cast("double").alias("y"))
    m = M.fit(df, ["a", "b"], "y", num_trees=2)
    for v in (1, 2):
        M.register(spark, m, root, "eng", v, {"f1": v / 10}, signature=df)
    assert M.load(spark, root, "eng", check=df.withColumn("more", F.lit(1))).stages
    for wrong in (df.drop("b"), df.withColumn("b", F.col("b").cast("string"))):
        with pytest.raises(ValueError, match="signature"):
            M.load(spark, root, "eng", 1, check=wrong)
    with pytest.raises(ValueError):
        M.set_alias(spark, root, "eng", "prod", 3)
    for v in (1, 2, 1):
        M.set_alias(spark, root, "eng", "prod", v)
        M.set_alias(spark, root, "eng", "next", 2)
        assert {(r.alias, r.version) for r in M.aliases(spark, root).collect()} == {("prod", v), ("next", 2)}
    assert M.load(spark, root, "eng", "prod", check=df).stages
    with pytest.raises(ValueError):
        M.load(spark, root, "eng", "nobody")


def test_assert_unique_neither_shuffles_rows_nor_lets_twins_pass(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 50)
    with pytest.raises(Exception, match="duplicate"):
        X.assert_unique(df, ["k"]).collect()
    assert X.assert_unique(df, ["id"]).count() == 100
    assert X.assert_unique(df.limit(0), ["id"]).count() == 0


def test_traceability_forms_agree_on_odd_rows(spark):
    """Repeated predictions, NULL keys, NULL predictions, several alerts of one key."""
    import datetime as dt
    from fleetlens.plans import alerts as A
    t = dt.datetime(2024, 1, 5, 3)
    rows = [("ENG", "1", t, "e1", "CRITICAL", 1), ("ENG", "1", t, "e2", "WARNING", 1), ("ENG", "1", t, "e3", "NOMINAL", 0),
            ("ENG", "2", t, None, None, None), ("AC", "1", t, None, "HIGH_RISK", 1), ("AC", "1", t, None, "HIGH_RISK", 1),
            ("FS", None, t, "f", "WARNING", 1), ("FS", "3", None, "f", "WARNING", 1), ("XX", "1", t, "x", "WARNING", 1)]
    preds = spark.createDataFrame(rows, "component_id string, aircraft_id string, timestamp timestamp_ntz, "
                                        "source_component_id string, health_status string, predicted_anomaly int")
    run_ts = "2024-02-01 00:00:00"
    joined = A.traceability(A.unify_alerts(A.alerts_from_predictions(preds, run_ts), spark, run_ts), preds, run_ts)
    one = A.traceability_from_predictions(preds, spark, run_ts).select(*joined.columns)
    got, want = (sorted(map(tuple, x.collect()), key=repr) for x in (one, joined))
    assert got == want and len(got) == 6
