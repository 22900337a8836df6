"""Sinks: versioned keyed upsert/delete, batch append, feature registration."""

import pytest
from pyspark.sql import functions as F

from fleetlens.sinks import tables as X


def test_versioned_upsert_delete(spark, tmp_path):
    root = str(tmp_path / "config_store")
    base = spark.createDataFrame([("dev", "a", "1"), ("dev", "b", "2"), ("prd", "a", "9")],
                                 "env string, config_key string, config_value string")
    assert X.upsert(spark, root, base, ["env", "config_key"]) == 0
    src = spark.createDataFrame([("dev", "b", "20"), ("dev", "c", "3")], base.schema)
    assert X.upsert(spark, root, src, ["env", "config_key"]) == 1
    cur = {(r.env, r.config_key): r.config_value for r in X.read_current(spark, root).collect()}
    assert cur == {("dev", "a"): "1", ("dev", "b"): "20", ("dev", "c"): "3", ("prd", "a"): "9"}
    X.upsert(spark, root, src, ["env", "config_key"])                 # idempotent
    again = {(r.env, r.config_key): r.config_value for r in X.read_current(spark, root).collect()}
    assert again == cur
    dup = spark.createDataFrame([("dev", "z", "1"), ("dev", "z", "2")], base.schema)
    with pytest.raises(Exception):
        X.upsert(spark, root, dup, ["env", "config_key"])
    assert X.read_current(spark, root).count() == 4                   # failed job left no version
    X.delete_where(spark, root, F.col("env") == "prd")
    assert X.read_current(spark, root).filter("env = 'prd'").count() == 0
    X.delete_where(spark, root, F.lit(True))
    assert X.read_current(spark, root).count() == 0


def test_append_batch_refuses_repeat(spark, tmp_path):
    path = str(tmp_path / "alerts")
    df = spark.createDataFrame([("A", 1, "2024-03-01")], "aircraft_id string, p int, alert_day string") \
        .withColumn("alert_day", F.to_date("alert_day"))
    X.append_batch(spark, df, path, "b1")
    X.append_batch(spark, df, path, "b2")
    with pytest.raises(ValueError):
        X.append_batch(spark, df, path, "b1")
    assert spark.read.parquet(path).count() == 2


def test_feature_registration(spark, tmp_path):
    df = spark.createDataFrame([("A", 1, 1.0), ("A", 1, 2.0), (None, 2, 3.0)], "id string, t int, x double")
    reg = str(tmp_path / "registry")
    X.register_feature_table(spark, df, str(tmp_path / "f1"), ["id", "t"], "t", reg, on_duplicate="dedupe")
    assert spark.read.parquet(str(tmp_path / "f1")).collect()[0].x == 2.0
    with pytest.raises(Exception):
        X.register_feature_table(spark, df, str(tmp_path / "f2"), ["id", "t"], "t", reg)
    assert spark.read.parquet(reg).count() == 1


def test_not_null_check_fails_job(spark):
    from fleetlens.operators.quality import validate_not_null
    ok = spark.createDataFrame([(1, 2)], "a int, b int")
    assert validate_not_null(ok, ["a", "b"]).count() == 1
    bad = spark.createDataFrame([(1, None)], "a int, b int")
    with pytest.raises(Exception):
        validate_not_null(bad, ["a", "b"]).collect()


def test_cluster_conf_sizing():
    from fleetlens.session import cluster_conf
    c = cluster_conf(100 * 2**40, executors=1000, cores_per_executor=8)
    parts = int(c["spark.sql.shuffle.partitions"])
    assert parts % 8000 == 0 and parts * (256 << 20) >= 100 * 2**40
    assert int(cluster_conf(10 << 20, 2, 4)["spark.sql.shuffle.partitions"]) == 16


def test_retried_upsert_keeps_each_key_once(spark, tmp_path, monkeypatch):
    """A write that breaks off, or is repeated, never doubles rows."""
    root = str(tmp_path / "t")
    base = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    X.upsert(spark, root, base, "k")
    broken = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int").withColumn(
        "v", F.when(F.col("k") == "c", F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception):
        X.upsert(spark, root, broken, "k")
    good = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    X.upsert(spark, root, good, "k")
    X.upsert(spark, root, good, "k")
    assert sorted(map(tuple, X.read_current(spark, root).collect())) == [("a", 1), ("b", 3), ("c", 4)]


@pytest.mark.parametrize("side", ["target", "source"])
def test_null_keys_are_refused(spark, side):
    good = spark.createDataFrame([("a", 1)], "k string, v int")
    bad = spark.createDataFrame([(None, 1)], "k string, v int")
    pair = (bad, good) if side == "target" else (good, bad)
    with pytest.raises(Exception, match="NULL key"):
        X.upsert_frame(*pair, ["k"]).collect()
