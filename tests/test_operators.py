"""Operator properties checked against brute force on small inputs."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlens import schemas as S
from fleetlens.functions.rules import classify, classify_columns
from fleetlens.operators.asof import asof_join
from fleetlens.operators.sampling import sample_n, stratified_split
from fleetlens.operators.sets import select_or_null
from fleetlens.operators.windows import dedupe, rolling_features
from fleetlens.plans.sensor import day_bucket, month_bucket


def _rows(df, order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture(scope="module")
def asof_fixture(spark):
    d = dt.date
    readings = spark.createDataFrame([
        ("A", dt.datetime(2024, 1, 1, 8), 1),    # before first maintenance
        ("A", dt.datetime(2024, 1, 5, 8), 2),    # same day as one
        ("A", dt.datetime(2024, 2, 1, 8), 3),    # after two
        ("B", dt.datetime(2024, 1, 3, 8), 4),    # aircraft without maintenance
        ("C", dt.datetime(2024, 3, 3, 8), 5),
    ], "aircraft_id string, timestamp timestamp, rid int")
    maint = spark.createDataFrame([
        ("A", d(2024, 1, 5), "Routine Check", 10),
        ("A", d(2024, 1, 20), "Engine Repair", 11),
        ("A", d(2024, 1, 20), "Routine Check", 12),   # tie on the date: greater tie wins
        ("C", d(2024, 1, 1), "Routine Check", 13),
        ("C", d(2024, 4, 1), "Engine Repair", 14),    # after the reading
    ], "aircraft_id string, maint_date date, event_type string, maint_id int")
    return readings, maint


@pytest.mark.parametrize("how", ["inner", "left"])
def test_asof_variants_agree(spark, asof_fixture, how):
    r, m = asof_fixture
    kw = dict(keys=["aircraft_id"], left_on=F.to_date("timestamp"), right_on="maint_date",
              right_cols=["maint_date", "event_type", "maint_id"], tie=["maint_id"], how=how)
    a = _rows(asof_join(r, m, **kw), ["rid"])
    b = _rows(asof_join_ranked(r, m, **kw), ["rid"])
    c = _rows(asof_join(r, m, bucket=month_bucket, **kw), ["rid"])
    d_ = _rows(asof_join(r, m, bucket=day_bucket, **kw), ["rid"])
    assert a == b == c == d_
    got = {x[2]: x[5] for x in a}
    assert got[2] == 10 and got[3] == 12 and got[5] == 13
    if how == "inner":
        assert set(got) == {2, 3, 5}
    else:
        assert got[1] is None and got[4] is None


def test_rolling_halo_matches_plain_under_skew(spark):
    rnd = random.Random(7)
    rows = []
    base = dt.datetime(2024, 1, 1)
    for i in range(3000):            # one hot key holds most rows
        key = "HOT" if rnd.random() < 0.8 else f"K{rnd.randint(0, 5)}"
        ts = base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 40))
        rows.append((key, ts, i, rnd.random() * 100 if rnd.random() > 0.05 else None))
    df = spark.createDataFrame(rows, "k string, ts timestamp, id int, x double")
    kw = dict(keys=["k"], order=["ts", "id"], lags={"px": "x"}, avgs={"ax": "x"}, n=7)
    plain = rolling_features(df, **kw).select("id", "px", F.round("ax", 9).alias("ax"))
    halo = rolling_features(df, bucket=day_bucket, **kw).select("id", "px", F.round("ax", 9).alias("ax"))
    assert _rows(plain, ["id"]) == _rows(halo, ["id"])
    # brute force for one key
    pdf = pd.DataFrame(rows, columns=["k", "ts", "id", "x"]).sort_values(["k", "ts", "id"])
    pdf["ax"] = pdf.groupby("k")["x"].transform(lambda s: s.rolling(7, min_periods=1).mean()).round(9)
    got = {r[0]: r[2] for r in _rows(plain, ["id"])}
    for _, r in pdf.iterrows():
        exp = None if pd.isna(r.ax) else r.ax
        assert got[r.id] == pytest.approx(exp) if exp is not None else got[r.id] is None


def test_dedupe_total_order_and_idempotent(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, 2, "z"), (2, None, "q"), (2, 5, None)],
                               "k int, o int, v string")
    once = dedupe(df, ["k"], ["o"])
    assert _rows(once, ["k"]) == [(1, 2, "z"), (2, 5, None)]
    assert _rows(dedupe(once, ["k"], ["o"]), ["k"]) == _rows(once, ["k"])


def test_stratified_split_exact(spark):
    rows = [(i, 1 if i % 7 == 0 else 0) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, y int")
    out = stratified_split(df, "y", "id", 0.3, 42, buckets=16).groupBy("y", "is_test").count().collect()
    counts = {(r.y, r.is_test): r["count"] for r in out}
    for y in (0, 1):
        n = sum(v for (yy, _), v in counts.items() if yy == y)
        assert counts[(y, True)] == round(n * 0.3)
    a = stratified_split(df, "y", "id", 0.3, 42, buckets=16).filter("is_test").select("id").collect()
    b = stratified_split(df.repartition(5), "y", "id", 0.3, 42, buckets=1024).filter("is_test").select("id").collect()
    assert sorted(a) == sorted(b)


def test_sample_is_deterministic(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    a = sorted(r.k for r in sample_n(df, 50, "k").collect())
    b = sorted(r.k for r in sample_n(df.repartition(7), 50, "k").collect())
    assert a == b and len(a) == 50


def _py_rule(spec, row):
    def fire(rule):
        name, op, v = rule
        x = row.get(name)
        if x is None:
            return False
        if op == ">":
            return x > v
        if op == "<":
            return x < v
        if op == "=":
            return x == v
        return x in v
    if any(fire(r) for r in spec.critical):
        return "CRITICAL"
    if any(fire(r) for r in spec.warning):
        return "WARNING"
    return "NOMINAL"


@pytest.mark.parametrize("key", sorted(S.COMPONENTS))
def test_health_rule_boundaries(spark, key):
    spec = S.COMPONENTS[key]
    neutral = {}
    for n, t in spec.metrics:
        neutral[n] = None
    rows = []
    for rule in (*spec.critical, *spec.warning):
        name, op, v = rule
        if op == "in" or isinstance(v, str):
            vals = list(v) if op == "in" else [v]
            cands = vals + ["OTHER", None]
        else:
            cands = [v, v - 0.001, v + 0.001, None]
        for c in cands:
            r = dict(neutral)
            r[name] = c
            rows.append(r)
    schema = ", ".join(f"{n} {'string' if t == S.S else ('int' if t == S.I else 'double')}"
                       for n, t in spec.metrics)
    def cv(x, t):
        if x is None or t == S.S:
            return x
        return int(x) if t == S.I else float(x)
    conv = [tuple(cv(r[n], t) for n, t in spec.metrics) for r in rows]
    df = spark.createDataFrame(conv, schema)
    got = [x[0] for x in df.select(classify(spec.critical, spec.warning)).collect()]
    got2 = [x[0] for x in df.select(classify_columns(spec.critical, spec.warning)).collect()]
    exp = [_py_rule(spec, dict(zip([n for n, _ in spec.metrics], c))) for c in conv]
    assert got == exp == got2


def test_select_or_null_types(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    out = select_or_null(df, [("a", T.LongType()), ("c", T.DateType()), ("d", T.StringType(), "dflt")])
    assert [f.dataType for f in out.schema.fields] == [T.LongType(), T.DateType(), T.StringType()]
    assert tuple(out.first()) == (1, None, "dflt")


def test_flatten_struct(spark):
    from fleetlens.functions.nested import flatten_struct_kv
    df = spark.createDataFrame([("dev", (("x", 1), "y"))],
                               "env string, cfg struct<db: struct<host: string, port: int>, name: string>")
    out = sorted(tuple(r) for r in flatten_struct_kv(df, ["env"], "cfg").collect())
    assert out == [("dev", "db.host", "x"), ("dev", "db.port", "1"), ("dev", "name", "y")]


def asof_join_ranked(left, right, keys, left_on, right_on, right_cols, tie=None, how="inner"):
    """Plain oracle: every earlier right row per left row, then the last one."""
    lo = F.col(left_on) if isinstance(left_on, str) else left_on
    ro = F.col(right_on) if isinstance(right_on, str) else right_on
    l = left.withColumn("__lid", F.monotonically_increasing_id()).withColumn("__lo", lo)
    r = right.select(*[F.col(k).alias(f"__rk_{k}") for k in keys], ro.alias("__ro"),
                     *[F.col(c) for c in right_cols],
                     *[F.col(t).alias(f"__rt{i}") for i, t in enumerate(tie or [])])
    j = l.join(r, [l[k] == r[f"__rk_{k}"] for k in keys] + [r["__ro"] <= l["__lo"]], "left")
    w = Window.partitionBy("__lid").orderBy(F.col("__ro").desc_nulls_last(),
                                            *[F.col(f"__rt{i}").desc() for i in range(len(tie or []))])
    j = j.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1")
    if how == "inner":
        j = j.filter(F.col("__ro").isNotNull())
    return j.select(*left.columns, *right_cols)


def _null_history(spark):
    """One hot key, ties, NULL keys and NULL times on both sides."""
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(900):
        key = None if i % 17 == 0 else "HOT" if i % 3 else f"K{i % 5}"
        ts = None if i % 13 == 0 else base + dt.timedelta(hours=rnd.randint(0, 24 * 30))
        rows.append((key, ts, i, float(rnd.randint(0, 99)) if i % 7 else None))
    right = [(k, d, i) for i, (k, d) in enumerate(
        [("HOT", dt.date(2024, 1, 5)), ("HOT", dt.date(2024, 1, 5)), ("HOT", None), (None, dt.date(2024, 1, 2)),
         ("K1", dt.date(2024, 1, 9)), (None, None), ("K2", dt.date(2023, 12, 1))])]
    return (spark.createDataFrame(rows, "k string, ts timestamp, id int, x double").repartition(5),
            spark.createDataFrame(right, "k string, d date, mid int"))


@pytest.mark.parametrize("bucket", ["day", "month", "range", "range_many"])
def test_split_windows_equal_plain_with_nulls(spark, bucket):
    from fleetlens.operators import skew as K
    df, _ = _null_history(spark)
    b = {"day": K.day_bucket, "month": K.month_bucket, "range": K.RangeParts(), "range_many": K.RangeParts(60)}[bucket]
    kw = dict(keys=["k"], order=["ts", "id"], lags={"px": "x"}, avgs={"ax": "x"}, n=4)
    plain = rolling_features(df, **kw).select("k", "ts", "id", "px", F.round("ax", 9).alias("ax"))
    split = rolling_features(df, bucket=b, **kw).select(*plain.columns[:4], F.round("ax", 9).alias("ax"))
    assert plain.count() == split.count() == 900
    assert _rows(plain, ["id"]) == _rows(split, ["id"])
    kw = dict(keys=["k"], order=["ts"], avgs={"ax": "x"}, frame="range", range_col="ts", range_seconds=3 * 86400 + 7)
    plain = rolling_features(df, **kw).select("k", "ts", "id", F.round("ax", 9).alias("ax"))
    split = rolling_features(df, bucket=b, **kw).select("k", "ts", "id", F.round("ax", 9).alias("ax"))
    assert _rows(plain, ["id"]) == _rows(split, ["id"])


@pytest.mark.parametrize("how", ["inner", "left"])
def test_asof_never_matches_nulls(spark, how):
    from fleetlens.operators import skew as K
    df, right = _null_history(spark)
    kw = dict(keys=["k"], left_on=F.to_date("ts"), right_on="d", right_cols=["d", "mid"], tie=["mid"], how=how)
    want = _rows(asof_join_ranked(df, right, **kw), ["id"])
    assert _rows(asof_join(df, right, **kw), ["id"]) == want
    for b in (K.day_bucket, K.RangeParts(), K.RangeParts(60)):
        assert _rows(asof_join(df, right, bucket=b, **kw), ["id"]) == want
    assert len(want) == 900 if how == "left" else all(r[0] is not None and r[1] is not None for r in want)


def test_split_plans_read_their_input_once(spark, sf):
    """The rows behind both branches of a split plan come from one exchange."""
    from fleetlens.sources import driver as D
    from fleetlens.operators.skew import RangeParts
    scans = spark.sparkContext.accumulator(0)

    def count(batches):
        scans.add(1)
        yield from batches

    df = D.sensor_readings(spark, sf).select("aircraft_id", "timestamp", "engine_temp", "reading_id").coalesce(1)
    for bucket, reads in ((month_bucket, 1), (RangeParts(6), 2)):       # a range cut samples its input first
        before = scans.value
        counted = df.mapInArrow(count, df.schema)
        out = rolling_features(counted, ["aircraft_id"], ["timestamp", "reading_id"], lags={"p": "engine_temp"},
                               avgs={"a": "engine_temp"}, bucket=bucket)
        assert out.count() == df.count()
        out.write.format("noop").mode("overwrite").save()
        assert scans.value - before <= 2 * reads


def test_hot_key_is_spread_by_range_parts(spark):
    from pyspark.sql import functions as F
    from fleetlens.operators.skew import RangeParts, with_part
    df = spark.range(6000).select(F.lit(1).alias("k"), F.timestamp_seconds("id").alias("ts"))
    sizes = [r["count"] for r in with_part(df, ["k"], [F.col("ts")], RangeParts(12), "p").groupBy("p").count().collect()]
    assert len(sizes) == 12 and max(sizes) < 1000
