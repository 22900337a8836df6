"""Machine learning on tables (M-01 … M-13) with Spark ML.

Training, scoring and evaluation stay distributed: the scaler is a stage of
the saved ``PipelineModel`` (no training/serving skew, K14), scoring is a
``transform`` over every row (K15), metrics are confusion counts from one
aggregation.  The model registry is a small Parquet table.
"""

from __future__ import annotations

import json

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.asof import asof_join
from ..session import stored
from ..sources.files import read_path_or_empty

SENSOR_MODEL_FEATURES = [
    "engine_temp", "fuel_efficiency", "vibration", "altitude", "airspeed", "oil_pressure", "engine_rpm",
    "battery_voltage", "avg_engine_temp_7d", "avg_vibration_7d", "avg_rpm_7d", "prev_anomaly", "days_since_maint",
]


def training_set(labels: DataFrame, features: DataFrame, keys, feature_cols, label: str) -> DataFrame:
    """M-01 / J-09: label rows ⟕ feature table on keys (missing → NULL), NULLs dropped (P-10)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    j = labels.select(*keys, label).join(features.select(*keys, *feature_cols), keys, "left")
    return j.dropna(subset=[label, *feature_cols])


def point_in_time(labels: DataFrame, features: DataFrame, key: str, label_ts: str, feature_ts: str,
                  feature_cols, tie=None, bucket=None) -> DataFrame:
    """J-10: latest feature row at or before each label time (as-of join).

    Of feature rows at one time the greatest by ``tie`` counts (default: by
    the feature values), so the result does not depend on the order of rows."""
    tie = list(tie or feature_cols)
    f = features.select(F.col(key), F.col(feature_ts).alias("__fts"),
                        *dict.fromkeys([*feature_cols, *tie]))
    return asof_join(labels, f, keys=[key], left_on=label_ts, right_on="__fts",
                     right_cols=["__fts", *feature_cols], tie=tie, how="left",
                     bucket=bucket).withColumnRenamed("__fts", "feature_ts")


def forest_pipeline(features, label: str, num_trees: int = 100, seed: int = 42, max_depth: int = 5) -> Pipeline:
    """M-03 + M-04: assemble → standard-scale (with mean) → random forest."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="__raw", handleInvalid="skip"),
        StandardScaler(inputCol="__raw", outputCol="features", withMean=True, withStd=True),
        RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=num_trees, seed=seed,
                               maxDepth=max_depth, predictionCol="prediction_raw"),
    ])


def fit(train: DataFrame, features, label: str, classes: int | None = None, **kw) -> PipelineModel:
    """``classes``: labels are 0 to classes - 1, known beforehand (None: a pass
    over the rows finds out).  A forest reads ``train`` some five times, so it
    should be a stored table and not a chain of joins (``session.stored``)."""
    known = {} if classes is None else {"metadata": {"ml_attr": {
        "type": "nominal", "vals": [str(float(c)) for c in range(classes)]}}}
    return forest_pipeline(features, label, **kw).fit(
        train.select(*features, F.col(label).cast("double").alias(label, **known)))


def score(model: PipelineModel, df: DataFrame, out: str = "predicted_anomaly") -> DataFrame:
    """M-10: distributed batch scoring of every row."""
    s = model.transform(df)
    return s.withColumn(out, F.col("prediction_raw").cast("int")).drop(
        "__raw", "features", "rawPrediction", "probability", "prediction_raw")


def score_every(model: PipelineModel, df: DataFrame, out: str = "predicted_anomaly") -> DataFrame:
    """:func:`score` in one pass that keeps the rows with a missing feature (or
    NaN), which the assembler would skip; their prediction is NULL."""
    feats = input_columns(model)
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in feats])
    keeps = model.stages[0].copy().setHandleInvalid("keep")
    return score(PipelineModel([keeps, *model.stages[1:]]), df, out).withColumn(out, F.when(whole, F.col(out)))


def confusion_counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    """tp / fp / fn / tn in one aggregation."""
    y, p = F.col(label), F.col(pred)
    return df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                  F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))


def precision_recall_f1(df: DataFrame, label: str, pred: str) -> DataFrame:
    """M-05: metrics of class 1 (0 when undefined, as sklearn's zero_division=0)."""
    c = confusion_counts(df, label, pred)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    c = c.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))) \
        .otherwise(F.lit(0.0))
    return c.withColumn("f1", f1)


def metrics_by_version(df: DataFrame, label: str, predictions: dict, model: str) -> DataFrame:
    """M-05 / Q-13 for several versions in one pass: ``predictions`` maps a
    version number to its prediction column.  One aggregation counts all of
    them; the counts are turned into a row per version afterwards."""
    y = F.col(label)
    cells = {"tp": (1, 1), "fp": (0, 1), "fn": (1, 0), "tn": (0, 0)}
    counted = df.agg(*[F.count_if((y == a) & (p == b)).alias(f"{name}_{v}")
                       for v, p in predictions.items() for name, (a, b) in cells.items()])
    rows = counted.select(F.inline(F.array(*[
        F.struct(F.lit(v).alias("version"), *[F.col(f"{c}_{v}").alias(c) for c in cells]) for v in predictions])))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    recall = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    rows = rows.withColumns({"precision": precision, "recall": recall})
    total = F.col("precision") + F.col("recall")
    f1 = F.when(total > 0, 2 * F.col("precision") * F.col("recall") / total).otherwise(F.lit(0.0))
    return rows.withColumn("f1", f1).select(F.lit(model).alias("model"), "*")


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    """M-06: rows = label, columns = predicted class."""
    return (df.groupBy(F.col(label).alias("label")).pivot(pred, [0, 1]).count()
            .select("label", F.coalesce(F.col("0"), F.lit(0)).alias("pred_0"),
                    F.coalesce(F.col("1"), F.lit(0)).alias("pred_1")))


# ------------------------------------------------------------------ registry
def register(spark: SparkSession, model: PipelineModel, root: str, name: str, version: int,
             metrics: dict, params: dict | None = None, signature: DataFrame | None = None) -> str:
    """M-07: save the model under ``root/models/<name>/v=<version>`` and record
    it.  The record is a folder of its own per (model, version), overwritten by
    a repeated registration, so a version never has two rows.  ``signature``:
    a frame with the columns that the model was trained on; their names and
    types are recorded and checked by :func:`load`."""
    path = f"{root.rstrip('/')}/models/{name}/v={version}"
    model.write().overwrite().save(path)
    row = [(name, int(version), path, float(metrics.get("precision", 0.0)), float(metrics.get("recall", 0.0)),
            float(metrics.get("f1", 0.0)), str(params or {}), signature_of(model, signature))]
    spark.createDataFrame(row, "model string, version int, path string, precision double, recall double, "
                               "f1 double, params string, signature string").write.mode("overwrite").parquet(
        f"{root.rstrip('/')}/registry/entry={name}-v{int(version)}")
    return path


def signature_of(model: PipelineModel, df: DataFrame | None) -> str | None:
    """The input columns of the model and their types in ``df``, as JSON."""
    if df is None:
        return None
    return json.dumps({c: df.schema[c].dataType.simpleString() for c in input_columns(model)}, sort_keys=True)


def input_columns(model: PipelineModel) -> list[str]:
    return list(model.stages[0].getInputCols())


def check_signature(signature: str | None, df: DataFrame) -> None:
    """Raise if ``df`` lacks an input column of the model or has it in a type
    that is not the trained one (a model without a signature accepts any)."""
    wrong = []
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for c, t in json.loads(signature or "{}").items():
        if have.get(c) != t:
            wrong.append(f"{c}: {t} expected, {have.get(c, 'no such column')} given")
    if wrong:
        raise ValueError("input does not fit the model's signature: " + "; ".join(wrong))


_ALIAS = "model string, alias string, version int, move long"


def set_alias(spark: SparkSession, root: str, name: str, alias: str, version: int) -> None:
    """M-08: point ``alias`` of a model at a version that is registered.  A move
    is one new record in one file, numbered after the alias's last one, so
    readers see the old target or the new one."""
    if _record(spark, root, name, version) is None:
        raise ValueError(f"{name} has no version {version}")
    moves = read_path_or_empty(spark, f"{root.rstrip('/')}/aliases", _ALIAS)
    last = moves.filter((F.col("model") == name) & (F.col("alias") == alias)).agg(F.max("move")).first()[0]
    (spark.createDataFrame([(name, alias, int(version), 0 if last is None else last + 1)], _ALIAS).coalesce(1)
     .write.mode("append").parquet(f"{root.rstrip('/')}/aliases"))


def aliases(spark: SparkSession, root: str) -> DataFrame:
    """(``model``, ``alias``, ``version``): where every alias points now."""
    return read_path_or_empty(spark, f"{root.rstrip('/')}/aliases", _ALIAS).groupBy("model", "alias").agg(
        F.max_by("version", F.struct("move", "version")).alias("version"))


def _record(spark, root, name, version):
    reg = spark.read.option("mergeSchema", True).parquet(f"{root.rstrip('/')}/registry")
    return reg.filter((F.col("model") == name) & (F.col("version") == int(version))).first()


def champion(registry: DataFrame, metric: str = "f1") -> DataFrame:
    """M-08 / M-09: per model the best version by ``metric`` (ties → newest)."""
    return registry.groupBy("model").agg(
        F.max_by(F.struct("version", "path", metric), F.struct(metric, "version")).alias("c")).select(
        "model", F.col("c.version").alias("champion_version"), F.col("c.path").alias("path"),
        F.col(f"c.{metric}").alias(metric))


def newest(registry: DataFrame) -> DataFrame:
    """M-08: per model the alias to its highest version, whatever its metrics."""
    return registry.groupBy("model").agg(
        F.max("version").alias("newest_version"), F.max_by("path", "version").alias("path"))


def load(spark: SparkSession, root: str, name: str, version: int | str | None = None,
         check: DataFrame | None = None) -> PipelineModel:
    """M-08: load by version number, ``"newest"``, an alias, or the champion
    when ``version`` is None (one-row look-ups).  ``check``: the frame to be
    scored; a model whose signature it does not fit is refused."""
    reg = spark.read.option("mergeSchema", True).parquet(f"{root.rstrip('/')}/registry").filter(F.col("model") == name)
    if version is None:
        version = champion(reg).first()["champion_version"]
    elif version == "newest":
        version = newest(reg).first()["newest_version"]
    elif isinstance(version, str):
        found = aliases(spark, root).filter((F.col("model") == name) & (F.col("alias") == version)).first()
        if found is None:
            raise ValueError(f"{name} has no alias {version!r}")
        version = found["version"]
    record = _record(spark, root, name, version)
    if record is None:
        raise ValueError(f"{name} has no version {version}")
    if check is not None:
        check_signature(record.asDict().get("signature"), check)
    return PipelineModel.load(record["path"])


def component_training_frame(health_df: DataFrame, spec):
    """M-11: label = status is not NOMINAL, features = the spec's numeric metrics."""
    feats = [n for n, t in spec.metrics if t.typeName() in ("double", "integer")]
    return health_df.select(*feats, (F.col("health_status") != "NOMINAL").cast("double").alias("label")), feats


def train_component_models(frames: dict, specs: dict, num_trees: int = 100, seed: int = 42,
                           parallel: int = 3) -> dict:
    """M-11: one forest per component twin (each with its own features), fitted
    on its stored training rows, ``parallel`` twins at a time."""
    def one(key):
        train, feats = component_training_frame(frames[key], specs[key])
        return fit(stored(train.dropna(), f"train-{key}"), feats, "label", classes=2, num_trees=num_trees, seed=seed)

    if not frames:
        return {}
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        run = inheritable_thread_target(next(iter(frames.values())).sparkSession)(one)
        jobs = {key: pool.submit(run, key) for key in frames}
        return {key: job.result() for key, job in jobs.items()}


def score_components(frames: dict, models: dict) -> DataFrame:
    """M-11: every row of every twin scored by its own model: (component_type,
    aircraft_id, component_id, event_timestamp, health_status,
    predicted_anomaly).  Rows with a missing feature get a NULL prediction."""
    parts = []
    for key, df in frames.items():
        ids = ["aircraft_id", "component_id", "event_timestamp", "health_status"]
        parts.append(score_every(models[key], df).select(F.lit(key).alias("component"), *ids, "predicted_anomaly"))
    return reduce(DataFrame.unionByName, parts)
