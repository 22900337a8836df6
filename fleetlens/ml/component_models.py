"""Component models end to end (M-11 → M-12 → T-13): one forest per twin,
fitted on part of its rows, judged on the rest, registered, and its
predictions taken up by the alert mart.

Per twin: the rows are split once, exactly per class (the split is stored, so
fit and evaluation see the same one), the forest is fitted on the training
rows, every row is scored and written, the metrics are counted from the
*written* held-out predictions, and the version is registered with them and
with its signature.  The twins' jobs run side by side, each in a scheduler
pool of its own (fair sharing where ``spark.scheduler.mode`` is FAIR).  Every
write replaces a folder named by version and twin, so a repeated run gives the
same tables.

Rows with a missing feature or without a status are neither learned from nor
scored (NULL prediction).  A twin whose training rows hold fewer than two
classes gets no model; its predictions are NULL.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.sampling import stratified_split
from . import model as M

TEST_FRACTION = 0.3
ALIAS = "live"
IDS = ["aircraft_id", "component_id", "event_timestamp", "health_status"]


def model_name(twin: str) -> str:
    return f"component_{twin}"


def features_of(spec) -> list[str]:
    return [n for n, t in spec.metrics if t.typeName() in ("double", "integer")]


def _whole(cols):
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def split_rows(health: DataFrame, spec, fraction: float = TEST_FRACTION, seed: int = 42) -> DataFrame:
    """M-02 for a twin: its rows with ``label`` (status is not NOMINAL, NULL
    without a status) and ``is_test``; of a class of n rows ``round(fraction * n)``
    are held out, drawn by a hash of the whole row."""
    key = F.xxhash64("aircraft_id", "component_id", "event_timestamp", *spec.metric_names)
    label = (F.col("health_status") != S.HEALTH_NOMINAL).cast("int")
    df = health.withColumns({"label": label, "__class": F.coalesce(label, F.lit(-1)), "__key": key})
    return stratified_split(df, "__class", "__key", fraction, seed).drop("__class", "__key")


def _path(root: str, table: str, version: int, twin: str | None = None) -> str:
    path = f"{root.rstrip('/')}/{table}/v={int(version)}"
    return path if twin is None else f"{path}/component={twin}"


def train_twin(spark: SparkSession, health: DataFrame, twin: str, spec, root: str, version: int,
               fraction: float = TEST_FRACTION, num_trees: int = 100, seed: int = 42) -> dict | None:
    """Split, fit, score, judge and register one twin; its held-out metrics,
    or None where there was nothing to learn."""
    feats = features_of(spec)
    split = _path(root, "component_split", version, twin)
    split_rows(health, spec, fraction, seed).write.mode("overwrite").parquet(split)
    rows = spark.read.parquet(split)
    known = _whole([*feats, "label"])
    train = rows.filter(known & ~F.col("is_test")).select(*feats, "label")
    fitted = train.agg(F.count_distinct("label")).first()[0] > 1
    out = [*IDS, "label", "is_test"]
    if fitted:
        model = M.fit(train, feats, "label", classes=2, num_trees=num_trees, seed=seed)
        scored = M.score_every(model, rows).select(
            *out, F.when(F.col("label").isNotNull(), F.col("predicted_anomaly")).alias("predicted_anomaly"))
    else:
        scored = rows.select(*out, F.lit(None).cast("int").alias("predicted_anomaly"))
    where = _path(root, "component_predictions", version, twin)
    scored.write.mode("overwrite").parquet(where)
    if not fitted:
        return None
    held = spark.read.parquet(where).filter(F.col("is_test") & F.col("predicted_anomaly").isNotNull())
    metrics = M.precision_recall_f1(held, "label", "predicted_anomaly").first().asDict()
    M.register(spark, model, root, model_name(twin), version, metrics,
               {"num_trees": num_trees, "seed": seed, "test_fraction": fraction}, signature=train)
    return metrics


def train_all(spark: SparkSession, frames: dict, root: str, version: int, specs: dict | None = None,
              parallel: int = 3, **kw) -> dict:
    """:func:`train_twin` for every twin of ``frames`` (key → health frame),
    ``parallel`` at a time; then the alias ``live`` of each model moves to its
    champion.  Returns twin → held-out metrics (None: no model)."""
    specs = specs or S.COMPONENTS

    def one(twin):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", model_name(twin))
        return train_twin(spark, frames[twin], twin, specs[twin], root, version, **kw)

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        jobs = {twin: pool.submit(inheritable_thread_target(spark)(one), twin) for twin in frames}
        metrics = {twin: job.result() for twin, job in jobs.items()}
    if any(m is not None for m in metrics.values()):
        promote(spark, root)
    return metrics


def promote(spark: SparkSession, root: str, alias: str = ALIAS) -> None:
    """Point ``alias`` of every component model at its champion (one row a
    model; an alias that stands there already is left)."""
    best = M.champion(spark.read.parquet(f"{root.rstrip('/')}/registry")).select("model", "champion_version")
    now = M.aliases(spark, root).filter(F.col("alias") == alias).select("model", "version")
    moves = best.join(now, "model", "left").filter(
        F.col("model").startswith(model_name("")) & ~F.col("champion_version").eqNullSafe(F.col("version")))
    for r in moves.orderBy("model").collect():
        M.set_alias(spark, root, r["model"], alias, r["champion_version"])


def predictions(spark: SparkSession, root: str, version: int) -> DataFrame:
    """The written predictions of a version: ``component`` (twin), the row's
    ids and status, ``label``, ``is_test``, ``predicted_anomaly``."""
    return spark.read.parquet(_path(root, "component_predictions", version))


def live_twins(spark: SparkSession, root: str, alias: str = ALIAS) -> list[str]:
    """Twins whose model has ``alias`` (at most one a twin)."""
    names = {r["model"] for r in M.aliases(spark, root).filter(F.col("alias") == alias).select("model").collect()}
    return [k for k in S.COMPONENTS if model_name(k) in names]


def score_live(spark: SparkSession, frames: dict, root: str, alias: str = ALIAS) -> DataFrame:
    """Every row of every twin scored by its aliased model, whose signature the
    frame must fit; columns as :func:`model.score_components`."""
    models = {k: M.load(spark, root, model_name(k), alias, check=df) for k, df in frames.items()}
    return M.score_components(frames, models)


def predictions_long(scored: DataFrame) -> DataFrame:
    """Scored rows in the long form that the alert mart takes (K12), keyed by
    the mart's component ids."""
    ids = F.create_map(*[x for k, s in S.COMPONENTS.items() for x in (F.lit(k), F.lit(s.alert_id))])
    return scored.select(
        ids[F.col("component")].alias("component_id"), "aircraft_id", F.col("event_timestamp").alias("timestamp"),
        F.col("component_id").alias("source_component_id"), "health_status", "predicted_anomaly")
