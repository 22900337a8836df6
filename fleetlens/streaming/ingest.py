"""Incremental ingest with Structured Streaming (X-01 … X-05).

Each run processes only files not seen before (the checkpoint records them)
and stops when caught up (``availableNow``), which is exactly-once file
ingest; a rerun without new files adds nothing.  The stateless stages
(parse, clean, expectations, health rules) run inside the stream; row-frame
features come from keyed state (``state.py``) or from the incremental batch
refresh (``plans/incremental.py``), because Spark rejects non-time windows on
streams.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..operators.quality import clean, observe_expectations
from ..plans.components import component_alerts, health
from ..session import ensure_checkpoint_dir
from ..sources.files import parse_component, parse_maintenance, parse_sensor, read_path_or_empty


def csv_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """S-01 … S-11 as streams: header CSV with a fixed schema; a file whose
    header has other names or another order fails (as in batch)."""
    r = spark.readStream.option("header", True).option("enforceSchema", False).schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.csv(path)


def sensor_stream(spark, path) -> DataFrame:
    return parse_sensor(csv_stream(spark, path, S.RAW_SENSOR_SCHEMA))


def maintenance_stream(spark, path) -> DataFrame:
    """S-02 as a stream."""
    return parse_maintenance(csv_stream(spark, path, S.MAINTENANCE_SCHEMA))


def component_stream(spark, spec, path) -> DataFrame:
    return parse_component(csv_stream(spark, path, spec.raw_schema))


def parquet_stream(spark: SparkSession, directory: str, file_glob: str, schema) -> DataFrame:
    """Stream over Parquet drops in ``directory`` whose names match ``file_glob``."""
    return (spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
            .parquet(directory))


def clean_stream(raw: DataFrame) -> DataFrame:
    """X-02: expectations observed (warn-only) + cleaning filter."""
    return clean(observe_expectations(raw, name="sensor_expectations"))[0]


def run_available(df: DataFrame, sink_path: str, checkpoint: str, partition_by=None, fmt: str = "parquet"):
    """X-01: process every new file once, append to ``sink_path``, stop."""
    w = (df.writeStream.format(fmt).option("path", sink_path).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start()
    q.awaitTermination()
    return q


def alert_stream(readings: DataFrame, spec, sink_path: str, checkpoint: str):
    """X-04: continuous alerting – health rule on the stream, CRITICAL/WARNING
    rows appended per micro-batch (idempotent on the batch id)."""
    h = health(readings, spec).withColumn("component_type", F.lit(spec.component_type))
    alerts = component_alerts(h)

    def write(batch: DataFrame, epoch: int):
        # a retried epoch replaces its own partition instead of appending twice
        (batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(sink_path))

    q = (alerts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def scratch_location(spark: SparkSession, name: str) -> str:
    """A folder for stream sinks/checkpoints under the shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/streams/{name}-{uuid.uuid4().hex[:12]}"


def latest_state_stream(stream_df: DataFrame, root: str, checkpoint: str, keys, order):
    """X-05: keep a latest-row-per-key table current from a stream.

    A micro-batch writes only its own latest rows, to a folder of its epoch
    beside the table; a repeated epoch replaces its folder.  When the run has
    caught up, the changes that are not in the table yet are merged once into a
    new version (O-07): the table is rewritten per run, not per micro-batch.
    Merging changes twice gives the same rows, so a run that breaks off before
    or after its merge loses and doubles nothing."""
    from ..operators.windows import latest_by
    from ..sinks.tables import write_version
    changes, merged = _change_folders(root, checkpoint)

    def note(batch: DataFrame, epoch: int):
        (latest_by(batch, keys, order).withColumn("epoch", F.lit(epoch)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(changes))

    q = (stream_df.writeStream.foreachBatch(note).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    spark = stream_df.sparkSession
    new = _unmerged(spark, changes, merged, stream_df.schema)
    last = new.agg(F.max("epoch")).first()[0]
    current = _current_or_empty(spark, root, stream_df.schema)
    if last is not None or current is None:
        write_version(spark, root, _with_changes(current, new, keys, order))
    if last is not None:
        spark.createDataFrame([(last,)], "upto long").coalesce(1).write.mode("append").parquet(merged)
    return q


def read_latest(spark: SparkSession, root: str, checkpoint: str, keys, order, schema) -> DataFrame:
    """The table of :func:`latest_state_stream` with the changes that a run
    still going on, or broken off, has not merged yet."""
    new = _unmerged(spark, *_change_folders(root, checkpoint), schema)
    return _with_changes(_current_or_empty(spark, root, schema), new, keys, order)


def _change_folders(root: str, checkpoint: str) -> tuple[str, str]:
    # epochs count per checkpoint, so each checkpoint has its own folders
    own = f"{root.rstrip('/')}-changes/{uuid.uuid5(uuid.NAMESPACE_URL, checkpoint.rstrip('/')).hex}"
    return f"{own}/rows", f"{own}/merged"


def _current_or_empty(spark, root, schema):
    from ..sinks.tables import read_current
    try:
        return read_current(spark, root)
    except FileNotFoundError:
        return None


def _unmerged(spark, changes, merged, schema) -> DataFrame:
    upto = read_path_or_empty(spark, merged, "upto long").agg(F.max("upto")).first()[0]
    rows = read_path_or_empty(spark, changes, T.StructType([*schema.fields, T.StructField("epoch", T.LongType())]))
    return rows if upto is None else rows.filter(F.col("epoch") > upto)


def _with_changes(current, new, keys, order) -> DataFrame:
    from ..operators.windows import latest_by
    new = new.drop("epoch")
    return latest_by(new if current is None else current.unionByName(new), keys, order)
