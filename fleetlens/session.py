"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "fleetlens", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (cluster jobs get theirs from spark-submit)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g"))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster the folder is configured by the operator and must be shared
    storage; unset, a single-process session (tests) gets a scratch folder and
    any other fails.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="fleetlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    try:
        spark.conf.set("spark.checkpoint.dir", path)
    except Exception:  # noqa: BLE001 - some deployments refuse runtime core confs
        pass
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df):
    """Reliable checkpoint into ``spark.checkpoint.dir`` (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, name: str):
    """``df`` written once under ``spark.checkpoint.dir`` and read from there, for
    work that reads its input many times (columns, unlike a checkpoint)."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/stored/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 << 20) -> dict:
    """Spark settings sized for a run over ``input_bytes`` of Parquet.

    * scan splits of ``target_partition_bytes`` (``files.maxPartitionBytes``);
    * initial shuffle partitions so that each holds about the target size of
      the largest shuffle (the sensor chain shuffles roughly its input once),
      rounded up to a multiple of the total cores and never fewer than
      2 × cores; AQE then coalesces small partitions and splits skewed join
      partitions (> 5 × median and > 1 GiB);
    * broadcast threshold kept modest (64 MiB) – only bounded reference
      frames are broadcast by name, the rest is AQE's runtime choice.
    """
    cores = max(1, executors * cores_per_executor)
    parts = max(2 * cores, -(-input_bytes // target_partition_bytes))
    parts = -(-parts // cores) * cores
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
    }
