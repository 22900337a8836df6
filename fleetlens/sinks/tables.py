"""Sinks and table maintenance (O-01 … O-11) on plain Parquet.

Keyed upsert / delete (MERGE without a table format): a change writes the
complete new content into a fresh folder ``v=<number>-<unique>`` under the table
root, by one ordinary Spark write.  Nothing is appended to an existing folder
and there is no log beside the data: a version exists once its write job has
committed its files, and readers take the highest one.  A failed or repeated
write therefore leaves the previous version or makes another whole one.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.quality import drop_null_keys
from ..operators.sampling import hash_uniform
from ..operators.windows import dedupe

VERSION_COL = "v"


def overwrite(df: DataFrame, path: str, partition_by=None, fmt: str = "parquet") -> None:
    """O-01 / O-03: overwrite (schema replaced); rebalanced into even files."""
    w = df.hint("rebalance").write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)


def append_batch(spark: SparkSession, df: DataFrame, path: str, batch_id: str,
                 partition_by=("alert_day",), fmt: str = "parquet") -> None:
    """O-02: append a batch stamped with ``batch_id``; a batch id already
    present in the target is refused (re-running a batch cannot duplicate).

    The batch id is the first partition column, so the check reads one folder
    and not the whole target."""
    try:
        existing = spark.read.format(fmt).load(path)
        if "batch_id" in existing.columns and not existing.filter(F.col("batch_id") == batch_id).isEmpty():
            raise ValueError(f"batch {batch_id} already appended to {path}")
    except Exception as e:  # noqa: BLE001
        if not any(x in str(e) for x in ("PATH_NOT_FOUND", "does not exist", "UNABLE_TO_INFER_SCHEMA")):
            raise
    (df.withColumn("batch_id", F.lit(batch_id)).write.mode("append").format(fmt)
     .partitionBy("batch_id", *(partition_by or ())).save(path))


def recreate_and_append(spark: SparkSession, df: DataFrame, path: str, condition, batch_id: str,
                        partition_by=("alert_day",)) -> None:
    """O-04: replace the table by the rows matching ``condition`` (the
    per-component alert tables), in one write, so no reader meets an empty
    table in between."""
    (df.filter(condition).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .partitionBy("batch_id", *(partition_by or ())).parquet(path))


# ----------------------------------------------------------- versioned tables
def _current_folder(spark: SparkSession, root: str):
    """Folder of the highest committed version, or None.  Only file names are
    listed (an empty version still has a file)."""
    try:
        files = spark.read.parquet(root).inputFiles()
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e) or "does not exist" in str(e):
            return None
        raise
    names = {part for f in files for part in f.split("/") if part.startswith(f"{VERSION_COL}=")}
    return f"{root.rstrip('/')}/{max(names)}" if names else None


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """Current content of a versioned table, with the schema of that version."""
    folder = _current_folder(spark, root)
    if folder is None:
        raise FileNotFoundError(root)
    return spark.read.parquet(folder)


def write_version(spark: SparkSession, root: str, df: DataFrame) -> int:
    """Write ``df`` as the next version, in a folder of its own."""
    folder = _current_folder(spark, root)
    nv = 0 if folder is None else int(folder.rsplit("=", 1)[1].split("-", 1)[0]) + 1
    df.write.mode("errorifexists").parquet(f"{root.rstrip('/')}/{VERSION_COL}={nv:012d}-{uuid.uuid4().hex}")
    return nv


def upsert_frame(target: DataFrame, source: DataFrame, keys, on_duplicate: str = "fail") -> DataFrame:
    """O-07 as a pure DataFrame: target rows whose key is not in ``source``,
    plus all source rows (last writer wins), in one shuffle on the key.

    Source keys must be unique: ``on_duplicate='fail'`` raises inside the job,
    ``'dedupe'`` keeps the greatest row per key.  A NULL key on either side
    raises: it could neither be replaced nor found again."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if on_duplicate == "dedupe":
        source = dedupe(source, keys)
    both = target.withColumn("__src", F.lit(0)).unionByName(
        source.select(*target.columns).withColumn("__src", F.lit(1)))
    w = Window.partitionBy(*keys)
    named = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])

    def fail(text):
        return F.raise_error(F.lit(text)).cast("boolean")

    # the checks sit in the filter predicate: a projected column would be pruned
    keep = (F.when(~named, fail(f"NULL key {keys}"))
            .when(F.col("__n") > 1, fail(f"duplicate key {keys}"))
            .otherwise((F.col("__src") == 1) | (F.col("__n") == 0)))
    return both.withColumn("__n", F.sum("__src").over(w)).filter(keep).drop("__n", "__src")


def assert_unique(df: DataFrame, keys, label: str = "key") -> DataFrame:
    """Rows pass through; a key occurring twice fails the job.  The check is a
    count per key (partial before its shuffle, a scalar for the rows), so the
    rows themselves neither shuffle nor wait for others of their key."""
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").agg(
        F.count(F.lit(1)).alias("n")).select("n").scalar()
    # the check sits in a filter predicate: a projected-then-dropped column
    # would be pruned by the optimizer and never evaluated
    return df.filter(F.when(twice == 0, F.lit(True))
                     .otherwise(F.raise_error(F.lit(f"duplicate {label} {keys}")).cast("boolean")))


def upsert(spark: SparkSession, root: str, source: DataFrame, keys, on_duplicate: str = "fail") -> int:
    """O-07 keyed upsert (single or batch) into a versioned table; returns the new version."""
    try:
        cur = read_current(spark, root)
    except FileNotFoundError:
        cur = spark.createDataFrame([], source.schema)
    return write_version(spark, root, upsert_frame(cur, source, keys, on_duplicate))


def delete_where(spark: SparkSession, root: str, condition) -> int:
    """O-08 keyed delete / clear all (``condition=F.lit(True)``)."""
    cur = read_current(spark, root)
    return write_version(spark, root, cur.filter(~F.coalesce(condition, F.lit(False))))


def delete_keys(target: DataFrame, keys_df: DataFrame, keys) -> DataFrame:
    """O-08 as a pure DataFrame: drop rows whose key is listed in ``keys_df``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return target.join(keys_df.select(*keys), keys, "left_anti")


def case_update(df: DataFrame, column: str, cases, otherwise=None) -> DataFrame:
    """O-10: in-place ``UPDATE … SET c = CASE …`` as a projection."""
    expr = None
    for cond, value in cases:
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return df.withColumn(column, expr.otherwise(F.col(column) if otherwise is None else otherwise))


def shift_dates(df: DataFrame, cols, days: int) -> DataFrame:
    """O-11: rewrite with dates/timestamps shifted by ``days``."""
    out = df
    for c in ([cols] if isinstance(cols, str) else cols):
        out = out.withColumn(c, F.col(c) + F.make_interval(days=F.lit(days)))
    return out


# --------------------------------------------------------- feature registration
def validate_feature_table(df: DataFrame, keys, on_duplicate: str = "fail") -> DataFrame:
    """O-06 checks: NULL keys dropped (P-09); duplicate primary keys fail the
    job or are deduplicated (K6)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    clean_df = drop_null_keys(df, keys)
    if on_duplicate == "dedupe":
        return dedupe(clean_df, keys)
    return assert_unique(clean_df, keys, "primary key")


def register_feature_table(spark: SparkSession, df: DataFrame, path: str, keys, time_key=None,
                           registry_path: str | None = None, description: str = "",
                           on_duplicate: str = "fail") -> None:
    """O-06: validate, write, and record (path, keys, time key) in a registry
    table: one folder per table path, overwritten when registered again."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    overwrite(validate_feature_table(df, keys, on_duplicate), path)
    if registry_path:
        row = [(path, ",".join(keys), time_key or "", description)]
        entry = uuid.uuid5(uuid.NAMESPACE_URL, path).hex
        spark.createDataFrame(row, "table_path string, primary_keys string, timestamp_key string, "
                                   "description string").write.mode("overwrite").parquet(
            f"{registry_path.rstrip('/')}/entry=t{entry}")


def random_shift(df: DataFrame, cols, key: str, max_days: int, seed: int = 42) -> DataFrame:
    """O-11 / F-07: dates moved by 0 to ``max_days`` days, drawn per row from a
    keyed hash, so a repeated run gives the same dates."""
    days = F.floor(hash_uniform(key, seed) * (max_days + 1)).cast("int")
    return df.withColumns({c: F.col(c) + F.make_interval(days=days)
                           for c in ([cols] if isinstance(cols, str) else cols)})


def write_bucketed(df: DataFrame, table: str, path: str, keys, buckets: int) -> None:
    """J-09 / O-06: a feature table bucketed and sorted by its keys.  Look-ups
    join it without shuffling or sorting the table again; only the label side
    moves, to as many partitions as there are buckets."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    (df.repartition(buckets, *keys).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
