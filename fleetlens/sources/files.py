"""File and table sources (S-01 … S-16, S-21, P-19)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.scalars import parse_date, parse_ts


def read_csv(spark: SparkSession, path: str, schema=None, header: bool = True) -> DataFrame:
    """S-12 / S-13: batch CSV read; with a schema nothing is inferred, without
    one every column is a string."""
    r = spark.read.option("header", header)
    if schema is not None:
        r = r.schema(schema).option("enforceSchema", False)
    return r.csv(path)


def parse_sensor(df: DataFrame) -> DataFrame:
    """S-01 post-processing: text timestamp → timestamp (malformed → NULL)."""
    return df.withColumn("timestamp", parse_ts("timestamp"))


def parse_maintenance(df: DataFrame) -> DataFrame:
    """S-02 post-processing: text date → DATE (K4)."""
    return df.withColumn("event_date", parse_date("event_date"))


def parse_component(df: DataFrame) -> DataFrame:
    return df.withColumn("event_timestamp", parse_ts("event_timestamp"))


def read_sensor_csv(spark, path) -> DataFrame:
    return parse_sensor(read_csv(spark, path, S.RAW_SENSOR_SCHEMA))


def read_maintenance_csv(spark, path) -> DataFrame:
    return parse_maintenance(read_csv(spark, path, S.MAINTENANCE_SCHEMA))


def read_component_csv(spark, spec, path) -> DataFrame:
    """S-03 … S-11 in batch: one spec-driven reader for all nine twins."""
    return parse_component(read_csv(spark, path, spec.raw_schema))


def read_latest_file(spark: SparkSession, path: str, schema=None, fmt: str = "csv") -> DataFrame:
    """S-14: the rows of the newest drop under ``path``.

    A drop is a file in ``path`` itself or a folder in it with all its part
    files.  Only file names and times are listed to find it (no content is
    read), and only the newest drop is read."""
    root = path.rstrip("/")
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
              .select("path", "modificationTime"))
    newest = listed.agg(F.max_by("path", F.struct("modificationTime", "path"))).first()[0]
    if newest is None:
        raise FileNotFoundError(path)
    tail = newest.split(root.split(":", 1)[-1].rstrip("/") + "/", 1)[1]
    r = spark.read.option("header", True)
    if schema is not None:
        r = r.schema(schema)
    return r.format(fmt).load(f"{root}/{tail.split('/', 1)[0]}")


def read_table_or_empty(spark: SparkSession, name: str, schema) -> DataFrame:
    """S-16: read a table, or an empty frame of ``schema`` when it does not exist.

    Only a missing table is tolerated; any other error surfaces."""
    if spark.catalog.tableExists(name):
        return spark.read.table(name)
    return spark.createDataFrame([], schema)


def read_path_or_empty(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """S-16 for path-based tables (any file system): a missing path gives an
    empty frame of ``schema``; every other error surfaces."""
    try:
        return spark.read.format(fmt).load(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def header_report(spark: SparkSession, path: str, expected_cols) -> DataFrame:
    """P-19: per file, its header line compared with the expected column list."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file_path"),
                                         F.col("_metadata.file_block_start").alias("__start"))
    # ids grow in read order inside a split, so the smallest id of the split
    # that starts at byte 0 is the file's first line
    first = (lines.filter(F.col("__start") == 0)
             .withColumn("__id", F.monotonically_increasing_id())
             .groupBy("file_path").agg(F.min_by("value", "__id").alias("header")))
    expected = ",".join(expected_cols)
    return first.select("file_path", "header",
                        (F.regexp_replace("header", r"\s", "") == F.lit(expected)).alias("matches"))


def sql_over(spark: SparkSession, views: dict, text: str) -> DataFrame:
    """S-21: register frames as temp views and run SQL text over them
    (Catalyst plans SQL and DataFrame code identically)."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)
