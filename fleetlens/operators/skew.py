"""How the split plans of per-key window operators cut a key's history.

AQE splits skewed *join* partitions but cannot split a window partition: all
rows of one key meet in one task.  Operators that keep a history per key
therefore take a ``bucket``; with one the work runs per (key, part), and what
crosses the border of a part is carried over by a small table.  A bucket is

* a function of the ordering column that never falls while it grows, such as
  :func:`day_bucket`: no extra shuffle, for histories whose rows per key and
  day are few enough for a task; or
* :class:`RangeParts`: the rows are range-partitioned by (key, order) and
  written once to the shared folder, so parts follow the data and a key that
  holds a third of all rows is spread over a third of the parts, whatever its
  times are.  The cut is a stored fact: a range exchange samples its bounds
  anew whenever it is planned, so two readers of a lazy one could disagree.

The rows are the same with and without it, NULL keys and NULL times included.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def day_bucket(c):
    """Calendar day: for histories of many readings a day."""
    return F.to_date(c)


def month_bucket(c):
    """Calendar month: for sparse histories."""
    return F.trunc(F.to_date(c), "month")


class RangeParts:
    """Cut by a range partitioning of ``parts`` partitions (default: the
    session's shuffle partitions).  Runs a job when it is applied."""

    def __init__(self, parts: int | None = None):
        self.parts = parts

    def cut(self, df: DataFrame, keys, order, name: str) -> DataFrame:
        spark = df.sparkSession
        parts = self.parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
        cut = df.repartitionByRange(parts, *keys, *order).withColumn(name, F.spark_partition_id())
        cut.write.parquet(path)
        return spark.read.schema(cut.schema).parquet(path)


def with_part(df: DataFrame, keys, order, bucket, name: str) -> DataFrame:
    """``df`` with the part of each row in column ``name``, dealt out by (keys,
    part).  The exchange is explicit, so the readers of the result share it
    and the input is evaluated once (twice by a range cut, which samples it)."""
    if isinstance(bucket, RangeParts):
        df = bucket.cut(df, keys, order, name)
    else:
        df = df.withColumn(name, bucket(order[0]))
    return df.repartition(*keys, name)
