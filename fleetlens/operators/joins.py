"""Join helpers (J-02 … J-13).

Broadcast is forced only for frames whose size is bounded by construction
(literal reference rows, or frames whose row count has been proven below a
limit); everything else is left to the optimizer / AQE, which broadcasts a
side at run time only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BOUNDED_ROWS_ATTR = "_fleetlens_max_rows"


def mark_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Tag a frame as having at most ``max_rows`` rows (e.g. literal rows)."""
    setattr(df, BOUNDED_ROWS_ATTR, int(max_rows))
    return df


def bounded_rows(df: DataFrame):
    return getattr(df, BOUNDED_ROWS_ATTR, None)


def ref_join(df: DataFrame, ref: DataFrame, on, how: str = "left",
             broadcast_max_rows: int = 100_000) -> DataFrame:
    """Join a fact frame to a reference frame.

    The reference side is broadcast only if it carries a proven row bound
    below ``broadcast_max_rows``; otherwise the planner decides (shuffle join,
    or AQE's runtime broadcast when the measured size is small).
    """
    n = bounded_rows(ref)
    side = F.broadcast(ref) if n is not None and n <= broadcast_max_rows else ref
    return df.join(side, on=on, how=how)


def unmapped_keys(df: DataFrame, ref: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """J-12: rows of ``df`` whose key has no partner in ``ref`` (anti join)."""
    return df.join(ref.select(F.col(right_key).alias("__k")), F.col(left_key) == F.col("__k"), "left_anti")


def mapped_keys(df: DataFrame, ref: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """J-13: rows of ``df`` whose key occurs in ``ref`` (semi join)."""
    return df.join(ref.select(F.col(right_key).alias("__k")), F.col(left_key) == F.col("__k"), "left_semi")


def count_matches(left: DataFrame, right: DataFrame, key: str, name: str = "match_count") -> DataFrame:
    """J-05 / A-01: left rows with the number of matching right rows (0 if none).

    The right side is aggregated per key *before* the join, so the join never
    fans out (the original joined first and counted afterwards)."""
    per_key = right.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return left.join(per_key, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)))
