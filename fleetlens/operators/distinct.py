"""Distinct counts by stored sketches (A-03, A-04, A-08).

Exact distinct counts cannot be added up, so a 7- or 30-day count needs all
rows of its window again.  An HLL sketch per (group, day) is small and merges:
it is made once per day and every window is a union of sketches.  The relative
error is about 1.04 / sqrt(2 ** lg_k) (0.4 % at the default); up to some
thousand values the sketch holds their hashes and the count is exact but for
hash collisions.  The exact forms (``alert_summary``) stay beside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 16


def daily_sketches(df: DataFrame, keys, day: str, value: str, lg_k: int = LG_K) -> DataFrame:
    """(``keys``, ``day``, ``rows``, ``sketch``); NULL values are not counted."""
    return df.groupBy(*keys, F.col(day).alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(F.col(value), lg_k).alias("sketch"))


def rolling_distinct(sketches: DataFrame, keys, days, name: str = "distinct_values") -> DataFrame:
    """(``keys``, ``window_end``, ``days``, ``rows``, ``name``): for every day
    that has rows and every window length in ``days``, what the window ending
    that day holds.  A sketch goes to the windows that contain its day; rows
    are days x lengths, never readings."""
    keys = list(keys)
    lengths = F.explode(F.array(*[F.lit(int(d)) for d in days])).alias("days")
    there = sketches.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("day").alias("__day"))
    sent = sketches.select("*", lengths).withColumn(
        "window_end", F.explode(F.expr("sequence(day, date_add(day, days - 1))")))
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys] + [F.col("window_end") == F.col("__day")]
    kept = sent.join(there, on, "left_semi")
    return kept.groupBy(*keys, "window_end", "days").agg(
        F.sum("rows").alias("rows"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
