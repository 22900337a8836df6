"""Deterministic sampling and exact stratified splits (U-06, M-02).

Uniform numbers come from a portable keyed hash (a Lehmer permutation of the
key modulo the prime 2^31-1) so that the same draw is reproducible in any SQL
engine, on any cluster size and after any repartitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

P = 2147483647          # 2^31 - 1
A = 48271               # MINSTD multiplier


def hash_uniform(key, seed: int = 42):
    """u in [0, 1) from an integral key and a seed."""
    k = F.col(key) if isinstance(key, str) else key
    x = F.pmod(F.pmod(k.cast("long"), F.lit(P)) * A + F.lit(seed * 7919 + 1), F.lit(P))
    return x.cast("double") / float(P)


def hash_uniform_sql(key: str, seed: int = 42) -> str:
    return (f"CAST(((((({key} % {P}) + {P}) % {P}) * {A} + {seed * 7919 + 1}) % {P}) AS DOUBLE) "
            f"/ {float(P)}")


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """U-06: exactly ``n`` rows chosen by hash order (top-k, no full sort)."""
    return (df.withColumn("__u", hash_uniform(key, seed))
            .orderBy("__u", key).limit(n).drop("__u"))


def stratified_split(df: DataFrame, label: str, key: str, test_fraction: float = 0.3,
                     seed: int = 42, buckets: int = 1024) -> DataFrame:
    """M-02: adds ``is_test``; per class exactly ``round(test_fraction * n_class)``
    rows (the lowest hash draws) go to test.

    A class can hold most of the data, so its rank is not computed in one
    window: rows fall into ``buckets`` hash buckets per class, per-bucket
    counts give exclusive offsets (a table of at most classes × buckets
    rows), and the rank inside a bucket is a window over (class, bucket).
    """
    u = hash_uniform(key, seed)
    d = df.withColumn("__u", u).withColumn("__b", F.floor(F.col("__u") * buckets).cast("int"))
    counts = d.groupBy(label, "__b").agg(F.count(F.lit(1)).alias("__c"))
    offs = (counts
            .withColumn("__off", F.coalesce(F.sum("__c").over(
                Window.partitionBy(label).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0)))
            .withColumn("__n", F.sum("__c").over(Window.partitionBy(label)))
            .select(label, "__b", "__off", "__n"))
    rank = F.row_number().over(Window.partitionBy(label, "__b").orderBy("__u", key))
    # offs has classes x buckets rows; AQE broadcasts it at run time when small
    d = d.join(offs, [label, "__b"])
    d = d.withColumn("__r", F.col("__off") + rank)
    n_test = F.round(F.col("__n") * F.lit(test_fraction)).cast("long")
    return d.withColumn("is_test", F.col("__r") <= n_test).drop("__u", "__b", "__off", "__n", "__r")
