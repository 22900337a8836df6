"""Drift of features from stored, mergeable sketches (M-13).

One row per (window, feature) holds the count, mean, squared deviations and a
KLL quantile sketch of a feature's values.  Rows are small whatever the data
(a sketch keeps about 3 ``k`` values), are written once per window (a day),
and merge into any longer window, so a new reference window costs no scan of
the readings.

Rank error of a quantile: below 2.3 / k ** 0.9 of the rows, both for one sketch
and for merged ones (0.13 % at the default ``k``); up to ``k`` values a sketch
keeps them all and quantiles are exact.  A quantile is the smallest value whose
rank reaches ``q`` of the rows.  NULLs are ignored; a feature without any value
has NULL figures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 4096


def rank_error(k: int = K) -> float:
    return 2.3 / k ** 0.9


def feature_sketches(df: DataFrame, by: str, cols, k: int = K) -> DataFrame:
    """(``by``, ``feature``, ``rows``, ``n``, ``mean``, ``m2``, ``sketch``), one
    partial aggregation over ``df``."""
    def packed(c):
        v = F.col(c).cast("double")
        return F.struct(F.lit(c).alias("feature"), F.count(v).alias("n"), F.avg(v).alias("mean"),
                        (F.var_pop(v) * F.count(v)).alias("m2"),
                        F.kll_sketch_agg_double(v, k).alias("sketch"))
    names = [f"__f{i}" for i in range(len(cols))]
    wide = df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), *[packed(c).alias(n) for c, n in zip(cols, names)])
    return wide.select(by, "rows", F.inline(F.array(*names)))


def merged(sketches: DataFrame, by=(), k: int = K) -> DataFrame:
    """The same columns for the union of the windows in each group of ``by``."""
    keys = [by] if isinstance(by, str) else list(by)
    some = F.col("n") > 0
    total = F.sum("n")
    # sum of squares about the common mean, from those about each window's own
    spread = F.sum(F.when(some, F.col("m2") + F.col("n") * F.col("mean") * F.col("mean")))
    mean = F.sum(F.when(some, F.col("mean") * F.col("n"))) / total
    return sketches.groupBy(*keys, "feature").agg(
        F.sum("rows").alias("rows"), total.alias("n"), mean.alias("mean"),
        (spread - total * mean * mean).alias("m2"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def figures(sketches: DataFrame, quantiles=(0.5, 0.95), prefix: str = "") -> DataFrame:
    """Mean, sample standard deviation and quantiles in place of the sketch."""
    some = F.col("n") > 0
    stddev = F.when(F.col("n") > 1, F.sqrt(F.greatest(F.col("m2"), F.lit(0.0)) / (F.col("n") - 1)))
    points = [F.when(some, F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))))
              .alias(f"{prefix}p{round(100 * q)}") for q in quantiles]
    keep = [c for c in sketches.columns if c not in ("rows", "n", "mean", "m2", "sketch")]
    rows = [] if prefix else ["rows"]
    return sketches.select(*keep, *rows, F.col("mean").alias(f"{prefix}mean"), stddev.alias(f"{prefix}stddev"), *points)


def drift_report(sketches: DataFrame, by: str, reference, quantiles=(0.5, 0.95), k: int = K) -> DataFrame:
    """Per window outside the ``reference`` (a condition on ``by``): the figures
    of each feature next to those of the merged reference windows, and the mean
    shift in reference standard deviations.  Reads sketches only."""
    ref = figures(merged(sketches.filter(reference), k=k), quantiles, "ref_")       # one row per feature
    cur = figures(sketches.filter(~reference), quantiles)
    return (cur.join(F.broadcast(ref), "feature", "left")
            .withColumn("shift", (F.col("mean") - F.col("ref_mean")) / F.col("ref_stddev")))
