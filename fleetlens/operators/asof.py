"""Backward as-of join (J-01, J-10, W-01).

For every left row pick the right row with the same keys whose ordering value
is ``<=`` the left one (ties allowed), the greatest by ``(right_on, tie)``.

The plan never forms readings × events pairs.  Both sides are unioned and a
single running ``last(..., ignorenulls)`` carries the latest right row forward
in key/time order: one shuffle on the keys, O(n log n), no fan-out.

A comparison with NULL is never true: right rows with a NULL key or NULL
ordering value are dropped first, and left rows with one have no match (they
go with ``how='inner'`` and stay, unmatched, with ``how='left'``).

Skew: with ``bucket`` (see ``skew.py``) the running scan is split in two levels
so that a key that holds a large share of all rows is spread over many tasks:

1. the rows are dealt out once by (keys, part);
2. the last right row of each (keys, part) is carried into the later parts by
   a window over one row per part;
3. the row-level scan runs per (keys, part) and falls back to the carry-in;
   scan and carry-in read the same exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .skew import with_part

_R = "__asof_r"
_ORD = "__asof_ord"
_SIDE = "__asof_side"
_BKT = "__asof_bucket"


def _prepare(left, right, keys, left_on, right_on, right_cols, tie):
    lcols = left.columns
    rstruct = F.struct(*[F.col(c) for c in right_cols])
    tie = list(tie or [])
    ro = F.col(right_on) if isinstance(right_on, str) else right_on
    right = right.filter(ro.isNotNull())
    for k in keys:
        right = right.filter(F.col(k).isNotNull())
    l = left.select(*[F.col(c) for c in lcols], F.col(left_on).alias(_ORD) if isinstance(left_on, str)
                    else left_on.alias(_ORD), F.lit(1).alias(_SIDE))
    r = right.select(*[F.col(k) for k in keys],
                     ro.alias(_ORD),
                     F.lit(0).alias(_SIDE), rstruct.alias(_R),
                     *[F.col(t).alias(f"__asof_tie{i}") for i, t in enumerate(tie)])
    u = l.unionByName(r, allowMissingColumns=True)
    order = [F.col(_ORD), F.col(_SIDE)] + [F.col(f"__asof_tie{i}") for i in range(len(tie))]
    return u, lcols, order, len(tie)


def asof_join(left: DataFrame, right: DataFrame, keys, left_on, right_on, right_cols,
              tie=None, how: str = "inner", bucket=None) -> DataFrame:
    """Attach to each left row the latest right row with ``right_on <= left_on``.

    ``left_on``/``right_on`` are column names or expressions of the same type.
    ``tie`` orders right rows sharing the same ``right_on`` (greatest wins).
    ``how='inner'`` drops left rows without a match (the original behaviour),
    ``'left'`` keeps them with NULLs.
    ``bucket`` (``skew.day_bucket``, ``skew.RangeParts()``) takes the two-level
    plan: for histories in which one key may hold more rows than a task should
    sort.
    The rows are the same either way.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    u, lcols, order, ntie = _prepare(left, right, keys, left_on, right_on, right_cols, tie)
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        out = u.withColumn(_R, F.last(_R, ignorenulls=True).over(w))
    else:
        out = _bucketed(u, keys, order, bucket)
    out = out.filter(F.col(_SIDE) == 1)
    if how == "inner":
        out = out.filter(F.col(_R).isNotNull())
    elif how != "left":
        raise ValueError(f"unsupported as-of join type {how!r}")
    return out.select(*[F.col(c) for c in lcols], *[F.col(f"{_R}.{c}").alias(c) for c in right_cols])


def _bucketed(u, keys, order, bucket):
    u = with_part(u, keys, order, bucket, _BKT)
    last = F.max_by(F.col(_R), F.when(F.col(_R).isNotNull(), F.struct(*order)))      # right rows only
    parts = u.groupBy(*keys, _BKT).agg(last.alias("__last"))
    carry = F.last("__last", ignorenulls=True).over(
        Window.partitionBy(*keys).orderBy(_BKT).rowsBetween(Window.unboundedPreceding, -1))
    small = parts.select(*keys, _BKT, carry.alias("__carry")).filter(F.col("__carry").isNotNull())
    w = Window.partitionBy(*keys, _BKT).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    scanned = u.withColumn(_R, F.last(_R, ignorenulls=True).over(w)).filter(F.col(_SIDE) == 1)
    return (scanned.join(small, [*keys, _BKT], "left")
            .withColumn(_R, F.coalesce(F.col(_R), F.col("__carry")))
            .drop("__carry", _BKT))
