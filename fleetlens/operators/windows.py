"""Window operators: lag / rolling means (W-05 … W-15), dedupe (W-02),
latest row per group (W-03, W-04).

Ordering is always made total (K2, K3): callers pass the ordering columns
followed by a unique tie-break, so results do not depend on shuffle order.

Skew: a per-aircraft window puts a whole aircraft history into one task.  With
``bucket`` set, :func:`rolling_features` runs per (keys, part) instead, see
``skew.py``; a hot key is then spread over its parts while the result stays
exactly equal.  Row frames are right inside a part but for its first ``n-1``
rows.  Those, and the last ``n-1`` rows of every part, are few; a window over
them alone gives the first rows their values.  Range frames need no carry:
their buckets are as long as the frame, so every row is needed in its own
bucket and the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .skew import with_part


def _cols(x):
    return [x] if isinstance(x, str) else list(x)


def _order_exprs(order):
    return [F.col(c) if isinstance(c, str) else c for c in _cols(order)]


def rolling_features(df: DataFrame, keys, order, lags=None, avgs=None, n: int = 7,
                     frame: str = "rows", range_col=None, range_seconds: int | None = None,
                     bucket=None) -> DataFrame:
    """Add ``lag(src, 1)`` columns and trailing means over the last ``n`` rows.

    lags / avgs: ``{new_name: source_column}`` (insertion ordered).
    frame='rows'  → rows between n-1 preceding and current row (original "7d").
    frame='range' → true time window of ``range_seconds`` ending at the row
                    (``range_col`` is a timestamp/date column).
    bucket        → a time bucket of the first ordering column or RangeParts
                    (``skew.py``): take it for histories that may hold more
                    rows of one key than a task should sort.  Range frames
                    only look at whether it is set.
    Without a bucket all expressions share one window spec, hence one
    Exchange + Sort.  The result is the same either way.
    """
    keys, order = _cols(keys), _order_exprs(order)
    lags, avgs = dict(lags or {}), dict(avgs or {})
    if bucket is not None:
        if frame == "rows":
            return _rolling_parts(df, keys, order, lags, avgs, n, bucket)
        if lags:
            raise ValueError("lags belong to a rows frame")
        return _rolling_range_split(df, keys, avgs, range_col, range_seconds)
    base = Window.partitionBy(*keys).orderBy(*order)
    if frame == "rows":
        roll = base.rowsBetween(-(n - 1), 0)
    elif frame == "range":
        rc = F.col(range_col) if isinstance(range_col, str) else range_col
        secs = _epoch_seconds(df, rc, range_col)
        roll = Window.partitionBy(*keys).orderBy(secs).rangeBetween(-(range_seconds - 1), 0)
    else:
        raise ValueError(frame)
    out = df.select("*", *[F.lag(F.col(src), 1).over(base).alias(new) for new, src in lags.items()],
                    *[F.avg(F.col(src)).over(roll).alias(new) for new, src in avgs.items()])
    return out


def _epoch_seconds(df, c, name=None):
    """Whole seconds since 1970 of a timestamp column; wall-clock (session-TZ
    independent) for TIMESTAMP_NTZ input."""
    from pyspark.sql import types as T
    dtype = df.schema[name].dataType if isinstance(name, str) else None
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    return c.cast("timestamp").cast("long")


def _rolling_parts(df, keys, order, lags, avgs, n, bucket):
    """Exact rows-frame features per (keys, part), the first rows of each part
    mended from the edges.  The window over the edges sees at most 2(n-1) rows
    of a key per part.  NULL keys form a group and NULL times come first, as in
    the plain window."""
    P, RN, CNT = "__part", "__rn", "__cnt"
    halo = max(n - 1 if avgs else 1, 1)

    def features(w):
        roll = w.rowsBetween(-(n - 1), 0)
        return [*[F.lag(F.col(src), 1).over(w).alias(new) for new, src in lags.items()],
                *[F.avg(F.col(src)).over(roll).alias(new) for new, src in avgs.items()]]

    own = [F.col(f"`{c}`") for c in df.columns]
    part = Window.partitionBy(*keys, P)
    d = with_part(df, keys, order, bucket, P).select(
        *own, P, F.row_number().over(part.orderBy(*order)).alias(RN), F.count(F.lit(1)).over(part).alias(CNT),
        *features(part.orderBy(*order)))
    head, tail = F.col(RN) <= halo, F.col(RN) > F.col(CNT) - halo
    edges = d.filter(head | tail).select(*own, P, RN)
    mended = edges.select(*own, RN, *features(Window.partitionBy(*keys).orderBy(P, RN))).filter(head).drop(RN)
    return d.filter(~head).drop(P, RN, CNT).unionByName(mended)


def _rolling_range_split(df, keys, avgs, range_col, range_seconds):
    """Exact range-frame means per (keys, bucket of the frame's length): each
    row goes to its own bucket and the next one, no join, no other copies.
    NULL times form a bucket of their own, as they are peers of each other."""
    rc = F.col(range_col) if isinstance(range_col, str) else range_col
    d = df.withColumn("__sec", _epoch_seconds(df, rc, range_col))
    d = d.withColumn("__at", F.floor(F.col("__sec") / range_seconds))
    d = d.withColumn("__bkt", F.explode(F.when(F.col("__at").isNull(), F.array(F.lit(None).cast("long")))
                                        .otherwise(F.array(F.col("__at"), F.col("__at") + 1))))
    w = Window.partitionBy(*keys, "__bkt").orderBy("__sec").rangeBetween(-(range_seconds - 1), 0)
    out = d.select("*", *[F.avg(F.col(src)).over(w).alias(new) for new, src in avgs.items()])
    return out.filter(F.col("__bkt").eqNullSafe(F.col("__at"))).drop("__sec", "__at", "__bkt")


def dedupe(df: DataFrame, keys, order=None) -> DataFrame:
    """Keep one row per key: the greatest by ``order``, then by every other
    column (descending, NULLs last), so the survivor never depends on
    shuffle order (K3).

    ``row_number() = 1`` lets Catalyst insert a partial window-group-limit
    *before* the shuffle: every map task forwards at most one row per key,
    so a hot key is reduced map-side like a partial aggregate."""
    keys = _cols(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    ord_cols = [o.desc_nulls_last() if not isinstance(o, str) else F.col(o).desc_nulls_last()
                for o in _cols(order or [])] + [F.col(c).desc_nulls_last() for c in rest]
    w = Window.partitionBy(*keys).orderBy(*ord_cols)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def latest_by(df: DataFrame, keys, order) -> DataFrame:
    """Latest row per key by ``order`` (W-03, W-04); ties broken by all columns."""
    return dedupe(df, keys, order)
