"""Union and schema-alignment operators (U-01, U-02, P-05, P-07, O-05)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_by_name(frames, allow_missing: bool = True) -> DataFrame:
    """U-01: union frames by column name, NULL-filling missing columns."""
    frames = list(frames)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def tag(df: DataFrame, **literals) -> DataFrame:
    """Add constant columns (folded by Catalyst; filters on them prune union branches)."""
    return df.select("*", *[F.lit(v).alias(k) for k, v in literals.items()])


def drop_if_present(df: DataFrame, *cols) -> DataFrame:
    """P-05: ``drop`` ignores absent columns."""
    return df.drop(*cols)


def select_or_null(df: DataFrame, target, cast_present: bool = True, keep=()) -> DataFrame:
    """P-07 / O-05: project onto a target schema; missing columns become typed
    NULLs (or a default), present ones are cast to the target type (or kept
    as they are with ``cast_present=False``)."""
    fields = target.fields if isinstance(target, T.StructType) else target
    out = []
    for f in fields:
        if isinstance(f, T.StructField):
            name, dtype, default = f.name, f.dataType, None
        else:
            name, dtype, default = (f + (None,))[:3]
        if name in df.columns:
            c = F.col(name).cast(dtype) if cast_present else F.col(name)
            if default is not None:
                c = F.coalesce(c, F.lit(default).cast(dtype))
        else:
            c = (F.lit(default) if default is not None else F.lit(None)).cast(dtype)
        out.append(c.alias(name))
    return df.select(*out, *[F.col(k) for k in keep])


def empty_like(spark, schema) -> DataFrame:
    """U-05: empty frame of a schema (the ``limit(0)`` clone)."""
    return spark.createDataFrame([], schema)
