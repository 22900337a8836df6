"""Nested-value flattening (F-10): config dictionaries → (key, value) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def struct_leaf_paths(dtype: T.StructType, prefix: str = ""):
    """Dotted paths of every non-struct leaf of a struct type."""
    out = []
    for f in dtype.fields:
        p = f"{prefix}{f.name}"
        if isinstance(f.dataType, T.StructType):
            out += struct_leaf_paths(f.dataType, p + ".")
        else:
            out.append(p)
    return out


def flatten_struct_kv(df: DataFrame, id_cols, struct_col: str,
                      key_name: str = "config_key", value_name: str = "config_value") -> DataFrame:
    """Nested struct column → one (id…, dotted key, value as string) row per leaf."""
    paths = struct_leaf_paths(df.schema[struct_col].dataType)
    pairs = F.array(*[F.struct(F.lit(p).alias("k"), F.col(f"{struct_col}.{p}").cast("string").alias("v"))
                      for p in paths])
    return df.select(*id_cols, F.explode(pairs).alias("__kv")).select(
        *id_cols, F.col("__kv.k").alias(key_name), F.col("__kv.v").alias(value_name))


def flatten_json_kv(df: DataFrame, id_cols, json_col: str,
                    key_name: str = "config_key", value_name: str = "config_value") -> DataFrame:
    """Flat JSON object text → (id…, key, value) rows (values as text)."""
    m = F.from_json(F.col(json_col), T.MapType(T.StringType(), T.StringType()))
    return df.select(*id_cols, F.explode(m).alias(key_name, value_name))


def flatten_json_deep(df: DataFrame, id_cols, json_col: str, levels: int = 8,
                      key_name: str = "config_key", value_name: str = "config_value") -> DataFrame:
    """Nested JSON object text → (id…, dotted key, value as text) rows, one per
    leaf.  Objects below ``levels`` and empty objects stay as JSON text; arrays
    are leaves."""
    kind = T.MapType(T.StringType(), T.StringType())
    out = flatten_json_kv(df, id_cols, json_col, "__key", "__value")
    for _ in range(levels - 1):
        inner = F.when(F.col("__value").startswith("{"), F.from_json("__value", kind))
        out = out.select(*id_cols, "__key", "__value", F.explode_outer(inner).alias("__k", "__v")).select(
            *id_cols, F.concat_ws(".", "__key", "__k").alias("__key"),
            F.when(F.col("__k").isNull(), F.col("__value")).otherwise(F.col("__v")).alias("__value"))
    return out.select(*id_cols, F.col("__key").alias(key_name), F.col("__value").alias(value_name))
