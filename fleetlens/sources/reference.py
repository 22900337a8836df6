"""Static reference frames (S-17 … S-20).

Their row counts are fixed by construction, so they are marked bounded and
may be broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import schemas as S
from ..operators.joins import mark_bounded


def _frame(spark, rows, schema) -> DataFrame:
    return mark_bounded(spark.createDataFrame(rows, schema), len(rows))


def aircraft_models(spark: SparkSession) -> DataFrame:
    return _frame(spark, S.AIRCRAFT_MODELS, S.struct(S.AIRCRAFT_MODEL_COLS))


def airports(spark: SparkSession, version: int = 2) -> DataFrame:
    rows = S.AIRPORTS_V2 if version == 2 else S.AIRPORTS
    return _frame(spark, rows, S.struct(S.AIRPORT_COLS))


def aircraft_bases(spark: SparkSession, version: int = 2) -> DataFrame:
    if version == 2:
        return _frame(spark, S.AIRCRAFT_AIRPORTS_V2, S.struct([("aircraft_id", S.S), ("airport_code", S.S)]))
    return _frame(spark, S.AIRCRAFT_BASES, S.struct([("aircraft_id", S.S), ("base_airport_code", S.S)]))


def component_master(spark: SparkSession) -> DataFrame:
    return _frame(spark, S.COMPONENT_MASTER, S.struct([(c, S.S) for c in S.COMPONENT_MASTER_COLS]))


def alert_components(spark: SparkSession) -> DataFrame:
    return _frame(spark, S.ALERT_COMPONENTS,
                  S.struct([("component_name", S.S), ("component_id", S.S), ("component_description", S.S)]))
