"""Catalog entries of the component twins (E2) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.skew import RangeParts
from ..sources import driver as D
from . import components as C
from . import oracle as O
from .catalog import query


def health_frames(spark, sf, keys=O.COMP_KEYS):
    return {k: C.health(D.COMPONENT_SOURCES[k](spark, sf), S.COMPONENTS[k]) for k in keys}


def view(spark, sf):
    return C.component_view(health_frames(spark, sf))


def _round(df, cols, d=6):
    return df.withColumns({c: F.round(c, d) for c in cols})


def _register_component(key):
    spec = S.COMPONENTS[key]

    @query(f"health_{key}", O.with_(*O.comp_ctes([key])) + f"SELECT * FROM {key}_health")
    def _health(spark, sf):
        return C.health(D.COMPONENT_SOURCES[key](spark, sf), spec)

    @query(f"features_{key}", O.with_(*O.comp_ctes([key])) + O.comp_features_select(key))
    def _features(spark, sf):
        h = C.health(D.COMPONENT_SOURCES[key](spark, sf), spec)
        return _round(C.features(h, spec, skew_bucket=RangeParts()), [n for n, _ in spec.avgs])


for _k in O.COMP_KEYS:
    _register_component(_k)


@query("health_rule", O.with_(*O.comp_ctes(["fuel"])) + """
SELECT aircraft_id, health_status, count(*) AS readings FROM fuel_health GROUP BY aircraft_id, health_status""")
def health_rule(spark, sf):
    """R-09 with numeric and enum triggers on lineitem, counted per (supplier, status)."""
    h = C.health(D.fuel_readings(spark, sf), S.COMPONENTS["fuel"])
    return h.groupBy("aircraft_id", "health_status").agg(F.count(F.lit(1)).alias("readings"))


@query("health_union", O.with_(*O.comp_ctes(O.COMP_KEYS), O.comp_view()) + "SELECT * FROM comp_view")
def health_union(spark, sf):
    """U-01: five component health tables unioned by name with NULL fill."""
    return view(spark, sf)


@query("component_alerts", O.with_(*O.comp_ctes(O.COMP_KEYS), O.comp_view(), O.COMP_ALERTS)
       + "SELECT * FROM comp_alerts")
def component_alerts(spark, sf):
    """T-11."""
    return C.component_alerts(view(spark, sf))


@query("health_counts", O.with_(*O.comp_ctes(O.COMP_KEYS), O.comp_view()) + """
SELECT component_type, health_status, count(*) AS readings FROM comp_view GROUP BY ALL""")
def health_counts(spark, sf):
    """Per component type and status counts (union row count = sum of inputs)."""
    return view(spark, sf).groupBy("component_type", "health_status").agg(F.count(F.lit(1)).alias("readings"))


_TYPES = [S.COMPONENTS[k].component_type for k in O.COMP_KEYS]


@query("heatmap_pivot", O.with_(*O.comp_ctes(O.COMP_KEYS), O.comp_view()) + "SELECT aircraft_id, "
       + ", ".join(f"CAST(count(*) FILTER (WHERE component_type = '{t}' AND health_status <> 'NOMINAL') AS BIGINT)"
                   f" AS {t}" for t in _TYPES)
       + " FROM comp_view GROUP BY aircraft_id")
def heatmap_pivot(spark, sf):
    """Q-27: component heat map – non-nominal readings per aircraft × component type."""
    v = view(spark, sf).withColumn("bad", (F.col("health_status") != S.HEALTH_NOMINAL).cast("int"))
    p = v.groupBy("aircraft_id").pivot("component_type", _TYPES).agg(F.sum("bad"))
    return p.select("aircraft_id", *[F.coalesce(F.col(t), F.lit(0)).cast("long").alias(t) for t in _TYPES])


@query("component_map", O.with_(*O.comp_ctes(O.COMP_KEYS), O.comp_view(), O.COMP_ALERTS, O.LOCATION) + """
SELECT l.airport_code, l.latitude, l.longitude, a.component_type, a.health_status, count(*) AS alert_count
FROM location l LEFT JOIN comp_alerts a ON a.aircraft_id = l.aircraft_id
GROUP BY ALL""")
def component_map(spark, sf):
    """T-12 (J-06, A-02): component alerts per airport/type/status; an aircraft
    without alerts counts 1 with NULL type, as in the original (K18)."""
    from . import maps
    return maps.component_status_map(maps.location(spark, sf),
                                      C.component_alerts(view(spark, sf)))
