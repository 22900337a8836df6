"""Driver Parquet tables and their mapping onto the fleet domain.

The mapping (FIXTURES.md, family T) turns the star-schema test tables into
the shapes the pipeline ingests, so every operator runs on whole tables whose
size grows with the scale factor.  Each mapping is a plain projection/filter
(pushed into the Parquet scan); the SQL text of the same mapping lives in
``fleetlens.plans.oracle`` for the DuckDB cross-check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import json_number

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; read anew each time, so new files are seen."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sensor_readings(spark, sf_dir) -> DataFrame:
    return sensor_readings_from(table(spark, sf_dir, "events"))


def sensor_readings_from(events: DataFrame) -> DataFrame:
    """Sensor readings = non-signup events (batch or streaming frame).
    aircraft_id = user_id, model = user_id (key of the per-aircraft model
    table), metrics from ``value`` and ``props.k``, anomaly_score =
    (event_type = 'error')."""
    e = events.filter(F.col("event_type") != "signup")
    k = json_number("props", "k")
    v = F.col("value")
    return e.select(
        F.col("ts").alias("timestamp"),
        F.col("user_id").alias("aircraft_id"),
        F.col("user_id").alias("model"),
        v.alias("engine_temp"),
        (F.lit(40.0) + k).alias("fuel_efficiency"),
        (k / 3.0).alias("vibration"),
        (F.lit(30000.0) + v).alias("altitude"),
        (F.lit(400.0) + k).alias("airspeed"),
        F.when(F.col("event_type") == "error", 1.0).otherwise(0.0).alias("anomaly_score"),
        (F.lit(30.0) + v / 10.0).alias("oil_pressure"),
        (F.lit(1500) + k.cast("int") * 30).cast("int").alias("engine_rpm"),
        (F.lit(22.0) + k / 20.0).alias("battery_voltage"),
        F.col("event_id").alias("reading_id"),
    )


def maintenance_events(spark, sf_dir) -> DataFrame:
    return maintenance_events_from(table(spark, sf_dir, "events"))


def maintenance_events_from(events: DataFrame) -> DataFrame:
    """Maintenance events = signup events (event_date = day of ts)."""
    e = events.filter(F.col("event_type") == "signup")
    return e.select(
        F.col("user_id").alias("aircraft_id"),
        F.to_date("ts").alias("event_date"),
        F.when(F.col("value") >= 175.0, "Engine Repair").otherwise("Routine Check").alias("event_type"),
        F.col("event_id").alias("maint_id"),
    )


def model_reference(spark, sf_dir) -> DataFrame:
    """Per-aircraft model metadata from ``customer`` (keyed by c_custkey)."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("model"),
        F.col("c_mktsegment").alias("manufacturer"),
        F.col("c_name").alias("engine_type"),
        F.col("c_nationkey").alias("capacity"),
        (F.col("c_nationkey") * 500).cast("int").alias("range_km"),
    )


def aircraft_airport_map(spark, sf_dir) -> DataFrame:
    """aircraft → base airport: customer → nation key."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("aircraft_id"), F.col("c_nationkey").alias("airport_code"))


def airport_reference(spark, sf_dir) -> DataFrame:
    """airports = nations with their region name as city and synthetic coordinates."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_nationkey").alias("airport_code"),
        F.col("n_name").alias("airport_name"),
        F.col("r_name").alias("city"),
        (F.col("n_nationkey") * 1.5).alias("latitude"),
        (F.col("n_regionkey") * -10.0).alias("longitude"),
    )


# component twins mapped from driver tables (raw shapes of COMPONENTS specs)
def engine_readings(spark, sf_dir) -> DataFrame:
    return engine_readings_from(table(spark, sf_dir, "events"))


def engine_readings_from(events: DataFrame) -> DataFrame:
    e = events.filter(F.col("event_type") == "click")
    k, v = json_number("props", "k"), F.col("value")
    return e.select(F.col("event_id").cast("string").alias("engine_id"), F.col("user_id").alias("aircraft_id"),
                    F.col("ts").alias("event_timestamp"), (v * 100.0).alias("thrust_level"),
                    (k / 20.0).alias("fuel_consumption_rate"), (F.lit(400.0) + v).alias("temperature_reading"),
                    (k / 50.0).alias("vibration_level"), (F.lit(30.0) + k / 2.0).alias("oil_pressure"))


def avionics_readings(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "view")
    k, v = json_number("props", "k"), F.col("value")
    return e.select(F.col("event_id").cast("string").alias("avionics_id"), F.col("user_id").alias("aircraft_id"),
                    F.col("ts").alias("event_timestamp"), (F.lit(90.0) + k / 10.0).alias("power_status"),
                    (k + 1.0).alias("signal_integrity"), (F.lit(100.0) + v * 2.0).alias("data_transmission_rate"),
                    (v / 6.0).alias("system_temperature"), F.floor(k / 10.0).cast("int").alias("error_logs"))


def electrical_readings(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    k, v = json_number("props", "k"), F.col("value")
    return e.select(F.col("event_id").cast("string").alias("electrical_id"), F.col("user_id").alias("aircraft_id"),
                    F.col("ts").alias("event_timestamp"), (F.lit(22.0) + k / 16.0).alias("battery_voltage"),
                    k.alias("charge_level"), (F.lit(80.0) + k / 5.0).alias("power_distribution_efficiency"),
                    v.alias("electrical_load"), (F.lit(0.8) + k / 500.0).alias("transformer_health"),
                    F.when(v > 300.0, "FAIL").when(v > 200.0, "WARN").otherwise("NONE").alias("fault_code"))


def hydraulic_readings(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    k, v = json_number("props", "k"), F.col("value")
    return e.select(F.col("event_id").cast("string").alias("hydraulic_id"), F.col("user_id").alias("aircraft_id"),
                    F.col("ts").alias("event_timestamp"), (F.lit(2300.0) + v * 2.0).alias("hydraulic_pressure"),
                    (v / 5.0 - 20.0).alias("fluid_temperature"), (F.lit(50.0) + k / 2.0).alias("fluid_level"),
                    (F.lit(0.8) + k / 500.0).alias("pump_performance"), (F.lit(0.9) + k / 1000.0).alias("line_integrity"),
                    F.when(v > 330.0, "LEAK").when(v > 300.0, "PRESSURE_DROP").when(v > 250.0, "WARN")
                    .otherwise("NONE").alias("anomaly_flag"))


def fuel_readings(spark, sf_dir) -> DataFrame:
    """Fuel twin from ``lineitem`` (no unique key; ordering uses every column)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").cast("string").alias("fuel_system_id"),
                     F.col("l_suppkey").alias("aircraft_id"), F.col("l_shipdate").alias("event_timestamp"),
                     (F.col("l_quantity") * 2.0).alias("fuel_level"),
                     (F.col("l_extendedprice") / 50.0).alias("fuel_flow_rate"),
                     (F.lit(20.0) + F.col("l_discount") * 300.0).alias("fuel_pressure"),
                     (F.col("l_linenumber") * 10.0 - 40.0).alias("fuel_temperature"),
                     (F.col("l_tax") * 100.0 - 4.0).alias("tank_balance"),
                     (F.lit(0.8) + F.col("l_tax") * 2.5).alias("pump_health"),
                     F.when(F.col("l_returnflag") == "R", "FAIL").when(F.col("l_returnflag") == "A", "WARN")
                     .otherwise("NONE").alias("anomaly_flag"))


def landing_gear_readings(spark, sf_dir) -> DataFrame:
    """Landing gear twin from ``orders`` (aircraft = customer, time = order date).

    Metrics derive from the whole part of the price so every value has at most
    four decimals (7-row means then never sit on a rounding tie)."""
    o, p = table(spark, sf_dir, "orders"), F.floor("o_totalprice")
    return o.select(F.col("o_orderkey").cast("string").alias("gear_id"), F.col("o_custkey").alias("aircraft_id"),
                    F.col("o_orderdate").alias("event_timestamp"), (F.lit(2000.0) + p / 500.0).alias("hydraulic_pressure"),
                    (F.lit(0.1) + F.floor(p / 1000.0) / 2500.0).alias("strut_compression"),
                    (p / 5000.0).alias("brake_wear"),
                    (F.lit(100.0) + p / 1000.0).alias("brake_temperature"),
                    (F.lit(50.0) + p / 10000.0).alias("shock_absorber_status"))


def cabin_readings(spark, sf_dir) -> DataFrame:
    """Cabin pressurisation twin from ``lineitem`` (aircraft = supplier)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").cast("string").alias("cabin_id"), F.col("l_suppkey").alias("aircraft_id"),
                     F.col("l_shipdate").alias("event_timestamp"),
                     (F.lit(9.5) + F.col("l_tax") * 30.0).alias("cabin_pressure"),
                     (F.lit(80.0) + F.col("l_discount") * 200.0).alias("seal_integrity"),
                     (F.lit(250.0) + F.col("l_quantity") * 5.0).alias("airflow_rate"),
                     (F.lit(18.0) + F.col("l_linenumber").cast("double")).alias("temperature_control"),
                     (F.lit(30.0) + F.col("l_quantity") / 2.5).alias("humidity_level"))


def airframe_readings(spark, sf_dir) -> DataFrame:
    """Airframe twin from ``orders`` (whole part of the price, as landing gear)."""
    o, p = table(spark, sf_dir, "orders"), F.floor("o_totalprice")
    return o.select(F.col("o_orderkey").cast("string").alias("airframe_id"), F.col("o_custkey").alias("aircraft_id"),
                    F.col("o_orderdate").alias("event_timestamp"), (F.lit(150.0) + p / 3500.0).alias("stress_points"),
                    (p / 55000.0).alias("fatigue_crack_growth"), (p / 4500.0 - 50.0).alias("temperature_fluctuations"),
                    (F.lit(100.0) - p / 10000.0).alias("structural_integrity"))


def environmental_readings(spark, sf_dir) -> DataFrame:
    """Environmental twin: every event carries the weather seen by the aircraft."""
    e = table(spark, sf_dir, "events")
    k, v = json_number("props", "k"), F.col("value")
    t = F.col("event_type")
    return e.select(F.col("event_id").cast("string").alias("environmental_id"), F.col("user_id").alias("aircraft_id"),
                    F.col("ts").alias("event_timestamp"), (v / 5.0 - 60.0).alias("external_temperature"),
                    k.alias("humidity"), (v / 3.3).alias("wind_speed"), (k * 0.3).alias("crosswind_impact"),
                    F.when(t == "click", "RAIN").when(t == "view", "SNOW").when(t == "error", "STORM")
                    .otherwise("CLEAR").alias("precipitation"),
                    (F.lit(900.0) + v * 0.41).alias("atmospheric_pressure"),
                    F.when(k >= 97, "THUNDERSTORM").when(k >= 94, "SEVERE_WIND").when(k >= 85, "TURBULENCE")
                    .otherwise("NONE").alias("extreme_event"))


COMPONENT_SOURCES = {
    "environmental": environmental_readings,
    "landing_gear": landing_gear_readings,
    "cabin": cabin_readings,
    "airframe": airframe_readings,
    "engine": engine_readings,
    "avionics": avionics_readings,
    "electrical": electrical_readings,
    "hydraulic": hydraulic_readings,
    "fuel": fuel_readings,
}
