"""Seeded, distributed synthetic data (G-01 … G-13).

Rows come from ``explode(sequence(...))`` over a fleet frame and every random
draw is a keyed hash of (seed, stream, aircraft, day/record), so output is
identical for any cluster size or partitioning and scales with the fleet.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens import schemas as S

_TWO53 = float(2 ** 53)


def uniform(seed: int, stream: str, *cols) -> Column:
    """U[0,1) from a 64-bit keyed hash."""
    h = F.xxhash64(F.lit(seed), F.lit(stream), *cols)
    return F.pmod(h, F.lit(2 ** 53)).cast("double") / _TWO53


def between(lo, hi, seed, stream, *cols) -> Column:
    return F.lit(lo) + (F.lit(hi) - F.lit(lo)) * uniform(seed, stream, *cols)


def normal(mu, sigma, seed, stream, *cols) -> Column:
    """Box–Muller from two keyed uniforms."""
    u1 = F.greatest(uniform(seed, stream + "#1", *cols), F.lit(1e-12))
    u2 = uniform(seed, stream + "#2", *cols)
    z = F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)
    return F.lit(mu) + F.lit(sigma) * z


def randint(lo, hi, seed, stream, *cols) -> Column:
    """Integer in [lo, hi]."""
    return (F.lit(lo) + F.floor(uniform(seed, stream, *cols) * (hi - lo + 1))).cast("int")


def _aircraft_plan(fleet: DataFrame, start: str, end: str, seed: int) -> DataFrame:
    a = F.col("aircraft_id")
    n_days = F.datediff(F.to_date(F.lit(end)), F.to_date(F.lit(start))) + 1
    p = fleet.select(
        "aircraft_id", "model",
        between(550, 600, seed, "base_temp", a).alias("base_temp"),
        between(80, 90, seed, "base_fuel", a).alias("base_fuel"),
        between(3.0, 6.0, seed, "base_vib", a).alias("base_vib"),
        between(0.05, 0.1, seed, "drift_temp", a).alias("drift_temp"),
        between(-0.1, -0.05, seed, "drift_fuel", a).alias("drift_fuel"),
        between(0.01, 0.03, seed, "drift_vib", a).alias("drift_vib"),
        randint(150, 180, seed, "sched", a).alias("sched_idx"),
        randint(250, 300, seed, "anomaly", a).alias("anom0"),
        n_days.alias("n_days"))
    anom = F.when(F.col("anom0") <= F.col("sched_idx"), F.col("sched_idx") + 50).otherwise(F.col("anom0"))
    anom = F.when(anom >= F.col("n_days"), F.col("n_days") - 60).otherwise(anom)
    return (p.withColumn("anomaly_idx", anom)
            .withColumn("repair_idx", F.least(F.col("anomaly_idx") + 1, F.col("n_days") - 1)))


def sensor_days(fleet: DataFrame, start: str = "2024-01-01", end: str = "2024-12-31", seed: int = 42) -> DataFrame:
    """G-01 + G-02: one reading per aircraft and day with drift, noise, one
    injected anomaly day and the post-repair recovery.  ``fleet`` has
    (aircraft_id, model)."""
    p = _aircraft_plan(fleet, start, end, seed)
    days = p.select("*", F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("day"))
    a, d = F.col("aircraft_id"), F.col("day")
    i = F.datediff(d, F.to_date(F.lit(start)))
    days = days.withColumn("day_idx", i)
    secs = randint(0, 86399, seed, "time", a, d)
    temp = F.col("base_temp") + F.col("drift_temp") * F.col("day_idx") + normal(0, 2, seed, "n_temp", a, d)
    fuel = F.col("base_fuel") + F.col("drift_fuel") * F.col("day_idx") + normal(0, 1, seed, "n_fuel", a, d)
    vib = F.col("base_vib") + F.col("drift_vib") * F.col("day_idx") + normal(0, 0.1, seed, "n_vib", a, d)
    is_anom = F.col("day_idx") == F.col("anomaly_idx")
    temp = F.when(is_anom, temp * 1.3).otherwise(temp)
    fuel = F.when(is_anom, fuel * 0.7).otherwise(fuel)
    vib = F.when(is_anom, F.greatest(vib * 3, vib + 5)).otherwise(vib)
    repaired = F.col("day_idx") >= F.col("repair_idx")
    temp2 = F.when(repaired, F.greatest(F.col("base_temp"), temp - 0.15 * F.col("base_temp"))).otherwise(temp)
    fuel2 = F.when(repaired, F.least(F.col("base_fuel"), fuel + 0.15 * F.col("base_fuel"))).otherwise(fuel)
    vib2 = F.when(repaired, F.greatest(F.lit(0.0), vib - 0.5 * F.col("base_vib"))).otherwise(vib)
    ts = F.timestamp_seconds(F.unix_timestamp(d.cast("timestamp")) + secs)
    return days.select(
        F.date_format(ts, S.TS_PATTERN).alias("timestamp"), "aircraft_id", "model",
        F.round(temp2, 2).alias("engine_temp"), F.round(fuel2, 2).alias("fuel_efficiency"),
        F.round(vib2, 3).alias("vibration"),
        F.round(normal(30000, 500, seed, "alt", a, d), 2).alias("altitude"),
        F.round(normal(450, 20, seed, "spd", a, d), 2).alias("airspeed"),
        F.when(is_anom, 1.0).otherwise(0.0).alias("anomaly_score"),
        F.round(between(30, 90, seed, "oil", a, d), 2).alias("oil_pressure"),
        F.floor(between(1500, 5000, seed, "rpm", a, d)).cast("int").alias("engine_rpm"),
        F.round(between(22.0, 28.0, seed, "volt", a, d), 2).alias("battery_voltage"))


def maintenance(fleet: DataFrame, start: str = "2024-01-01", end: str = "2024-12-31", seed: int = 42) -> DataFrame:
    """G-03: a routine check and the repair after the anomaly, per aircraft."""
    p = _aircraft_plan(fleet, start, end, seed)
    s = F.to_date(F.lit(start))
    ev = F.array(F.struct(F.date_add(s, F.col("sched_idx")).alias("d"), F.lit("Routine Check").alias("t")),
                 F.struct(F.date_add(s, F.col("repair_idx")).alias("d"), F.lit("Engine Repair").alias("t")))
    return p.select("aircraft_id", F.explode(ev).alias("e")).select(
        "aircraft_id", F.date_format("e.d", "yyyy-MM-dd").alias("event_date"), F.col("e.t").alias("event_type"))


# ---------------------------------------------------------------- FIXED VALUES
# value ranges of the component generators: (low, high) uniform, a list of
# codes drawn uniformly, or ("int", low, high)
COMPONENT_RANGES = {
    "engine": {"thrust_level": (50000, 120000), "fuel_consumption_rate": (2, 5), "temperature_reading": (300, 800),
               "vibration_level": (0.1, 2.0), "oil_pressure": (30, 80)},
    "cabin": {"cabin_pressure": (10, 12), "seal_integrity": (85, 100), "airflow_rate": (300, 500),
              "temperature_control": (18, 25), "humidity_level": (30, 50)},
    "airframe": {"stress_points": (150, 300), "fatigue_crack_growth": (1, 10),
                 "temperature_fluctuations": (-50, 70), "structural_integrity": (50, 100)},
    "landing_gear": {"hydraulic_pressure": (2000, 3000), "strut_compression": (0.1, 0.5), "brake_wear": (0, 100),
                     "brake_temperature": (100, 500), "shock_absorber_status": (50, 100)},
    "avionics": {"power_status": (90, 100), "signal_integrity": (25, 100), "data_transmission_rate": (100, 1000),
                 "system_temperature": (30, 60), "error_logs": ("int", 0, 10)},
    "electrical": {"battery_voltage": (24, 28), "charge_level": (50, 100), "power_distribution_efficiency": (85, 99),
                   "electrical_load": (100, 500), "transformer_health": (0.8, 1.0),
                   "fault_code": ["NONE", "WARN", "FAIL"]},
    "fuel": {"fuel_level": (10, 100), "fuel_flow_rate": (500, 2000), "fuel_pressure": (20, 50),
             "fuel_temperature": (-40, 60), "tank_balance": (-5, 5), "pump_health": (0.8, 1.0),
             "anomaly_flag": ["NONE", "WARN", "FAIL"]},
    "hydraulic": {"hydraulic_pressure": (2500, 3000), "fluid_temperature": (-20, 80), "fluid_level": (50, 100),
                  "pump_performance": (0.8, 1.0), "line_integrity": (0.9, 1.0),
                  "anomaly_flag": ["NONE", "WARN", "LEAK", "PRESSURE_DROP"]},
    "environmental": {"external_temperature": (-60, 40), "humidity": (0, 100), "wind_speed": (0, 150),
                      "crosswind_impact": (0, 30), "precipitation": ["CLEAR", "RAIN", "SNOW", "STORM"],
                      "atmospheric_pressure": (900, 1100),
                      "extreme_event": ["NONE", "TURBULENCE", "SEVERE_WIND", "THUNDERSTORM"]},
}
COMPONENT_RECORDS_PER_AIRCRAFT = 100
COMPONENT_WINDOW_DAYS = 7
# ------------------------------------------------------------ END FIXED VALUES


def component_records(key: str, fleet: DataFrame, end_ts: str, n: int = COMPONENT_RECORDS_PER_AIRCRAFT,
                      seed: int = 42) -> DataFrame:
    """G-04 … G-12: ``n`` readings per aircraft within the ``COMPONENT_WINDOW_DAYS``
    before ``end_ts``, in the raw CSV shape of the component spec (timestamps as text)."""
    spec = S.COMPONENTS[key]
    rng = COMPONENT_RANGES[key]
    rows = fleet.select("aircraft_id", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("rec"))
    a, r = F.col("aircraft_id"), F.col("rec")
    window = COMPONENT_WINDOW_DAYS * 86400
    ts = F.timestamp_seconds(F.unix_timestamp(F.lit(end_ts).cast("timestamp"))
                             - F.floor(uniform(seed, key + ".ts", a, r) * window))
    cols = [F.concat(F.lit(spec.alert_id + "_"), a.cast("string"), F.lit("_"), r.cast("string")).alias(spec.id_col),
            a.alias("aircraft_id"), F.date_format(ts, S.TS_PATTERN).alias("event_timestamp")]
    for name, _ in spec.metrics:
        g = rng[name]
        if isinstance(g, list):
            idx = randint(0, len(g) - 1, seed, f"{key}.{name}", a, r)
            cols.append(F.element_at(F.array(*[F.lit(x) for x in g]), idx + 1).alias(name))
        elif g[0] == "int":
            cols.append(randint(g[1], g[2], seed, f"{key}.{name}", a, r).alias(name))
        else:
            cols.append(F.round(between(float(g[0]), float(g[1]), seed, f"{key}.{name}", a, r), 4).alias(name))
    return rows.select(*cols)


def write_csv_drop(df: DataFrame, directory: str, prefix: str, run_stamp: str) -> str:
    """G-13: one new timestamped CSV drop per run (header on), for the stream ingest."""
    path = f"{directory.rstrip('/')}/{prefix}_{run_stamp}"
    df.write.mode("append").option("header", True).csv(path)
    return path
