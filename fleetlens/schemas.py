"""Domain schemas and the component specification table.

Everything in the ``FIXED VALUES`` blocks must equal the behaviour of the
original pipeline (column names, thresholds, codes, reference rows); it is
stated once here and every operator is generated from it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

TS_PATTERN = "yyyy-MM-dd HH:mm:ss"
TRACE_TS_PATTERN = "yyyyMMdd_HHmmss"

S, D, I = T.StringType(), T.DoubleType(), T.IntegerType()


def struct(cols):
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# ---------------------------------------------------------------- FIXED VALUES
# raw file schemas (timestamps arrive as text and are parsed at ingest)
RAW_SENSOR_COLS = [
    ("timestamp", S), ("aircraft_id", S), ("model", S), ("engine_temp", D),
    ("fuel_efficiency", D), ("vibration", D), ("altitude", D), ("airspeed", D),
    ("anomaly_score", D), ("oil_pressure", D), ("engine_rpm", I), ("battery_voltage", D),
]
MAINTENANCE_COLS = [("aircraft_id", S), ("event_date", S), ("event_type", S)]
AIRCRAFT_MODEL_COLS = [("model", S), ("manufacturer", S), ("engine_type", S),
                       ("capacity", I), ("range_km", I)]
CONFIG_COLS = [("env", S), ("config_key", S), ("config_value", S)]

# cleaning filter and warn-only expectations of the sensor stream
CLEAN_RULES = {"max_engine_temp": 700.0, "min_fuel_efficiency": 50.0, "max_vibration": 25.0}
EXPECTATIONS = {
    "valid_engine_temp": "engine_temp BETWEEN 0 AND 1000",
    "valid_fuel_eff": "fuel_efficiency > 0",
    "valid_vibration": "vibration >= 0",
}
# rule score of the simulated aircraft model
RULE_SCORE = {"temp_div": 700.0, "vib_div": 25.0, "sensor_w": 0.5, "prev_w": 0.3,
              "days_div": 100.0, "days_w": 0.2, "cut": 0.5}
ROLLING_ROWS = 7
EPOCH_DEFAULT_DATE = "1970-01-01"

# sensor feature table column order
SENSOR_FEATURE_COLS = [
    "timestamp", "aircraft_id", "model",
    "engine_temp", "fuel_efficiency", "vibration", "altitude", "airspeed",
    "oil_pressure", "engine_rpm", "battery_voltage", "anomaly_score", "event_type",
    "avg_engine_temp_7d", "avg_vibration_7d", "avg_rpm_7d", "prev_anomaly", "days_since_maint",
    "manufacturer", "engine_type", "capacity", "range_km",
]

# alert severity / category codes
SEVERITY_HIGH, SEVERITY_LOW = "HIGH", "LOW"
CATEGORY_CRITICAL_IDS = ("ENG", "LG", "AF")
CATEGORY_SAFETY_IDS = ("AV", "CP", "ES")
HEALTH_CRITICAL, HEALTH_WARNING, HEALTH_NOMINAL = "CRITICAL", "WARNING", "NOMINAL"
RISK_HIGH, RISK_NORMAL = "HIGH_RISK", "NORMAL"
# fleet health bands on a 0-100 score (dashboard design)
BAND_HEALTHY, BAND_WARNING = 80.0, 60.0
STATUS_SCORE = {"NOMINAL": 100.0, "WARNING": 70.0, "CRITICAL": 40.0}

# alert mart component configuration: (name, component_id, description)
ALERT_COMPONENTS = [
    ("Aircraft", "AC", "Full Aircraft Health"),
    ("Engine", "ENG", "Engine System"),
    ("Landing Gear", "LG", "Landing Gear System"),
    ("Avionics", "AV", "Avionics System"),
    ("Cabin Pressurization", "CP", "Cabin Pressurization System"),
    ("Airframe", "AF", "Airframe Structure"),
    ("Electrical Systems", "ES", "Electrical Systems"),
    ("Fuel Systems", "FS", "Fuel Systems"),
    ("Hydraulic Systems", "HS", "Hydraulic Systems"),
    ("Environmental Systems", "ENV", "Environmental Systems"),
    ("Auxiliary Systems", "AUX", "Auxiliary Systems"),
]
UNIFIED_ALERT_REQUIRED = [("timestamp", T.TimestampType()), ("aircraft_id", S),
                          ("predicted_anomaly", I), ("alert_day", T.DateType()),
                          ("batch_id", S)]
# ------------------------------------------------------------ END FIXED VALUES


@dataclass(frozen=True)
class ComponentSpec:
    """One component twin: raw schema, id column, health rule and features."""
    key: str                  # short name used in table names
    component_type: str       # tag in the unified component view
    alert_id: str             # id in the alert mart configuration
    id_col: str               # raw id column, renamed to component_id
    metrics: tuple            # ((name, type), ...) after id/aircraft/timestamp
    critical: tuple           # ((col, op, value), ...) any-of
    warning: tuple
    lags: tuple = ()          # ((new_col, source_col), ...)
    avgs: tuple = ()
    implemented_features: bool = True
    extra: dict = field(default_factory=dict)

    @property
    def raw_cols(self):
        return [(self.id_col, S), ("aircraft_id", S), ("event_timestamp", S), *self.metrics]

    @property
    def raw_schema(self) -> T.StructType:
        return struct(self.raw_cols)

    @property
    def metric_names(self):
        return [n for n, _ in self.metrics]


# ---------------------------------------------------------------- FIXED VALUES
# nine component twins: schemas, CRITICAL / WARNING triggers (any-of, strict
# comparisons) and lag / 7-row average features
COMPONENTS = {
    "engine": ComponentSpec(
        "engine", "Engine", "ENG", "engine_id",
        (("thrust_level", D), ("fuel_consumption_rate", D), ("temperature_reading", D),
         ("vibration_level", D), ("oil_pressure", D)),
        critical=(("temperature_reading", ">", 750), ("vibration_level", ">", 1.8), ("oil_pressure", "<", 40)),
        warning=(("temperature_reading", ">", 700), ("vibration_level", ">", 1.2), ("oil_pressure", "<", 50)),
        lags=(("prev_temp", "temperature_reading"), ("prev_vibration", "vibration_level")),
        avgs=(("avg_temp_7d", "temperature_reading"), ("avg_vibration_7d", "vibration_level"),
              ("avg_oil_pressure_7d", "oil_pressure")),
        implemented_features=False),
    "landing_gear": ComponentSpec(
        "landing_gear", "LandingGear", "LG", "gear_id",
        (("hydraulic_pressure", D), ("strut_compression", D), ("brake_wear", D),
         ("brake_temperature", D), ("shock_absorber_status", D)),
        critical=(("brake_temperature", ">", 450), ("brake_wear", ">", 80), ("shock_absorber_status", "<", 60)),
        warning=(("brake_temperature", ">", 350), ("brake_wear", ">", 60), ("shock_absorber_status", "<", 70)),
        lags=(("prev_brake_temp", "brake_temperature"), ("prev_brake_wear", "brake_wear")),
        avgs=(("avg_brake_temp_7d", "brake_temperature"), ("avg_brake_wear_7d", "brake_wear")),
        implemented_features=False),
    "avionics": ComponentSpec(
        "avionics", "Avionics", "AV", "avionics_id",
        (("power_status", D), ("signal_integrity", D), ("data_transmission_rate", D),
         ("system_temperature", D), ("error_logs", I)),
        critical=(("signal_integrity", "<", 20), ("error_logs", ">", 5), ("system_temperature", ">", 50)),
        warning=(("signal_integrity", "<", 30), ("error_logs", ">", 3), ("system_temperature", ">", 40)),
        lags=(("prev_signal_integrity", "signal_integrity"), ("prev_error_logs", "error_logs")),
        avgs=(("avg_signal_integrity_7d", "signal_integrity"), ("avg_error_logs_7d", "error_logs")),
        implemented_features=False),
    "cabin": ComponentSpec(
        "cabin", "CabinPressurization", "CP", "cabin_id",
        (("cabin_pressure", D), ("seal_integrity", D), ("airflow_rate", D),
         ("temperature_control", D), ("humidity_level", D)),
        critical=(("cabin_pressure", "<", 10), ("seal_integrity", "<", 85), ("airflow_rate", "<", 300)),
        warning=(("cabin_pressure", "<", 11), ("seal_integrity", "<", 90), ("airflow_rate", "<", 350)),
        lags=(("prev_cabin_pressure", "cabin_pressure"), ("prev_seal_integrity", "seal_integrity")),
        avgs=(("avg_cabin_pressure_7d", "cabin_pressure"), ("avg_seal_integrity_7d", "seal_integrity")),
        implemented_features=False),
    "airframe": ComponentSpec(
        "airframe", "Airframe", "AF", "airframe_id",
        (("stress_points", D), ("fatigue_crack_growth", D), ("temperature_fluctuations", D),
         ("structural_integrity", D)),
        critical=(("stress_points", ">", 280), ("fatigue_crack_growth", ">", 8), ("structural_integrity", "<", 60)),
        warning=(("stress_points", ">", 200), ("fatigue_crack_growth", ">", 5), ("structural_integrity", "<", 75)),
        lags=(("prev_stress_points", "stress_points"), ("prev_fatigue", "fatigue_crack_growth")),
        avgs=(("avg_stress_points_7d", "stress_points"), ("avg_fatigue_7d", "fatigue_crack_growth")),
        implemented_features=False),
    "electrical": ComponentSpec(
        "electrical", "ElectricalSystems", "ES", "electrical_id",
        (("battery_voltage", D), ("charge_level", D), ("power_distribution_efficiency", D),
         ("electrical_load", D), ("transformer_health", D), ("fault_code", S)),
        critical=(("battery_voltage", "<", 24), ("charge_level", "<", 30),
                  ("power_distribution_efficiency", "<", 85), ("fault_code", "=", "FAIL")),
        warning=(("battery_voltage", "<", 25), ("charge_level", "<", 50),
                 ("power_distribution_efficiency", "<", 90), ("fault_code", "=", "WARN")),
        lags=(("prev_battery_voltage", "battery_voltage"), ("prev_charge_level", "charge_level"),
              ("prev_power_efficiency", "power_distribution_efficiency")),
        avgs=(("avg_battery_voltage_7d", "battery_voltage"), ("avg_charge_level_7d", "charge_level"),
              ("avg_power_efficiency_7d", "power_distribution_efficiency"),
              ("avg_electrical_load_7d", "electrical_load"), ("avg_transformer_health_7d", "transformer_health"))),
    "fuel": ComponentSpec(
        "fuel", "FuelSystems", "FS", "fuel_system_id",
        (("fuel_level", D), ("fuel_flow_rate", D), ("fuel_pressure", D), ("fuel_temperature", D),
         ("tank_balance", D), ("pump_health", D), ("anomaly_flag", S)),
        critical=(("fuel_level", "<", 15), ("fuel_pressure", "<", 25), ("pump_health", "<", 0.85),
                  ("anomaly_flag", "=", "FAIL")),
        warning=(("fuel_level", "<", 25), ("fuel_pressure", "<", 30), ("pump_health", "<", 0.90),
                 ("anomaly_flag", "=", "WARN")),
        lags=(("prev_fuel_level", "fuel_level"), ("prev_fuel_pressure", "fuel_pressure"),
              ("prev_pump_health", "pump_health")),
        avgs=(("avg_fuel_level_7d", "fuel_level"), ("avg_fuel_pressure_7d", "fuel_pressure"),
              ("avg_pump_health_7d", "pump_health"), ("avg_fuel_flow_rate_7d", "fuel_flow_rate"),
              ("avg_tank_balance_7d", "tank_balance"))),
    "hydraulic": ComponentSpec(
        "hydraulic", "HydraulicSystems", "HS", "hydraulic_id",
        (("hydraulic_pressure", D), ("fluid_temperature", D), ("fluid_level", D),
         ("pump_performance", D), ("line_integrity", D), ("anomaly_flag", S)),
        critical=(("hydraulic_pressure", "<", 2400), ("fluid_level", "<", 60), ("pump_performance", "<", 0.85),
                  ("line_integrity", "<", 0.95), ("anomaly_flag", "in", ("LEAK", "PRESSURE_DROP"))),
        warning=(("hydraulic_pressure", "<", 2600), ("fluid_level", "<", 75), ("pump_performance", "<", 0.90),
                 ("line_integrity", "<", 0.98), ("anomaly_flag", "=", "WARN")),
        lags=(("prev_hydraulic_pressure", "hydraulic_pressure"), ("prev_fluid_level", "fluid_level"),
              ("prev_pump_performance", "pump_performance")),
        avgs=(("avg_hydraulic_pressure_7d", "hydraulic_pressure"), ("avg_fluid_level_7d", "fluid_level"),
              ("avg_pump_performance_7d", "pump_performance"),
              ("avg_fluid_temperature_7d", "fluid_temperature"), ("avg_line_integrity_7d", "line_integrity"))),
    "environmental": ComponentSpec(
        "environmental", "EnvironmentalSystems", "ENV", "environmental_id",
        (("external_temperature", D), ("humidity", D), ("wind_speed", D), ("crosswind_impact", D),
         ("precipitation", S), ("atmospheric_pressure", D), ("extreme_event", S)),
        critical=(("wind_speed", ">", 120), ("crosswind_impact", ">", 25), ("atmospheric_pressure", "<", 950),
                  ("extreme_event", "in", ("SEVERE_WIND", "THUNDERSTORM"))),
        warning=(("wind_speed", ">", 80), ("crosswind_impact", ">", 20), ("atmospheric_pressure", "<", 980),
                 ("extreme_event", "=", "TURBULENCE")),
        lags=(("prev_wind_speed", "wind_speed"), ("prev_atmospheric_pressure", "atmospheric_pressure"),
              ("prev_crosswind_impact", "crosswind_impact")),
        avgs=(("avg_wind_speed_7d", "wind_speed"), ("avg_atmospheric_pressure_7d", "atmospheric_pressure"),
              ("avg_crosswind_impact_7d", "crosswind_impact"),
              ("avg_external_temperature_7d", "external_temperature"), ("avg_humidity_7d", "humidity"))),
}

# static reference rows of the original pipeline
AIRCRAFT_MODELS = [
    ("A320", "Airbus", "CFM56", 180, 6150),
    ("B737", "Boeing", "LEAP-1B", 160, 5600),
    ("A330", "Airbus", "Trent 700", 277, 13450),
    ("B777", "Boeing", "GE90", 396, 15600),
    ("E190", "Embraer", "CF34", 100, 4500),
]
AIRPORTS = [
    ("SFO", "San Francisco Intl", "San Francisco", 37.6213, -122.3790),
    ("LAX", "Los Angeles Intl", "Los Angeles", 33.9416, -118.4085),
    ("JFK", "John F. Kennedy Intl", "New York", 40.6413, -73.7781),
    ("ORD", "O'Hare Intl", "Chicago", 41.9742, -87.9073),
]
AIRPORTS_V2 = AIRPORTS + [("DFW", "Dallas/Fort Worth Intl", "Dallas", 32.8998, -97.0403)]
AIRPORT_COLS = [("airport_code", S), ("airport_name", S), ("city", S), ("latitude", D), ("longitude", D)]
AIRCRAFT_BASES = [
    ("A320_101", "SFO"), ("A320_102", "SFO"), ("A320_103", "SFO"), ("A320_104", "SFO"),
    ("A330_301", "LAX"), ("A330_302", "LAX"), ("A330_303", "LAX"),
    ("B737_201", "JFK"), ("B737_202", "ORD"), ("B737_203", "ORD"),
]
AIRCRAFT_AIRPORTS_V2 = [
    ("A320_101", "SFO"), ("A320_102", "SFO"), ("A320_103", "SFO"), ("A320_104", "SFO"), ("A320_105", "SFO"),
    ("B737_201", "JFK"), ("B737_202", "JFK"), ("B737_203", "JFK"), ("B737_204", "JFK"), ("B737_205", "JFK"),
    ("B737_301", "JFK"),
    ("A330_201", "LAX"), ("A330_301", "LAX"), ("A330_302", "LAX"), ("A330_303", "LAX"), ("A330_304", "LAX"),
    ("A330_305", "LAX"),
    ("B777_401", "ORD"), ("B777_402", "ORD"), ("B777_403", "ORD"), ("B777_404", "ORD"), ("B777_405", "ORD"),
    ("E190_501", "SEA"), ("E190_502", "SEA"), ("E190_503", "SEA"), ("E190_504", "SEA"), ("E190_505", "SEA"),
]
COMPONENT_MASTER = [
    ("A320_101", "ENG_L1", "Engine", "Left Engine 1", "2022-05-10", "GE", "CFM56"),
    ("A320_101", "GEAR_M", "LandingGear", "Main Gear", "2021-11-15", "Honeywell", "LG-HYD-X"),
    ("A320_101", "AVN_SYS", "Avionics", "Avionics Suite", "2023-01-01", "Rockwell", "Fusion"),
    ("A320_101", "CABIN_PRESS", "CabinPressurization", "Cabin Press System", "2022-08-25", "Collins", "CPC-9000"),
    ("A320_101", "FRAME", "Airframe", "Main Fuselage", "2020-07-01", "Airbus", "AF-Shell"),
    ("A320_101", "EL_SYS", "ElectricalSystems", "Electrical Power System", "2022-03-15", "Honeywell", "EP-2000"),
    ("A320_101", "FUEL_SYS", "FuelSystems", "Fuel Management System", "2021-09-20", "Parker", "FMS-3000"),
    ("A320_101", "HYD_SYS", "HydraulicSystems", "Hydraulic Control System", "2022-01-10", "Eaton", "HCS-500"),
    ("A320_101", "ENV_SYS", "EnvironmentalSystems", "Environmental Control", "2022-06-05", "Collins", "ECS-400"),
]
COMPONENT_MASTER_COLS = ["aircraft_id", "component_id", "component_type", "component_name",
                         "install_date", "manufacturer", "model"]
# ------------------------------------------------------------ END FIXED VALUES

RAW_SENSOR_SCHEMA = struct(RAW_SENSOR_COLS)
MAINTENANCE_SCHEMA = struct(MAINTENANCE_COLS)
