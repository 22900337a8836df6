"""Keyed stream state: lag, 7-row means and the latest maintenance (X-05, T-01, T-02).

Spark has no row-frame windows on streams.  :func:`features_stream` keeps, per
aircraft, what such a window needs of the past and nothing more: the last
``ROLLING_ROWS - 1`` readings and the latest maintenance event, both as entries
of a map state (key: the aircraft) in RocksDB under the query's checkpoint, with
an optional time to live for aircraft that fall silent.  A micro-batch
therefore reads and writes the entries of its own aircraft, however long the
history is, and a restart goes on where the checkpoint stands.

Rows are dealt out by ``GROUPS`` hash groups of aircraft, not by aircraft: a
call per aircraft costs milliseconds of pandas and state traffic whatever its
rows are, so a group's aircraft are computed together, in whole columns.

Readings of an aircraft must arrive in order of time from one micro-batch to
the next, and maintenance no later than the readings of its day; inside a
micro-batch any order will do.  A reading that is not later than the last one
seen is not dropped: it comes out with ``late`` set and NULL features, and the
incremental refresh (``plans/incremental.py``) puts its months right.

Only one group's rows of one micro-batch stand in memory (bound them with
``maxFilesPerTrigger``).  NULL metrics are ignored by the means, a mean over
NULLs only is NULL; readings without key or time are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from .. import schemas as S

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MEANS = {"avg_engine_temp_7d": "engine_temp", "avg_vibration_7d": "vibration", "avg_rpm_7d": "engine_rpm"}
_CASTS = {"anomaly_score": "int", "engine_rpm": "int", "battery_voltage": "double", "engine_temp": "double",
          "fuel_efficiency": "double", "vibration": "double", "altitude": "double", "airspeed": "double",
          "oil_pressure": "double", "capacity": "int", "range_km": "int"}
_TAIL = "us array<long>, anomaly array<double>, " + ", ".join(f"{c} array<double>" for c in MEANS.values())
#: hash groups of aircraft; a checkpoint's state is filed under them, so the number stays as it is
GROUPS = 2048


def trailing_mean(values: np.ndarray, n: int, place: np.ndarray | None = None) -> np.ndarray:
    """Mean of the last ``n`` values up to each one, added from the oldest on
    (as a window does); NaN is NULL.  ``place``: each value's place in its own
    run (from 0), where several runs stand one behind the other."""
    place = np.arange(len(values)) if place is None else place
    known = ~np.isnan(values)
    filled = np.where(known, values, 0.0)
    total, count = np.zeros(len(values)), np.zeros(len(values))
    for back in range(min(n, len(values)) - 1, -1, -1):
        inside = place[back:] >= back
        total[back:] += np.where(inside, filled[:len(values) - back], 0.0)
        count[back:] += inside & known[:len(values) - back]
    return np.divide(total, count, out=np.full(len(values), np.nan), where=count > 0)


class SensorState(StatefulProcessor):
    """Features of one group's readings from the state of its aircraft and its new rows."""

    def __init__(self, columns: list[str], rows: int = S.ROLLING_ROWS, inner: bool = True, ttl_ms: int | None = None):
        self.columns, self.rows, self.inner, self.ttl_ms = columns, rows, inner, ttl_ms

    def init(self, handle) -> None:
        self.tail = handle.getMapState("tail", "aircraft string", _TAIL, self.ttl_ms)
        self.maint = handle.getMapState("maintenance", "aircraft string", "day int, tie long, event_type string",
                                        self.ttl_ms)

    def handleInputRows(self, key, rows, timer_values) -> Iterator[pd.DataFrame]:
        # (columns whose names start with _ would lose them on the way into the worker)
        batch = pd.concat(list(rows), ignore_index=True)
        code, names = pd.factorize(batch["aircraft_id"])
        batch, names = batch.assign(code_=code), [str(x) for x in names]
        done = batch["side_"] == 0
        events = self._maintenance(batch[done], names)
        readings = batch[~done]
        if not len(readings):
            return
        readings = self._as_of(self._one_per_time(readings), events)
        if self.inner:
            readings = readings[readings["maint_day_"].notna()]
        if len(readings):
            yield self._features(readings, names)

    def _one_per_time(self, readings: pd.DataFrame) -> pd.DataFrame:
        """W-02: the greatest reading of an aircraft and time, in order of both."""
        at = ["code_", "us_"]
        twice = readings.duplicated(at, keep=False)
        if twice.any():
            rest = [c for c in self.columns if c not in ("aircraft_id", "timestamp")]
            best = (readings[twice].sort_values([*at, *rest], na_position="first", kind="stable")
                    .drop_duplicates(at, keep="last"))
            readings = pd.concat([readings[~twice], best])
        return readings.sort_values(at, kind="stable")

    def _maintenance(self, new: pd.DataFrame, names: list[str]) -> pd.DataFrame:
        """Known events of the group's aircraft in order of (aircraft, day, tie);
        the latest of an aircraft becomes its state."""
        known = [(c, *held) for c, name in enumerate(names) if (held := self.maint.getValue((name,))) is not None]
        added = [(c, int(d), None if t is None else int(t), e)
                 for c, d, t, e in zip(new["code_"], new["maint_day_"], new["tie_"], new["event_type"])]
        events = sorted(known + added, key=lambda x: (x[0], x[1], x[2] is not None, x[2] or 0))
        latest = {e[0]: e[1:] for e in events}
        for c in dict.fromkeys(e[0] for e in added):
            self.maint.updateValue((names[c],), latest[c])
        return pd.DataFrame(events, columns=["code", "day", "tie", "event_type"], dtype=object)

    @staticmethod
    def _as_of(readings: pd.DataFrame, events: pd.DataFrame) -> pd.DataFrame:
        def order(code, day):
            return code.astype("int64").to_numpy() * (1 << 33) + day.astype("int64").to_numpy()

        code, day = (events[c].astype("int64").to_numpy() for c in ("code", "day"))
        at = np.searchsorted(order(events["code"], events["day"]), order(readings["code_"], readings["day_"]),
                             side="right") - 1
        if not len(events):
            return readings.assign(maint_day_=np.nan, event_type=None)
        hit = (at >= 0) & (code[at] == readings["code_"].to_numpy())
        return readings.assign(maint_day_=np.where(hit, day[at].astype("float64"), np.nan),
                               event_type=np.where(hit, events["event_type"].to_numpy()[at], None))

    def _features(self, readings: pd.DataFrame, names: list[str]) -> pd.DataFrame:
        mine = readings["code_"].to_numpy()
        past = {c: held for c in np.unique(mine).tolist() if (held := self.tail.getValue((names[c],))) is not None}
        last = np.full(len(names), -np.inf)
        for c, held in past.items():
            last[c] = held[0][-1]
        late = readings["us_"].to_numpy() <= last[mine]
        now, behind = readings[~late], readings[late]
        # the held rows of every aircraft, then its new ones
        held_by = np.repeat(np.array(list(past), dtype="int64"), [len(h[0]) for h in past.values()])
        code = np.concatenate([held_by, now["code_"].to_numpy()])
        turn = np.argsort(code, kind="stable")
        code, new = code[turn], turn >= len(held_by)
        first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, dtype="int64")
        ends = np.r_[first[1:], len(code)] if len(code) else first
        place = np.arange(len(code)) - np.repeat(first, ends - first)

        def whole(i, fresh, kind="float64"):
            return np.concatenate([np.array([x for h in past.values() for x in h[i]], dtype=kind),
                                   fresh.astype(kind).to_numpy()])[turn]

        sources = ["anomaly_score", *MEANS.values()]
        us = whole(0, now["us_"], "int64")
        values = {src: whole(i + 1, now[src]) for i, src in enumerate(sources)}
        anomaly = values["anomaly_score"]
        before = np.where(place > 0, np.r_[np.nan, anomaly[:-1]], np.nan) if len(anomaly) else anomaly
        out = now.assign(prev_anomaly=before[new], late=False,
                         **{name: trailing_mean(values[src], self.rows, place)[new] for name, src in MEANS.items()})
        fresh = np.add.reduceat(new, first) > 0 if len(code) else []
        for a, z, any_new in zip(first.tolist(), ends.tolist(), fresh):
            if any_new:
                a = max(a, z - max(self.rows - 1, 1))                # (the lag needs one even if the means need none)
                self.tail.updateValue((names[code[a]],), (us[a:z].tolist(), *(
                    [_none(x) for x in values[src][a:z].tolist()] for src in sources)))
        behind = behind.assign(prev_anomaly=np.nan, late=True, **{name: np.nan for name in MEANS})
        both = pd.concat([out, behind]) if len(behind) else out
        since = both["day_"] - both["maint_day_"].astype("float64").fillna(0.0)
        return both.assign(days_since_maint=since)[[*self.columns, "event_type", *MEANS, "prev_anomaly",
                                                    "days_since_maint", "late"]]

    def close(self) -> None:
        pass


def _none(x):
    return None if x != x else float(x)


def features_stream(readings: DataFrame, maintenance: DataFrame, how: str = "inner", rows: int = S.ROLLING_ROWS,
                    ttl_ms: int | None = None) -> DataFrame:
    """Streams of clean readings (with the model reference joined) and of
    maintenance → T-02 feature rows (``SENSOR_FEATURE_COLS``) and ``late``.

    ``readings`` may lack the model reference columns; they are NULL then."""
    if how not in ("inner", "left"):
        raise ValueError(how)
    spark = readings.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    if ttl_ms:
        # with a time to live Spark always wants one more batch without data, so availableNow would never end
        spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    base = [c for c in S.SENSOR_FEATURE_COLS if c not in (*MEANS, "event_type", "prev_anomaly", "days_since_maint")]
    ts = F.col("timestamp")
    r = readings.select(*[F.col(c) if c in readings.columns else F.lit(None).cast("string").alias(c) for c in base])
    r = r.withColumns({c: F.col(c).cast(t) for c, t in _CASTS.items()})
    r = r.filter(ts.isNotNull() & F.col("aircraft_id").isNotNull()).withColumns(
        {"side_": F.lit(1), "us_": F.unix_micros(ts.cast("timestamp")), "day_": F.unix_date(F.to_date(ts))})
    tie = F.col("maint_id").cast("long") if "maint_id" in maintenance.columns else F.xxhash64("event_type")
    m = maintenance.filter(F.col("event_date").isNotNull() & F.col("aircraft_id").isNotNull()).select(
        "aircraft_id", "event_type", F.lit(0).alias("side_"), F.unix_date("event_date").alias("maint_day_"),
        tie.cast("string").alias("tie_"))                            # as text, for the reason below
    types = {f.name: f.dataType for f in r.schema.fields}
    # pandas holds a long column with NULLs as doubles, which would cut large values: they travel as text
    text = {c: types[c] for c in base if c != "aircraft_id" and isinstance(types[c], T.LongType)}
    both = r.withColumns({c: F.col(c).cast("string") for c in text}).unionByName(m, allowMissingColumns=True)
    types |= dict.fromkeys(text, T.StringType())
    out = T.StructType([T.StructField(c, types[c]) for c in base]
                       + [T.StructField("event_type", T.StringType())]
                       + [T.StructField(c, T.DoubleType()) for c in (*MEANS, "prev_anomaly", "days_since_maint")]
                       + [T.StructField("late", T.BooleanType())])
    group = F.pmod(F.xxhash64(F.col("aircraft_id").cast("string")), F.lit(GROUPS)).cast("int")
    made = both.withColumn("group_", group).groupBy("group_").transformWithStateInPandas(
        SensorState(base, rows, how == "inner", ttl_ms), out, "Append", "ProcessingTime" if ttl_ms else "None")
    return (made.withColumns({c: F.col(c).cast(t) for c, t in {**text, "days_since_maint": T.IntegerType()}.items()})
            .select(*S.SENSOR_FEATURE_COLS, "late"))
