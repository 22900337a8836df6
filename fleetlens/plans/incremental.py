"""Incremental gold refresh: a batch rewrites only the cells it touches (X-03, T-02).

Gold rows stand in cells (month, hash bucket of the aircraft).  A batch of new
readings or maintenance changes the features of

* the aircraft and months of its own readings, and the readings that follow a
  maintenance event up to the next one of that aircraft; and
* the next ``ROLLING_ROWS - 1`` readings after those, which may lie in later
  months: a small table of rows per (aircraft, month) tells in which.

The cells of all these are computed again, from the readings of the cells and
of a halo (the ``ROLLING_ROWS - 1`` readings before each aircraft's first one
there, found by the same small table), and replace the old cells by dynamic
partition overwrite.  The rest of the table is neither read nor written, and
the result equals a full recompute, for late readings too.

Every write replaces partitions named by the batch or by a cell, so a batch
that is applied again, after a failure or by a repeated stream epoch, gives
the same tables.  One batch is applied at a time.  Lists on the driver hold
months and cells only (months x ``buckets``).  Readings without time are not
kept here (the full refresh drops none, they match no maintenance day).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.quality import clean
from ..operators.windows import latest_by
from ..session import ensure_checkpoint_dir
from ..sinks.tables import read_current, write_version
from ..sources.files import read_path_or_empty
from . import alerts as A
from . import sensor

CELL = ["month", "bucket"]
HALO = S.ROLLING_ROWS - 1


class IncrementalGold:
    """The E1 gold tables under ``root``, kept current batch by batch.

    ``readings_schema`` / ``maintenance_schema``: of the batches.  ``how`` and
    ``skew_bucket`` as in :func:`sensor.run`."""

    def __init__(self, spark: SparkSession, root: str, models: DataFrame, readings_schema, maintenance_schema,
                 run_ts: str, buckets: int = 16, how: str = "inner", skew_bucket=None):
        self.spark, self.root, self.models, self.run_ts = spark, root.rstrip("/"), models, run_ts
        self.schemas = {"readings": readings_schema, "maintenance": maintenance_schema}
        self.buckets, self.how, self.skew_bucket = buckets, how, skew_bucket

    # ------------------------------------------------------------- tables
    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str, schema: str = "aircraft_id string, month string, bucket int") -> DataFrame:
        return read_path_or_empty(self.spark, self.path(name), schema)

    def readings(self) -> DataFrame:
        extra = ", month string, batch string"
        return read_path_or_empty(self.spark, self.path("readings"), _ddl(self.schemas["readings"]) + extra)

    def maintenance(self) -> DataFrame:
        return read_path_or_empty(self.spark, self.path("maintenance"),
                                  _ddl(self.schemas["maintenance"]) + ", batch string").drop("batch")

    def alerts(self) -> DataFrame:
        """The alerts of all cells (a cell without any holds a marker row)."""
        return self.table("unified_alerts").filter(F.col("aircraft_id").isNotNull())

    def _put(self, df: DataFrame, name: str, by) -> None:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
         .parquet(self.path(name)))

    def _keep(self, df: DataFrame) -> DataFrame:
        """A small table of this batch, written once for its several readers."""
        path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/incremental-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _bucket(self, df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64("aircraft_id"), F.lit(self.buckets)).cast("int"))

    # -------------------------------------------------------------- apply
    def apply(self, batch_id, readings: DataFrame | None = None, maintenance: DataFrame | None = None) -> list:
        """Take up a batch; returns the cells (month, bucket) that were rewritten."""
        tag = F.lit(str(batch_id))
        touched = None
        if readings is not None:
            kept, quarantined = clean(readings)
            timed = kept.filter(F.col("timestamp").isNotNull()).withColumns(
                {"month": F.date_format("timestamp", "yyyy-MM"), "batch": tag})
            self._put(timed, "readings", ["batch", "month"])
            self._put(quarantined.withColumn("batch", tag), "quarantine", ["batch"])
            touched = self.readings().filter(F.col("batch") == str(batch_id)).select("aircraft_id", "month").distinct()
        if maintenance is not None:
            self._put(maintenance.withColumn("batch", tag), "maintenance", ["batch"])
            after = self._after_maintenance(maintenance)
            touched = after if touched is None else touched.unionByName(after).distinct()
        if touched is None:
            return []
        touched = self._keep(touched.filter(F.col("aircraft_id").isNotNull()))
        counts = self._keep(self._counts(touched))
        cells = sorted(tuple(r) for r in self._cells(touched, counts).collect())
        if not cells:
            return []
        self._rewrite(cells, counts)
        return cells

    def _after_maintenance(self, new: DataFrame) -> DataFrame:
        """(aircraft, month) with readings between a new event and the next one."""
        days = self.maintenance().filter(F.col("event_date").isNotNull()).select("aircraft_id", "event_date").distinct()
        until = F.lead("event_date").over(Window.partitionBy("aircraft_id").orderBy("event_date"))
        spans = days.withColumn("until", until).join(
            new.select("aircraft_id", "event_date").distinct(), ["aircraft_id", "event_date"], "left_semi").select(
            F.col("aircraft_id").alias("a"), F.date_format("event_date", "yyyy-MM").alias("m0"),
            F.coalesce(F.date_format("until", "yyyy-MM"), F.lit("9999-12")).alias("m1"))
        pairs = self.readings().select("aircraft_id", "month").distinct()
        return pairs.join(spans, (F.col("aircraft_id") == F.col("a")) & F.col("month").between(F.col("m0"), F.col("m1")),
                          "left_semi")

    def _counts(self, touched: DataFrame) -> DataFrame:
        """Feature rows per (aircraft, month) as they will be: stored counts,
        those of touched pairs counted anew."""
        months = [r[0] for r in touched.select("month").distinct().collect()]
        rows = self.readings().filter(F.col("month").isin(months)).join(touched, ["aircraft_id", "month"], "left_semi")
        if self.how == "inner":
            first = self.maintenance().groupBy(F.col("aircraft_id").alias("a")).agg(F.min("event_date").alias("first"))
            rows = rows.join(first, (F.col("aircraft_id") == F.col("a")) & (F.to_date("timestamp") >= F.col("first")))
        new = rows.groupBy("aircraft_id", "month").agg(F.count_distinct("timestamp").alias("n"))
        if not _exists(self.spark, self.path("month_counts")):
            return self._bucket(new)
        old = self.table("month_counts").select("aircraft_id", "month", "n").join(
            touched, ["aircraft_id", "month"], "left_anti")
        return self._bucket(old.unionByName(new))

    @staticmethod
    def _spans(counts: DataFrame) -> DataFrame:
        """Row numbers of each (aircraft, month): ``start`` (before it) and ``end``."""
        end = F.sum("n").over(Window.partitionBy("aircraft_id").orderBy("month"))
        return counts.withColumn("end", end).withColumn("start", F.col("end") - F.col("n"))

    def _cells(self, touched: DataFrame, counts: DataFrame) -> DataFrame:
        spans = self._spans(counts)
        changed = spans.join(touched, ["aircraft_id", "month"], "left_semi").select(
            F.col("aircraft_id").alias("a"), F.col("month").alias("m"), F.col("end").alias("e"))
        reached = (F.col("month") == F.col("m")) | ((F.col("month") > F.col("m"))
                                                   & (F.col("start") < F.col("e") + HALO))
        return spans.join(changed, (F.col("aircraft_id") == F.col("a")) & reached, "left_semi").select(*CELL).distinct()

    def _rewrite(self, cells: list, counts: DataFrame) -> None:
        spark = self.spark
        wanted = F.broadcast(spark.createDataFrame(cells, "month string, bucket int"))      # months x buckets rows
        spans = self._spans(counts)
        inside = spans.join(wanted, CELL, "left_semi")
        self_ = inside.select(F.col("aircraft_id").alias("a"), F.col("month").alias("m"), F.col("start").alias("s"))
        behind = (F.col("month") < F.col("m")) & (F.col("end") > F.col("s") - HALO)
        need = self._keep(spans.join(self_, (F.col("aircraft_id") == F.col("a"))
                                     & ((F.col("month") == F.col("m")) | behind), "left_semi")
                          .select("aircraft_id", "month"))
        months = [r[0] for r in need.select("month").distinct().collect()]
        readings = (self.readings().filter(F.col("month").isin(months))
                    .join(need, ["aircraft_id", "month"], "left_semi").drop("month", "batch"))
        maintenance = self.maintenance().join(need.select("aircraft_id").distinct(), "aircraft_id", "left_semi")
        features = sensor.sensor_features(
            sensor.enriched(readings, maintenance, self.models, self.how, self.skew_bucket), self.skew_bucket)
        features = self._bucket(features.withColumn("month", F.date_format("timestamp", "yyyy-MM")))
        self._put(features.join(wanted, CELL, "left_semi").hint("rebalance", *CELL), "sensor_features", CELL)
        rows = self._in_cells("sensor_features", cells)
        self._put(sensor.prediction_results(rows), "prediction_results", CELL)
        preds = self._in_cells("prediction_results", cells)
        self._put(self._unified(preds).unionByName(wanted, allowMissingColumns=True), "unified_alerts", CELL)
        self._put(inside.select("aircraft_id", "n", *CELL), "month_counts", CELL)
        self._refresh_view(preds.drop(*CELL))

    def _in_cells(self, name: str, cells: list) -> DataFrame:
        df = self.table(name)
        keys = [f"{m}/{b}" for m, b in cells]
        return df.filter(F.col("month").isin(sorted({m for m, _ in cells}))
                         & F.concat_ws("/", "month", "bucket").isin(keys))

    def _unified(self, preds: DataFrame) -> DataFrame:
        long = preds.select(F.lit("AC").alias("component_id"), "aircraft_id", "timestamp", "predicted_anomaly", *CELL)
        return A.unify_alerts(A.alerts_from_predictions(long, self.run_ts), self.spark, self.run_ts, passthrough=CELL)

    def _refresh_view(self, preds: DataFrame) -> None:
        """Latest row per aircraft: of the rewritten cells or, where that is
        older, as it was.  A rewritten row replaces the one of its own time."""
        new = sensor.engine_view(preds).withColumn("__new", F.lit(1))
        try:
            old = read_current(self.spark, self.path("engine_view")).withColumn("__new", F.lit(0))
        except FileNotFoundError:
            old = new.limit(0)
        both = latest_by(old.unionByName(new), ["aircraft_id"], ["timestamp", "__new"]).drop("__new")
        write_version(self.spark, self.path("engine_view"), both)

    def engine_view(self) -> DataFrame:
        return read_current(self.spark, self.path("engine_view"))

    # ------------------------------------------------------------- streams
    def follow(self, stream: DataFrame, checkpoint: str, kind: str):
        """Apply every micro-batch of a stream of ``readings`` or ``maintenance``."""
        def take(batch: DataFrame, epoch: int):
            self.apply(f"{kind}-{epoch}", **{kind: batch})

        q = (stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
        return q


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _exists(spark, path) -> bool:
    return bool(read_path_or_empty(spark, path, "aircraft_id string").columns != ["aircraft_id"])
