"""Features on a stream (B9), with the batch operator and no per-sensor task.

A reading's features are final once its 12th successor is at or before the
watermark (newest event time minus the allowed lateness): nothing that still
may arrive can come between. So each micro-batch takes the readings that are
not final yet together with what their frames reach back to, adds the new
readings, runs ``add_features`` (skew-safe: no sensor is one task), emits the
readings that became final, and keeps the rest for the next batch:

* readings not emitted yet,
* readings of the 30 minutes before a sensor's first such reading, and
* the sensor's last emitted reading (the predecessor for its change).

Readings may arrive out of order within the lateness, in any batch. One that
arrives at or before the watermark can no longer be placed without changing
emitted rows; it goes to ``late/``, not away. Output and state are written per
batch, so a retried batch replaces its own.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import config as C
from ..operators.features import add_features, epoch_seconds
from ..schemas import READING_COLUMNS
from ..session import durable, read_if_exists, temporary_stages
from .state import read_state, replace_batch, write_state

FEATURES = ["temperature_change", "rolling_avg_temperature", "target_temperature"]
LATENESS_SECONDS = 600


def _context(rows: DataFrame) -> DataFrame:
    """The rows (with ``emitted``) that readings not emitted yet still need."""
    at = F.struct("timestamp", "event_id")
    need = rows.groupBy(F.col("sensor_id").alias("_sensor")).agg(
        F.min(F.when(~F.col("emitted"), epoch_seconds(F.col("timestamp")))).alias("_pending"),
        F.max(F.when(F.col("emitted"), at)).alias("_last"))
    kept = (~F.col("emitted") | (epoch_seconds(F.col("timestamp")) >= F.col("_pending") - C.ROLLING_WINDOW_SECONDS)
            | (at == F.col("_last")))
    return rows.join(need, rows["sensor_id"] == need["_sensor"]).filter(kept).select(*READING_COLUMNS, "emitted")


def features_batch(batch: DataFrame, batch_id: int, out_dir: str, *, lateness_seconds: int = LATENESS_SECONDS) -> None:
    """One micro-batch of valid readings."""
    spark = batch.sparkSession
    with temporary_stages(spark):
        arrived = durable(batch.select(*READING_COLUMNS), "feature-batch")
        newest = arrived.agg(F.max("timestamp")).first()[0]
        known, mark = (read_state(spark, f"{out_dir}/_state", batch_id),
                       read_state(spark, f"{out_dir}/_newest", batch_id))
        fresh = arrived.withColumn("emitted", F.lit(False))
        before = mark.first()["newest"] if mark is not None else None
        allowed = _dt.timedelta(seconds=lateness_seconds)
        if before is not None:
            late = F.col("timestamp") <= F.lit(before - allowed)
            replace_batch(arrived.filter(late).withColumn("batch_id", F.lit(batch_id).cast("long")), f"{out_dir}/late")
            fresh = fresh.filter(~late)
            newest = before if newest is None else max(before, newest)
        rows = fresh if known is None else known.unionByName(fresh)
        final = F.lit(False) if newest is None else \
            F.coalesce(F.col("target_time") <= F.lit(newest - allowed), F.lit(False))
        featured = durable(add_features(rows, target_time=True).withColumn("_final", final), "features")
        replace_batch(featured.filter(F.col("_final") & ~F.col("emitted"))
                      .select(*READING_COLUMNS, *FEATURES, F.lit(batch_id).cast("long").alias("batch_id")),
                      f"{out_dir}/features")
        write_state(_context(featured.withColumn("emitted", F.col("emitted") | F.col("_final"))),
                    f"{out_dir}/_state", batch_id)
        write_state(spark.createDataFrame([(batch_id, newest)], "batch_id long, newest timestamp"),
                    f"{out_dir}/_newest", batch_id)


def run_stream_features(valid: DataFrame, out_dir: str, *, lateness_seconds: int = LATENESS_SECONDS,
                        available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Streaming valid readings -> ``features/`` and ``late/`` under ``out_dir``."""
    w = valid.writeStream.option("checkpointLocation", f"{out_dir}/_checkpoint").foreachBatch(
        lambda df, batch_id: features_batch(df, batch_id, out_dir, lateness_seconds=lateness_seconds))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def read_features(spark: SparkSession, out_dir: str, *, closed: bool = False) -> DataFrame | None:
    """Emitted feature rows. ``closed``: no more readings will come (the end of a
    replay), so readings whose target is known count too, watermark or not."""
    out = read_if_exists(spark, f"{out_dir}/features")
    out = None if out is None else out.drop("batch_id")
    last = read_if_exists(spark, f"{out_dir}/_newest/*")
    if not closed or last is None:
        return out
    state = spark.read.parquet(f"{out_dir}/_state/{last.agg(F.max('batch_id')).first()[0]}")
    rest = (add_features(state).filter(~F.col("emitted") & F.col("target_temperature").isNotNull())
            .select(*READING_COLUMNS, *FEATURES))
    return rest if out is None else out.unionByName(rest)
