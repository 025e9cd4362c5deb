"""Dashboard summaries that are kept up to date.

One row of mergeable partial states per sensor and day: count, sums, least and
largest values, first and latest reading, histogram counts. A micro-batch is
aggregated to such rows, merged with the stored rows of the days it touches, and
only those days are replaced; dashboards add up a few states per sensor and never
read a reading again. Late and out-of-order readings merge like any other.

Each state knows the last batch it holds, so a batch that runs again (after a
failure halfway, or on a replay) changes nothing that it had already changed.
Readings must be deduplicated before. Single writer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..session import durable, read_if_exists
from .reports import HUMIDITY_BIN_WIDTH, TEMPERATURE_BIN_WIDTH, _bin

KEYS = ["sensor_id", "event_date"]
_VALUES = {"temperature": (*C.TEMPERATURE_RANGE, TEMPERATURE_BIN_WIDTH), "humidity": (*C.HUMIDITY_RANGE, HUMIDITY_BIN_WIDTH)}


def _bins(name: str) -> int:
    lo, hi, width = _VALUES[name]
    return int(round((hi - lo) / width))


def partial_states(valid: DataFrame, batch_id: int) -> DataFrame:
    """States of one batch: a row per sensor and day of it."""
    at, reading = F.struct("timestamp", "event_id"), F.struct("timestamp", "event_id", "temperature", "humidity")
    measures = [F.count(F.lit(1)).alias("n_rows"), F.min("timestamp").alias("first_timestamp"),
                F.max_by(reading, at).alias("latest")]
    for name, spec in _VALUES.items():
        which = _bin(name, *spec)
        measures += [F.sum(name).alias(f"{name}_sum"), F.min(name).alias(f"{name}_min"), F.max(name).alias(f"{name}_max"),
                     F.array(*[F.count_if(which == b) for b in range(_bins(name))]).alias(f"{name}_histogram")]
    return (valid.withColumn("event_date", F.to_date("timestamp")).groupBy(*KEYS).agg(*measures)
            .withColumn("last_batch", F.lit(batch_id).cast("long")))


def merged(states: DataFrame, keys: list[str]) -> DataFrame:
    """States of the same ``keys`` added up."""
    def total(name: str) -> Column:
        return F.array(*[F.sum(F.col(name)[b]) for b in range(_bins(name.rpartition("_")[0]))]).alias(name)

    measures = [F.sum("n_rows").alias("n_rows"), F.min("first_timestamp").alias("first_timestamp"),
                F.max_by("latest", F.struct("latest.timestamp", "latest.event_id")).alias("latest")]
    for name in _VALUES:
        measures += [F.sum(f"{name}_sum").alias(f"{name}_sum"), F.min(f"{name}_min").alias(f"{name}_min"),
                     F.max(f"{name}_max").alias(f"{name}_max"), total(f"{name}_histogram")]
    return states.groupBy(*keys).agg(*measures, F.max("last_batch").alias("last_batch"))


def add_batch(valid: DataFrame, batch_id: int, path: str) -> DataFrame:
    """Merges a batch into the states at ``path``; returns the days' new states. Use it
    in ``foreachBatch``, with the batch's id."""
    spark = valid.sparkSession
    new = durable(partial_states(valid, batch_id), "summary-batch")
    old = read_if_exists(spark, path)
    if old is not None:
        # the days of the batch only: partitions are pruned by the semi-join
        old = old.join(new.select("event_date").distinct(), "event_date", "left_semi").select(*new.columns)
        done = old.filter(F.col("last_batch") >= batch_id).select(*KEYS)
        new = merged(old.unionByName(new.join(done, KEYS, "left_anti")), KEYS).select(*new.columns)
    out = durable(new, "summary-days")       # read before its days are replaced
    (out.repartition("event_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("event_date").parquet(path))
    return out


def summary(spark: SparkSession, path: str) -> DataFrame:
    """The dashboard's summary (as ``reports.dashboard_summary``) from the states."""
    s = merged(spark.read.parquet(path), ["sensor_id"])
    return s.select(
        "sensor_id", F.col("n_rows").cast("long").alias("n_rows"), "first_timestamp",
        F.col("latest.timestamp").alias("last_timestamp"), F.col("latest.temperature").alias("latest_temperature"),
        F.col("latest.humidity").alias("latest_humidity"),
        *[c for name in _VALUES for c in ((F.col(f"{name}_sum") / F.col("n_rows")).alias(f"avg_{name}"),
                                          F.col(f"{name}_max").alias(f"max_{name}"), F.col(f"{name}_min").alias(f"min_{name}"))])


def histogram(spark: SparkSession, path: str) -> DataFrame:
    """Histograms of the readings (as ``reports.dashboard_histogram``) from the states."""
    s = merged(spark.read.parquet(path), ["sensor_id"])

    def bars(name: str, lo: float, width: float) -> Column:
        return F.transform(f"{name}_histogram", lambda n, i: F.struct(
            F.lit(name).alias("column_name"), i.cast("long").alias("bin"), n.cast("long").alias("n_rows"),
            (F.lit(lo) + i * F.lit(width)).alias("bin_low")))

    entries = F.flatten(F.array(*[bars(name, lo, width) for name, (lo, _, width) in _VALUES.items()]))
    return s.select("sensor_id", F.explode(entries).alias("_e")).select("sensor_id", "_e.*").filter(F.col("n_rows") > 0)
