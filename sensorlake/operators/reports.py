"""Report tables: dashboard summaries and histograms (B10), ETL quality.

All are single aggregation passes with partial aggregation; ``latest`` uses
``max_by`` instead of a sort, so no per-sensor ordering is materialised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.rules import RULE_NAMES, is_valid, reason_columns

# --- fixed values: histogram bins (width, over the valid range) ----------
TEMPERATURE_BIN_WIDTH = 10.0
HUMIDITY_BIN_WIDTH = 5.0
CHANGE_RANGE = (-150.0, 150.0)   # the largest change inside the valid range
CHANGE_BIN_WIDTH = 20.0


def dashboard_summary(valid: DataFrame) -> DataFrame:
    latest = F.struct("timestamp", "event_id")
    return valid.groupBy("sensor_id").agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
        F.max_by("temperature", latest).alias("latest_temperature"),
        F.max_by("humidity", latest).alias("latest_humidity"),
        F.avg("temperature").alias("avg_temperature"),
        F.max("temperature").alias("max_temperature"),
        F.min("temperature").alias("min_temperature"),
        F.avg("humidity").alias("avg_humidity"),
        F.max("humidity").alias("max_humidity"),
        F.min("humidity").alias("min_humidity"),
    )


def _bin(col: str, lo: float, hi: float, width: float):
    n = int(round((hi - lo) / width))
    b = F.floor((F.col(col) - F.lit(lo)) / F.lit(width)).cast("long")
    return F.when(F.col(col).isNotNull(), F.least(F.greatest(b, F.lit(0)), F.lit(n - 1)))


def dashboard_histogram(features: DataFrame) -> DataFrame:
    """(sensor_id, column_name, bin, bin_low, n_rows) for the four features;
    bins of fixed width over the valid range, the top bound falling in the last
    bin. A missing value (a sensor's first change) is in no bin."""
    specs = [("temperature", *C.TEMPERATURE_RANGE, TEMPERATURE_BIN_WIDTH),
             ("humidity", *C.HUMIDITY_RANGE, HUMIDITY_BIN_WIDTH),
             ("temperature_change", *CHANGE_RANGE, CHANGE_BIN_WIDTH),
             ("rolling_avg_temperature", *C.TEMPERATURE_RANGE, TEMPERATURE_BIN_WIDTH)]
    # one scan: a row gives one entry per column
    entries = F.array(*[F.struct(F.lit(col).alias("column_name"), _bin(col, lo, hi, w).alias("bin"),
                                 F.lit(lo).alias("_lo"), F.lit(w).alias("_w")) for col, lo, hi, w in specs])
    u = (features.select("sensor_id", F.explode(entries).alias("_e")).select("sensor_id", "_e.*")
         .filter(F.col("bin").isNotNull()))
    return u.groupBy("sensor_id", "column_name", "bin").agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        F.first(F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_low"))


def actual_vs_predicted(pred: DataFrame) -> DataFrame:
    """One row per scored reading: what came 12 readings later, what the model
    said, and the difference."""
    actual, predicted = F.col("target_temperature"), F.col("prediction")
    return pred.select("event_id", "sensor_id", "timestamp", actual.alias("actual"),
                       predicted.alias("predicted"), (predicted - actual).alias("residual"))


def etl_quality(batch: DataFrame, keys=("sensor_id", "timestamp", "source")) -> DataFrame:
    """Rows in, valid, invalid, duplicate valid rows (repeats of a dedup key),
    rows that break each rule, and the rates. Two aggregation stages: per key, then global."""
    ok = is_valid()
    broken = [F.count_if(r.isNotNull()).alias(n) for r, n in zip(reason_columns(), RULE_NAMES)]
    per_key = batch.groupBy(*keys, ok.alias("_valid")).agg(F.count(F.lit(1)).alias("_n"), *broken)
    g = per_key.agg(
        F.sum("_n").cast("long").alias("total_rows"),
        F.sum(F.when(F.col("_valid"), F.col("_n")).otherwise(0)).cast("long").alias("valid_rows"),
        F.sum(F.when(~F.col("_valid"), F.col("_n")).otherwise(0)).cast("long").alias("invalid_rows"),
        F.sum(F.when(F.col("_valid"), F.col("_n") - 1).otherwise(0)).cast("long").alias("duplicate_rows"),
        *[F.sum(n).cast("long").alias(n) for n in RULE_NAMES],
    )
    return g.select(
        "*",
        F.try_divide(F.col("valid_rows"), F.col("total_rows")).alias("valid_rate"),
        F.try_divide(F.col("invalid_rows"), F.col("total_rows")).alias("invalid_rate"),
        F.try_divide(F.col("duplicate_rows"), F.col("valid_rows")).alias("duplicate_rate"),
        *[F.try_divide(F.col(n), F.col("total_rows")).alias(f"{n}_rate") for n in RULE_NAMES],
    )


def preview(df: DataFrame, n: int = 20, order: tuple[str, ...] = ("sensor_id", "timestamp")) -> DataFrame:
    """L2: the first ``n`` rows in a stated order (a top-n, not a full sort),
    for ``show()``-style previews that are the same on every run."""
    return df.orderBy(*order).limit(n)
