"""Calibrate simulator settings from readings.

Over rows where temperature and humidity are both numbers: mean, population
stddev, min, max of each; the step of each is min(pstdev of consecutive
differences, 0.1 * stddev), or the default when that is 0; the coupling is
cov_pop(t, h) / var_pop(t) clamped to [-2, 2], or the default when var is 0.
Differences are taken in input order, given by ``order_col``.

One aggregation pass for the moments; the consecutive differences use the
distributed sequence index and chunked lag (no single-task global window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .features import offset_values
from .sequence import sequence_index

D = C.SIMULATOR_DEFAULTS


def calibrate(readings: DataFrame, order_col: str = "event_id", *, chunk_rows: int = 1 << 12) -> DataFrame:
    nums = readings.filter(F.col("temperature").isNotNull() & F.col("humidity").isNotNull()) \
        .select(order_col, "temperature", "humidity")
    seq = sequence_index(nums, [], [order_col])
    diffs = offset_values(seq, [], [("_pt", "temperature", -1), ("_ph", "humidity", -1)], chunk_rows=chunk_rows)
    diffs = diffs.select(
        "temperature", "humidity",
        (F.col("temperature") - F.col("_pt")).alias("dt"),
        (F.col("humidity") - F.col("_ph")).alias("dh"),
    )
    m = diffs.agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        F.avg("temperature").alias("temp_mean"), F.stddev_pop("temperature").alias("temp_std"),
        F.min("temperature").alias("temp_min"), F.max("temperature").alias("temp_max"),
        F.avg("humidity").alias("hum_mean"), F.stddev_pop("humidity").alias("hum_std"),
        F.min("humidity").alias("hum_min"), F.max("humidity").alias("hum_max"),
        F.stddev_pop("dt").alias("_sd_dt"), F.stddev_pop("dh").alias("_sd_dh"),
        F.covar_pop("temperature", "humidity").alias("_cov"), F.var_pop("temperature").alias("_var_t"),
    )

    def step(sd_diff: str, std: str, default: float):
        s = F.least(F.col(sd_diff), F.col(std) * F.lit(C.STEP_STD_FRACTION))
        return F.when(s.isNull() | (s == 0), F.lit(default)).otherwise(s)

    coupling = F.when(F.col("_var_t") > 0,
                      F.greatest(F.lit(-C.COUPLING_CLAMP),
                                 F.least(F.lit(C.COUPLING_CLAMP), F.col("_cov") / F.col("_var_t")))) \
        .otherwise(F.lit(D["coupling"]))
    return m.select(
        "n_rows", "temp_mean", "temp_std", "temp_min", "temp_max",
        "hum_mean", "hum_std", "hum_min", "hum_max",
        step("_sd_dt", "temp_std", D["temp_step"]).alias("temp_step"),
        step("_sd_dh", "hum_std", D["hum_step"]).alias("hum_step"),
        coupling.alias("coupling"),
        (F.col("n_rows") >= C.MIN_CALIBRATION_ROWS).alias("enough_rows"),
    )
