"""Aggregate reports: counts, regression metrics, drift statistics.

Each is one aggregation pass (partial aggregation per task, one tiny final
stage) that returns a DataFrame; nothing is collected inside an operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C


def sensor_counts(df: DataFrame) -> DataFrame:
    """Rows per sensor."""
    return df.groupBy("sensor_id").agg(F.count(F.lit(1)).cast("long").alias("total_rows"))


def regression_metrics(pred: DataFrame, label: str = "target_temperature",
                       prediction: str = "prediction", by: tuple[str, ...] = ()) -> DataFrame:
    """MSE, MAE, RMSE (and R², n) in one pass, one row per ``by`` group; equals
    RegressionEvaluator, which would take one pass per metric."""
    e = F.col(prediction) - F.col(label)
    row = pred.groupBy(*by).agg(
        F.avg(e * e).alias("mse"),
        F.avg(F.abs(e)).alias("mae"),
        F.var_pop(F.col(label)).alias("_var_y"),
        F.count(F.lit(1)).cast("long").alias("n_rows"),
    )
    return row.select(
        *by, "mse", "mae", F.sqrt("mse").alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.col("mse"), F.col("_var_y"))).alias("r2"),
        "n_rows",
    )


def quality_gate(metrics: DataFrame, max_mae: float = C.MAX_VALIDATION_MAE) -> DataFrame:
    """Pass iff MAE <= max_mae (inclusive)."""
    return metrics.select("mae", F.lit(float(max_mae)).alias("max_mae"),
                          (F.col("mae") <= F.lit(float(max_mae))).alias("passed"))


# ----------------------------------------------------------------- drift

_STATS = (("mean", F.avg), ("stddev", F.stddev_samp))


def drift_stats(labelled: DataFrame, columns=C.MONITORING_COLUMNS) -> DataFrame:
    """Per slice: mean and sample stddev of each monitored column."""
    aggs = [F.count(F.lit(1)).cast("long").alias("n_rows")]
    for col in columns:
        for name, fn in _STATS:
            aggs.append(fn(col).alias(f"{col}_{name}"))
    return labelled.groupBy("slice").agg(*aggs)


def _status(change: Column, threshold: float) -> Column:
    return (F.when(change.isNull(), F.lit("UNKNOWN"))
            .when(F.abs(change) > F.lit(float(threshold)), F.lit("DRIFT"))
            .otherwise(F.lit("OK")))


def drift_report(labelled: DataFrame, columns=C.MONITORING_COLUMNS,
                 threshold: float = C.DRIFT_THRESHOLD_PERCENT) -> DataFrame:
    """Long report, one row per (column, statistic): reference and current
    value, percent change ``(cur - ref) / ref * 100`` and status ``DRIFT`` iff
    |change| > threshold (strict), ``UNKNOWN`` when the change is undefined
    (zero or missing reference). One conditional aggregation over both slices."""
    is_ref = F.col("slice") == "reference"
    aggs = []
    for col in columns:
        for name, fn in _STATS:
            aggs.append(fn(F.when(is_ref, F.col(col))).alias(f"r_{col}_{name}"))
            aggs.append(fn(F.when(~is_ref, F.col(col))).alias(f"c_{col}_{name}"))
    wide = labelled.agg(*aggs)
    pairs = [(col, name) for col in columns for name, _ in _STATS]
    stack = "stack({n}, {body}) AS (column_name, statistic, reference_value, current_value)".format(
        n=len(pairs),
        body=", ".join(f"'{c}', '{s}', r_{c}_{s}, c_{c}_{s}" for c, s in pairs))
    long = wide.selectExpr(stack)
    change = F.try_divide(F.col("current_value") - F.col("reference_value"),
                          F.col("reference_value")) * F.lit(100.0)
    return long.withColumn("change_percent", change).withColumn(
        "status", _status(F.col("change_percent"), threshold))
