"""Monitoring plan: readings -> validate -> reference/current split -> drift
report -> champion evaluation -> metric log (section 3.3, D1-D3)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..ml.model import predict
from ..ml.registry import Registry
from ..operators.features import add_features
from ..operators.metrics import drift_report, regression_metrics
from ..operators.splits import label_reference_current
from ..operators.validate import validate_reading
from ..session import durable


@dataclass
class MonitorResult:
    drift: DataFrame
    metrics: dict
    run_id: str | None


def evaluate_on(labelled: DataFrame, model: PipelineModel, eval_slice: str = "reference",
                **feature_kw) -> DataFrame:
    """Features over one slice, rows with change and target, scored; one
    metrics row (MAE, RMSE, ...)."""
    part = labelled.filter(F.col("slice") == eval_slice).drop("slice", "row_number", "total_rows")
    feats = add_features(part, **feature_kw).filter(
        F.col("temperature_change").isNotNull() & F.col("target_temperature").isNotNull())
    return regression_metrics(predict(model, feats))


def run_monitoring(readings: DataFrame, model: PipelineModel | None, *, registry_root: str | None = None,
                   eval_slice: str = "reference", threshold: float = C.DRIFT_THRESHOLD_PERCENT,
                   materialize_input: bool = True, **feature_kw) -> MonitorResult:
    if materialize_input:
        readings = durable(readings, "readings")
    valid, _ = validate_reading(readings)
    labelled = label_reference_current(valid)                     # materialised
    drift = drift_report(labelled, threshold=threshold)
    metrics = {}
    if model is not None:
        m = evaluate_on(labelled, model, eval_slice, **feature_kw).first()
        metrics = {"monitoring_mae": m["mae"], "monitoring_rmse": m["rmse"]}
    for r in drift.collect():                                     # 4 rows
        metrics[f"{r['column_name']}_{r['statistic']}_change_percent"] = r["change_percent"]
    run_id = None
    if registry_root:
        run_id = Registry(labelled.sparkSession, registry_root).log_run(
            "model-monitoring", {"eval_slice": eval_slice, "drift_threshold_percent": threshold}, metrics)
    return MonitorResult(drift, metrics, run_id)
