"""Inference plan: readings -> validate -> change + rolling mean -> score
with the champion (section 3.2), and the prediction sinks (K4, B6)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..ml.model import predict
from ..operators.features import add_features
from ..operators.validate import validate_reading
from ..sinks.files import write_predictions
from ..session import durable
from ..sinks.upsert import upsert


def score(readings: DataFrame, model: PipelineModel, **feature_kw) -> tuple[DataFrame, DataFrame]:
    """(predictions, invalid). Rows without a previous reading (no change)
    cannot be scored and are left out."""
    valid, invalid = validate_reading(readings)
    return score_features(add_features(valid, target=False, **feature_kw), model), invalid


def score_features(features: DataFrame, model: PipelineModel) -> DataFrame:
    """Predictions for the rows of a feature frame that have a change."""
    return predict(model, features.filter(F.col("temperature_change").isNotNull()))


def run_inference(readings: DataFrame, model: PipelineModel, out_path: str | None = None, *,
                  with_keys: bool = False, fmt: str = "csv", materialize_input: bool = True) -> DataFrame:
    """Scores the readings; with ``out_path`` also writes the prediction sink.
    The sources are parsed once into a Parquet stage first (range sampling and
    the shuffle would otherwise parse them twice)."""
    if materialize_input:
        readings = durable(readings, "readings")
    pred, _ = score(readings, model)
    if out_path:
        write_predictions(pred, out_path, with_keys=with_keys, fmt=fmt)
    return pred


def store_predictions(pred: DataFrame, store_path: str, model_version: int) -> DataFrame:
    """Prediction store keyed by (model_version, sensor_id, timestamp),
    insert-or-ignore, with the scoring time."""
    rows = pred.select(F.lit(int(model_version)).cast("long").alias("model_version"), "sensor_id",
                       "timestamp", "temperature", "prediction", "event_id", "source",
                       F.current_timestamp().alias("scored_at"))
    return upsert(store_path, rows, keys=("model_version", "sensor_id", "timestamp"))
