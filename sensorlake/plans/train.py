"""Training plan: readings -> validate -> stores -> features -> split -> fit
-> evaluate -> gate -> register/promote (section 3.1 of the blueprint).

Every write is distributed; the only values brought to the driver are one
metrics row per split and the quality counts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..ml.model import params_of, predict, train_model
from ..ml.registry import Registry, signature
from ..operators.features import add_features
from ..operators.metrics import regression_metrics
from ..operators.splits import label_numbered
from ..operators.validate import dq_summary, validate_reading
from ..schemas import FEATURE_STORE_COLUMNS
from ..session import durable
from ..sinks.files import write_invalid
from ..sinks.upsert import first_wins, upsert, with_event_date


METRICS = ("mse", "mae", "rmse", "r2")


@dataclass
class TrainResult:
    model: PipelineModel
    metrics: dict
    passed: bool
    run_id: str
    version: int | None
    split_counts: dict = field(default_factory=dict)
    validation_predictions: DataFrame | None = None
    test_metrics: dict = field(default_factory=dict)
    sensors_without_target: int = 0     # sensors with <= 12 valid rows: no training row
    quality: dict = field(default_factory=dict)   # A3 counts of the input
    labelled: DataFrame | None = None   # the materialised split


def run_training(readings: DataFrame, *, registry_root: str, store_root: str | None = None,
                 invalid_path: str | None = None, max_mae: float = C.MAX_VALIDATION_MAE,
                 reg_param: float = C.REG_PARAM, elastic_net: float = C.ELASTIC_NET_PARAM,
                 model_name: str = C.MODEL_NAME, dedup_first: bool = False,
                 materialize_input: bool = True, **feature_kw) -> TrainResult:
    """``dedup_first``: build features on first-wins deduplicated readings
    (default: on every valid row, duplicates included). ``materialize_input``:
    the readings feed five scans (rejects, store, range sampling, shuffle,
    features); parse the sources once into a Parquet stage first."""
    spark = readings.sparkSession
    if materialize_input:
        readings = durable(readings, "readings")
    quality = dq_summary(readings).first().asDict()                              # A3
    valid, invalid = validate_reading(readings)
    if dedup_first:
        valid = first_wins(valid)
    if invalid_path:
        write_invalid(invalid, invalid_path)                                      # K1
    if store_root:
        upsert(f"{store_root}/sensor_readings", with_event_date(valid),
               partition_by=["event_date"])                                       # K2, B2
    feats = durable(add_features(valid, with_seq=True, **feature_kw))
    if store_root:
        upsert(f"{store_root}/sensor_features",
               with_event_date(feats.select(*FEATURE_STORE_COLUMNS, "event_id", "source")),
               partition_by=["event_date"])                                       # K3
    short = feats.groupBy("sensor_id").agg(F.max("key_rows").alias("n")) \
        .filter(F.col("n") <= C.TARGET_LEAD_ROWS).count()                       # D11
    result = fit_and_register(label_numbered(feats), registry_root=registry_root, max_mae=max_mae,
                              reg_param=reg_param, elastic_net=elastic_net, model_name=model_name, quality=quality)
    result.sensors_without_target = short
    return result


def fit_and_register(labelled: DataFrame, *, registry_root: str, max_mae: float = C.MAX_VALIDATION_MAE,
                     reg_param: float = C.REG_PARAM, elastic_net: float = C.ELASTIC_NET_PARAM,
                     model_name: str = C.MODEL_NAME, quality: dict | None = None) -> TrainResult:
    """The plan from a chronologically labelled frame (P1, materialised) on: fit
    on ``train``, score all splits in one grouped pass, log the run, and register
    and promote the model if its validation MAE passes the gate."""
    spark, quality = labelled.sparkSession, quality or {}
    labelled = durable(labelled, "labelled")                 # read by the fit, the scoring and the registration
    model = train_model(labelled.filter(F.col("split") == "train"), reg_param=reg_param,
                        elastic_net=elastic_net)                                  # M1, M2
    by_split = {r["split"]: r.asDict() for r in
                regression_metrics(predict(model, labelled), by=("split",)).collect()}   # M3, A4: 3 rows
    counts = {name: r["n_rows"] for name, r in by_split.items()}
    nothing = dict.fromkeys(METRICS)
    m, t = by_split.get("validation", nothing), by_split.get("test", nothing)
    metrics = {f"validation_{k}": m[k] for k in METRICS}                          # M4
    test_metrics = {f"test_{k}": t[k] for k in METRICS}                           # B7
    passed = m["mae"] is not None and m["mae"] <= max_mae                         # M5
    reg = Registry(spark, registry_root)
    run_id = reg.log_run("training", params_of(model, max_mae=max_mae),
                         {**metrics, **test_metrics, **quality}, model_name)      # M8
    pred = predict(model, labelled.filter(F.col("split") == "validation"))
    version = None
    if passed:                                                                    # M6, M9
        version = reg.register(model, run_id, metrics,
                               signature(pred.select("features"), pred.select("prediction")), model_name)
        reg.set_alias(version, C.CHAMPION_ALIAS, model_name)
    return TrainResult(model, metrics, passed, run_id, version, counts, pred, test_metrics, 0, quality, labelled)
