"""Registered queries: ``(spark, sf_dir) -> DataFrame``, one per operator.

Each reads the driver's whole tables (through the events adapter) and runs
the library operators; the output follows ``plans.export`` conventions so it
can be compared with ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ml.model import coefficients, predict, train_model
from ..ml.registry import Registry
from ..ml.search import grid_search
from ..operators.calibrate import calibrate
from ..operators.faults import inject_faults
from ..operators.features import add_features
from ..operators.metrics import drift_report, drift_stats, quality_gate, regression_metrics, sensor_counts
from ..operators.reports import actual_vs_predicted, dashboard_histogram, dashboard_summary, etl_quality, preview
from ..operators.splits import label_numbered, label_reference_current, labelled_features
from ..operators import summaries
from ..operators.validate import dq_summary, reason_counts, validate_reading, with_reasons
from ..schemas import FEATURE_STORE_COLUMNS, READING_COLUMNS
from ..session import apply_runtime_conf, durable, read_if_exists, scratch_path
from ..sinks.curated import compact_curated, curated_files, read_curated, write_curated
from ..sinks.files import (
    ISO_TIME_TEXT,
    readings_to_json,
    readings_to_json_value,
    readings_to_wide_csv,
    write_csv,
    write_predictions,
)
from ..sinks.upsert import upsert
from ..sources.events import readings_dup, readings_raw, repeated
from ..sources.files import load_all, load_csv, load_json
from ..sources.folder import open_folder
from ..sources.table import load_table, pull_increment, stream_table, stream_table_by_id, write_table
from ..streaming.consumer import (
    SIMULATOR_COLUMNS,
    await_all,
    consumer_commits,
    csv_file_source,
    csv_tail_source,
    deduplicate,
    file_source,
    observe_quality,
    parse_messages,
    quarantine_quality,
    read_consumer,
    run_consumer,
    run_quarantine,
    split_stream,
    start_parquet,
)
from ..streaming.features import read_features, run_stream_features
from ..streaming.metrics import ProgressLog, await_logged, read_progress, stream_totals
from . import backfill
from .export import export
from .infer import run_inference, score_features, store_predictions
from .monitor import evaluate_on, run_monitoring
from .train import METRICS, fit_and_register, run_training

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_runtime_conf(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return fn
    return deco


def _valid(spark, sf_dir) -> DataFrame:
    return validate_reading(readings_raw(spark, sf_dir))[0]


# ------------------------------------------------------------ validation

@query("validate_reasons")
def q_validate_reasons(spark, sf_dir):
    """V1-V7: the reason list of every input row."""
    return with_reasons(readings_raw(spark, sf_dir)).select("event_id", "reasons")


@query("validate_valid")
def q_validate_valid(spark, sf_dir):
    """V8: valid rows."""
    return export(_valid(spark, sf_dir))


@query("validate_invalid")
def q_validate_invalid(spark, sf_dir):
    """V8/K1: rejects with every input column and their reasons."""
    return export(validate_reading(readings_raw(spark, sf_dir))[1])


@query("validate_reason_counts")
def q_reason_counts(spark, sf_dir):
    return reason_counts(readings_raw(spark, sf_dir))


@query("dq_summary")
def q_dq_summary(spark, sf_dir):
    """A3: data-quality counts in one pass."""
    return dq_summary(readings_raw(spark, sf_dir))


@query("sensor_counts")
def q_sensor_counts(spark, sf_dir):
    """A1: valid rows per sensor."""
    return sensor_counts(_valid(spark, sf_dir))


@query("preview")
def q_preview(spark, sf_dir):
    """L2: the first 20 valid rows in a stated order."""
    return export(preview(_valid(spark, sf_dir), order=("sensor_id", "timestamp", "event_id")))


# ------------------------------------------------------------ features

@query("features_all")
def q_features_all(spark, sf_dir):
    """Flagship: events -> readings -> validate -> F1 + F2 + F3."""
    return export(add_features(_valid(spark, sf_dir)), ("rolling_avg_temperature",))


@query("feat_change")
def q_feat_change(spark, sf_dir):
    f = add_features(_valid(spark, sf_dir), rolling=False, target=False)
    return export(f.select("event_id", "sensor_id", "timestamp", "temperature_change"))


@query("feat_rolling")
def q_feat_rolling(spark, sf_dir):
    f = add_features(_valid(spark, sf_dir), change=False, target=False)
    return export(f.select("event_id", "sensor_id", "timestamp", "rolling_avg_temperature"),
                  ("rolling_avg_temperature",))


@query("feat_target")
def q_feat_target(spark, sf_dir):
    f = add_features(_valid(spark, sf_dir), change=False, rolling=False)
    return export(f.select("event_id", "sensor_id", "timestamp", "target_temperature"))


# ------------------------------------------------------------ splits

@query("split_chrono")
def q_split_chrono(spark, sf_dir):
    """Per-sensor chronological 70/15/15 split."""
    lab = labelled_features(_valid(spark, sf_dir))
    return export(lab.select("event_id", "sensor_id", "timestamp", "row_num", "total_rows",
                             "train_end", "validation_end", "split"))


@query("split_ref_current")
def q_split_ref_current(spark, sf_dir):
    """Global 80/20 reference/current split by time."""
    lab = label_reference_current(_valid(spark, sf_dir))
    return export(lab.select("event_id", "timestamp", "row_number", "total_rows", "slice"))


# ------------------------------------------------------------ monitoring

@query("drift_stats")
def q_drift_stats(spark, sf_dir):
    """A2: mean and sample stddev per slice."""
    st = drift_stats(label_reference_current(_valid(spark, sf_dir)))
    return export(st, tuple(c for c in st.columns if c.endswith(("_mean", "_stddev"))))


@query("drift_report")
def q_drift_report(spark, sf_dir):
    """Percent change of mean/stddev, reference -> current, with status."""
    rep = drift_report(label_reference_current(_valid(spark, sf_dir)))
    return export(rep, ("reference_value", "current_value", "change_percent"))


def _persistence_validation(spark, sf_dir) -> DataFrame:
    """Validation split scored by the persistence forecast (prediction =
    current temperature): a model-free prediction the metrics can be checked
    on exactly."""
    lab = labelled_features(_valid(spark, sf_dir))
    return lab.filter(F.col("split") == "validation").withColumn("prediction", F.col("temperature"))


@query("eval_metrics")
def q_eval_metrics(spark, sf_dir):
    """A4/M4: MSE, MAE, RMSE, R² in one pass."""
    return export(regression_metrics(_persistence_validation(spark, sf_dir)), ("mse", "mae", "rmse", "r2"))


@query("quality_gate")
def q_quality_gate(spark, sf_dir):
    """M5: MAE <= 15."""
    return export(quality_gate(regression_metrics(_persistence_validation(spark, sf_dir))), ("mae",))


# ------------------------------------------------------------ stores

@query("upsert_first_wins")
def q_upsert_first_wins(spark, sf_dir):
    """Insert-or-ignore into a fresh reading store. The csv rows arrive
    first, then the whole batch (csv rows again included): stored rows win,
    and inside a batch the first in union order wins."""
    valid = validate_reading(readings_dup(spark, sf_dir))[0]
    path = scratch_path(spark, "reading-store")
    upsert(path, valid.filter(F.col("source") == "csv"))
    upsert(path, valid)
    return export(spark.read.parquet(path).select(*READING_COLUMNS))


def _feature_store(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "feature-store")
    rows = add_features(_valid(spark, sf_dir), target=False).select(*FEATURE_STORE_COLUMNS, "event_id", "source")
    upsert(path, rows)
    return spark.read.parquet(path).select(*FEATURE_STORE_COLUMNS)


@query("feature_store")
def q_feature_store(spark, sf_dir):
    """K3: feature-store insert-or-ignore (target not stored)."""
    return export(_feature_store(spark, sf_dir), ("rolling_avg_temperature",))


@query("feature_peek")
def q_feature_peek(spark, sf_dir):
    """L1: the first 10 stored features by (sensor, time)."""
    peek = _feature_store(spark, sf_dir).orderBy("sensor_id", "timestamp").limit(10)
    return export(peek, ("rolling_avg_temperature",))


# ------------------------------------------------------------ sources

def _landing(spark, readings: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    readings_to_json(readings, path)
    return path


@query("src_csv")
def q_src_csv(spark, sf_dir):
    """Readings exported as the wide process CSV, loaded back."""
    path = scratch_path(spark, "wide-csv")
    readings_to_wide_csv(readings_raw(spark, sf_dir), path)
    return export(load_csv(spark, path, id_col="event_id"))


@query("src_json")
def q_src_json(spark, sf_dir):
    """Reading objects in JSON landing files, loaded back."""
    path = _landing(spark, readings_raw(spark, sf_dir), "json-landing")
    return export(load_json(spark, path, source="api"))


def _table(spark, readings: DataFrame, name: str = "table") -> str:
    path = scratch_path(spark, name)
    write_table(readings, path)
    return path


@query("src_table")
def q_src_table(spark, sf_dir):
    """S3: readings in a table on shared storage, read back."""
    return export(load_table(spark, _table(spark, readings_raw(spark, sf_dir))))


@query("union_sources")
def q_union_sources(spark, sf_dir):
    """Each row goes to the source named in its ``source`` column (csv
    file, JSON landing, table), and the three loads are unioned by name."""
    raw = readings_raw(spark, sf_dir)
    csv_path = scratch_path(spark, "wide-csv")
    readings_to_wide_csv(raw.filter(F.col("source") == "csv"), csv_path)
    json_path = _landing(spark, raw.filter(F.col("source") == "api"), "json-landing")
    db = _table(spark, raw.filter(F.col("source") == "database"))
    return export(load_all(load_csv(spark, csv_path, id_col="event_id"),
                           load_json(spark, json_path, source="api"), load_table(spark, db)))


def _faulty(readings: DataFrame) -> DataFrame:
    """The fault columns that a reading table carries."""
    lost = F.col("humidity").isNull()
    return readings.withColumns({"is_faulty": lost, "fault_type": F.when(lost, F.lit("missing_humidity"))})


@query("incremental_table")
def q_incremental_table(spark, sf_dir):
    """Two tables (even and odd ids) with a mark each; the lower half of
    the ids is pulled, then the other half arrives and is pulled. ``pull``
    numbers the pull."""
    raw = _faulty(readings_raw(spark, sf_dir))
    cut = (raw.agg(F.max("event_id")).first()[0] or 0) // 2
    tables = [scratch_path(spark, "table-even"), scratch_path(spark, "table-odd")]
    marks, out = scratch_path(spark, "marks"), scratch_path(spark, "pulled")
    for pull, part in ((1, F.col("event_id") <= cut), (2, F.col("event_id") > cut)):
        for i, table in enumerate(tables):
            write_table(raw.filter(part & (F.col("event_id") % 2 == i)), table)
        pull_increment(spark, tables, marks, lambda rows, n=pull: rows.withColumn("pull", F.lit(n))
                       .write.mode("append").parquet(out))
    return export(spark.read.parquet(out))


@query("json_encode")
def q_json_encode(spark, sf_dir):
    """Readings published as JSON values (text files), read back with
    the generic JSON reader."""
    path = _landing(spark, readings_raw(spark, sf_dir), "published")
    return export(load_json(spark, path, source=None))


@query("json_decode")
def q_json_decode(spark, sf_dir):
    """Message bytes + envelope -> typed readings."""
    msgs = readings_to_json_value(readings_raw(spark, sf_dir)).select(
        F.encode("value", "UTF-8").alias("value"), F.lit("raw-sensor-readings").alias("topic"),
        F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"))
    return export(parse_messages(msgs).select(*READING_COLUMNS))


# ------------------------------------------------------------ streaming

def _run_stream(spark, df: DataFrame, name: str) -> DataFrame:
    base = scratch_path(spark, name)
    q = start_parquet(df, f"{base}/out", f"{base}/checkpoint", available_now=True)
    await_all([q])
    return spark.read.parquet(f"{base}/out")


def _stream_parsed(spark, readings: DataFrame, name: str) -> DataFrame:
    landing = _landing(spark, readings, name)
    return parse_messages(file_source(spark, landing))


ARRIVALS = 3
DELAY_SECONDS = 300      # below the allowed lateness of 10 minutes
HELD_EVERY = 89


def _arrival_steps(readings: DataFrame, later: Column | None = None) -> DataFrame:
    """``_step`` of each reading: ``ARRIVALS`` steps of equal time. Every 7th
    event comes 5 minutes after its event time, so times go back and forth
    inside a step and across steps. ``later`` delays rows by whole steps.
    Readings without a time come first."""
    arrival = F.unix_micros("timestamp") + F.when(F.col("event_id") % 7 == 0, DELAY_SECONDS * 1_000_000).otherwise(0)
    lo, hi = (t or 0 for t in readings.agg(F.min(arrival), F.max(arrival)).first())
    step = F.coalesce(F.floor((arrival - F.lit(lo)) / F.lit((hi - lo) // ARRIVALS + 1)), F.lit(0))
    return readings.withColumn("_step", F.least(step + (later if later is not None else F.lit(0)), F.lit(ARRIVALS - 1)))


def _arrivals(spark, steps: DataFrame, name: str):
    """Lands one step after the other; yields the folder after each."""
    landing = scratch_path(spark, name)
    steps = durable(steps, "arrivals")
    for i in range(ARRIVALS):
        readings_to_json(steps.filter(F.col("_step") == i), landing, mode="append")
        yield landing


def _resent(spark, sf_dir) -> DataFrame:
    """All readings, and copies of every 20th that arrive a step after it."""
    raw = readings_raw(spark, sf_dir)
    both = raw.withColumn("_copy", F.lit(0)).unionByName(
        repeated(raw).withColumn("_copy", F.lit(1)))
    return _arrival_steps(both, F.col("_copy"))


@query("stream_valid")
def q_stream_valid(spark, sf_dir):
    """Valid branch of the stream (one availableNow run)."""
    valid, _ = split_stream(_stream_parsed(spark, readings_raw(spark, sf_dir), "stream-landing"))
    return export(_run_stream(spark, valid.select(*READING_COLUMNS), "stream-valid"))


@query("stream_invalid")
def q_stream_invalid(spark, sf_dir):
    """Rejects of the stream with reasons."""
    _, invalid = split_stream(_stream_parsed(spark, readings_raw(spark, sf_dir), "stream-landing"))
    return export(_run_stream(spark, invalid.select(*READING_COLUMNS, "reasons"), "stream-invalid"))


@query("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    """Watermark + dedup on (sensor_id, timestamp, source) over several
    micro-batches and restarts; repeats come a batch later, where the state or
    the watermark keeps them out."""
    base = scratch_path(spark, "stream-dedup")
    for landing in _arrivals(spark, _resent(spark, sf_dir), "stream-landing"):
        valid, _ = split_stream(parse_messages(file_source(spark, landing)))
        await_all([start_parquet(deduplicate(valid).select(*READING_COLUMNS), f"{base}/out", f"{base}/checkpoint",
                                 available_now=True)])
    return export(spark.read.parquet(f"{base}/out"))


@query("stream_csv_ingest")
def q_stream_csv_ingest(spark, sf_dir):
    """Simulator CSV files arriving one file per micro-batch."""
    raw = readings_raw(spark, sf_dir)
    folder = scratch_path(spark, "csv-landing")
    write_csv(raw.select("sensor_id", F.date_format("timestamp", ISO_TIME_TEXT).alias("timestamp"),
                         "temperature", "humidity", F.col("humidity").isNull().alias("is_faulty"),
                         F.when(F.col("humidity").isNull(), F.lit("missing_humidity")).alias("fault_type"), "source", "event_id")
              .repartition(4), folder)
    return export(_run_stream(spark, csv_file_source(spark, folder, max_files_per_trigger=1), "stream-csv"))


# ------------------------------------------------------------ ML

# The noise in these tables keeps every model above the default
# gate, so the champion queries promote theirs through a wider one.
CHAMPION_MAE = 100.0


def _features(spark, sf_dir) -> DataFrame:
    return durable(add_features(_valid(spark, sf_dir), with_seq=True), "features")


def _champion(spark, features: DataFrame) -> Registry:
    """A registry whose champion was trained on the features' train split."""
    root = scratch_path(spark, "registry")
    fit_and_register(label_numbered(features), registry_root=root, max_mae=CHAMPION_MAE)
    return Registry(spark, root)


@query("train_linear")
def q_train_linear(spark, sf_dir):
    """M1-M2: fit on the train split; one row per coefficient."""
    lab = label_numbered(_features(spark, sf_dir))
    return export(coefficients(spark, train_model(lab.filter(F.col("split") == "train"))), ("coefficient",))


@query("predict_readings")
def q_predict_readings(spark, sf_dir):
    """M3/M7/K4: every valid reading that has a change, scored with the
    champion loaded from the registry (the prediction sink's columns + keys)."""
    feats = _features(spark, sf_dir)
    path = scratch_path(spark, "predictions")
    write_predictions(score_features(feats, _champion(spark, feats).load()), path, with_keys=True, fmt="parquet")
    return export(spark.read.parquet(path).withColumn("prediction", F.round("prediction", 4)))


@query("predict_csv")
def q_predict_csv(spark, sf_dir):
    """K4: the whole inference plan (readings -> validate -> features -> champion)
    into the default three-column CSV sink, read back."""
    champion = _champion(spark, _features(spark, sf_dir)).load()
    path = scratch_path(spark, "predictions-csv")
    run_inference(readings_raw(spark, sf_dir), champion, path)
    back = spark.read.schema("timestamp timestamp, temperature double, prediction double").option("header", True).csv(path)
    return export(back.withColumn("prediction", F.round("prediction", 4)))


@query("model_registry")
def q_model_registry(spark, sf_dir):
    """M5-M9: the training plan end to end into a fresh registry (its model fails
    the default gate), then a run with a wider gate that is registered and
    promoted; one row per logged run with parameters, metrics and outcome."""
    root = scratch_path(spark, "registry")
    first = run_training(readings_raw(spark, sf_dir), registry_root=root,
                         store_root=scratch_path(spark, "stores"), invalid_path=scratch_path(spark, "invalid"))
    fit_and_register(first.labelled, registry_root=root, max_mae=CHAMPION_MAE)
    reg = Registry(spark, root)
    params, metrics = F.col("params"), F.col("metrics")
    runs = reg.runs().select(
        "run_id", "run_name", "model_name",
        params["regParam"].cast("double").alias("reg_param"),
        params["elasticNetParam"].cast("double").alias("elastic_net_param"),
        params["features"].alias("features"),
        params["max_validation_mae"].cast("double").alias("max_mae"),
        *[F.round(metrics[f"{part}_{k}"], 6).alias(f"{part}_{k}")
          for part in ("validation", "test") for k in METRICS])
    versions = reg.versions().select("run_id", "version", F.length("signature").alias("signed"))
    champion = reg.aliases().select(F.col("version").alias("champion"))
    return (runs.join(versions, "run_id", "left").join(champion, F.col("version") == F.col("champion"), "left")
            .withColumns({"passed": F.col("version").isNotNull(), "is_champion": F.col("champion").isNotNull(),
                          "has_signature": F.coalesce(F.col("signed") > 0, F.lit(False))})
            .drop("run_id", "signed", "champion"))


@query("champion_eval")
def q_champion_eval(spark, sf_dir):
    """The champion, loaded from the registry, scores the reference slice
    (features recomputed on it); MAE, RMSE and the rest."""
    champion = _champion(spark, _features(spark, sf_dir)).load()
    out = evaluate_on(label_reference_current(_valid(spark, sf_dir)), champion, "reference")
    return export(out, ("mse", "mae", "rmse", "r2"))


@query("monitoring_run")
def q_monitoring_run(spark, sf_dir):
    """The monitoring plan end to end; one row per metric it logged."""
    reg = _champion(spark, _features(spark, sf_dir))
    done = run_monitoring(readings_raw(spark, sf_dir), reg.load(), registry_root=reg.root)
    logged = reg.runs().filter(F.col("run_id") == done.run_id)
    return export(logged.select("run_name", F.explode("metrics").alias("metric", "value")), ("value",))


@query("dashboard_actual_predicted")
def q_dashboard_actual_predicted(spark, sf_dir):
    """Actual against predicted temperature on the test split."""
    feats = _features(spark, sf_dir)
    champion = _champion(spark, feats).load()
    test = label_numbered(feats).filter(F.col("split") == "test")
    return export(actual_vs_predicted(predict(champion, test)).withColumns(
        {c: F.round(c, 4) for c in ("predicted", "residual")}))


# ------------------------------------------------------------ simulator operators

@query("calibrate")
def q_calibrate(spark, sf_dir):
    """Simulator settings learned from every numeric reading, in event order."""
    out = calibrate(readings_raw(spark, sf_dir))
    return export(out, tuple(c for c in out.columns if c not in ("n_rows", "enough_rows")))


@query("inject_faults")
def q_inject_faults(spark, sf_dir):
    """Hash-chosen faults on the valid readings (one field each)."""
    return export(inject_faults(_valid(spark, sf_dir), seed=42))


# ------------------------------------------------------------ tier B

@query("feat_humidity_trend")
def q_feat_humidity_trend(spark, sf_dir):
    """Humidity - previous humidity per sensor."""
    f = add_features(_valid(spark, sf_dir), change=False, rolling=False, target=False, humidity_trend=True)
    return export(f.select("event_id", "sensor_id", "timestamp", "humidity_trend"))


@query("eval_test_metrics")
def q_eval_test_metrics(spark, sf_dir):
    """MSE/MAE/RMSE/R² on the test split (persistence forecast)."""
    lab = labelled_features(_valid(spark, sf_dir))
    pred = lab.filter(F.col("split") == "test").withColumn("prediction", F.col("temperature"))
    return export(regression_metrics(pred), ("mse", "mae", "rmse", "r2"))


@query("dashboard_summary")
def q_dashboard_summary(spark, sf_dir):
    """Per sensor: rows, time range, latest reading, avg/max/min."""
    return export(dashboard_summary(_valid(spark, sf_dir)),
                  ("avg_temperature", "avg_humidity"))


def _summarised(spark, sf_dir) -> str:
    """Summary states after the consumer's accepted readings came in three steps, delayed and out of order."""
    path = scratch_path(spark, "summaries")
    steps = durable(_arrival_steps(_valid(spark, sf_dir)), "arrivals")
    for i in range(ARRIVALS):
        summaries.add_batch(steps.filter(F.col("_step") == i).drop("_step"), i, path)
    return path


@query("summary_states")
def q_summary_states(spark, sf_dir):
    """The dashboard summary from states per sensor and day, merged batch by
    batch; no reading is read again."""
    return export(summaries.summary(spark, _summarised(spark, sf_dir)), ("avg_temperature", "avg_humidity"))


@query("summary_histogram")
def q_summary_histogram(spark, sf_dir):
    """The readings' histograms from the same states."""
    return summaries.histogram(spark, _summarised(spark, sf_dir))


LATE_EVERY, CORRECTED_EVERY, CORRECTED_BY = 997, 499, 5.0


@query("backfill_dirty_days")
def q_backfill_dirty_days(spark, sf_dir):
    """Features of stored readings, then late readings (every 997th) and
    corrected ones (every 499th had another temperature) come in; features of the
    dirty days are computed again and replaced."""
    valid = durable(_valid(spark, sf_dir), "valid")
    late, wrong = F.col("event_id") % LATE_EVERY == 0, F.col("event_id") % CORRECTED_EVERY == 0
    first = valid.filter(~late).withColumn("temperature", F.when(wrong, F.col("temperature") - CORRECTED_BY)
                                           .otherwise(F.col("temperature")))
    readings, features = scratch_path(spark, "backfill-readings"), scratch_path(spark, "backfill-features")
    backfill.replace_days(backfill.with_date(first), readings)
    backfill.build_features(spark, readings, features)
    backfill.backfill(spark, valid.filter(late | wrong), readings, features)
    return export(spark.read.parquet(features).drop("event_date"), ("rolling_avg_temperature",))


@query("dashboard_histogram")
def q_dashboard_histogram(spark, sf_dir):
    """Fixed-width histograms of the four features per sensor."""
    return dashboard_histogram(add_features(_valid(spark, sf_dir), target=False))


@query("etl_quality")
def q_etl_quality(spark, sf_dir):
    """Valid, invalid and duplicate counts and rates of a batch with
    repeated events."""
    out = etl_quality(readings_dup(spark, sf_dir))
    return export(out, tuple(c for c in out.columns if c.endswith("_rate")))


@query("curated_layout")
def q_curated_layout(spark, sf_dir):
    """B2: valid readings written partitioned by event date, read back."""
    path = scratch_path(spark, "curated")
    write_curated(_valid(spark, sf_dir), path)
    return export(read_curated(spark, path))


@query("curated_compaction")
def q_curated_compaction(spark, sf_dir):
    """B2: valid readings appended in three steps, so that days lie in many small
    files, then packed; the rows, with the number of files of their day."""
    path = scratch_path(spark, "curated-steps")
    steps = durable(_arrival_steps(_valid(spark, sf_dir)), "arrivals")
    for i in range(ARRIVALS):
        write_curated(steps.filter(F.col("_step") == i).drop("_step"), path)
    compact_curated(spark, path)
    files = curated_files(spark, path).groupBy("event_date").agg(F.count(F.lit(1)).alias("day_files"))
    return export(read_curated(spark, path).join(files, "event_date"))


def _consumed(spark, readings: DataFrame) -> str:
    out = scratch_path(spark, "consumer")
    await_all([run_consumer(file_source(spark, _landing(spark, readings, "consumer-landing")), out, available_now=True)])
    return out


@query("consumer_run")
def q_consumer_run(spark, sf_dir):
    """The consumer over a landing folder of repeated events, one scan
    and one commit record per batch; the rows of its three tables (``sink``), raw
    messages parsed."""
    out = _consumed(spark, readings_dup(spark, sf_dir))
    tables = {name: read_consumer(spark, out, name) for name in ("valid", "invalid")}
    tables["raw"] = parse_messages(read_consumer(spark, out, "raw"))
    rows = [t.select(*READING_COLUMNS, F.col("reasons") if "reasons" in t.columns else F.lit(None).cast("string")
                     .alias("reasons"), F.lit(name).alias("sink")) for name, t in tables.items()]
    return export(reduce(DataFrame.unionByName, rows))


@query("replay_raw")
def q_replay_raw(spark, sf_dir):
    """Batch replay of the raw (bronze) table the consumer keeps:
    the same parse + validate functions over stored messages."""
    raw = read_consumer(spark, _consumed(spark, readings_raw(spark, sf_dir)), "raw")
    valid, _ = split_stream(parse_messages(raw))
    return export(valid.select(*READING_COLUMNS))


@query("consumer_batches")
def q_consumer_batches(spark, sf_dir):
    """The consumer over three arrivals with repeats and late rows, stopped
    and restarted between them; its commit records, one per batch."""
    out = scratch_path(spark, "consumer")
    for landing in _arrivals(spark, _held_back(spark, sf_dir), "consumer-landing"):
        await_all([run_consumer(file_source(spark, landing), out, available_now=True)])
    return consumer_commits(spark, out).select("batch_id", "rows", "valid_rows", "invalid_rows", "accepted_rows", "late_rows",
                                               "duplicate_rows", "missing_sensor_id", "temperature_out_of_range")


@query("stream_metrics")
def q_stream_metrics(spark, sf_dir):
    """The progress log of the deduplicating stream over three arrivals and
    restarts (rows, rule counts, rows dropped behind the watermark) beside the
    rows its sink holds."""
    base = scratch_path(spark, "stream-metrics")
    log = ProgressLog(f"{base}/progress")
    spark.streams.addListener(log)
    try:
        for landing in _arrivals(spark, _resent(spark, sf_dir), "stream-landing"):
            valid, _ = split_stream(observe_quality(parse_messages(file_source(spark, landing))))
            q = start_parquet(deduplicate(valid).select(*READING_COLUMNS), f"{base}/out", f"{base}/checkpoint", available_now=True)
            await_all([q])
            await_logged(log.folder, [q])
    finally:
        spark.streams.removeListener(log)
    mine = read_progress(spark, log.folder).filter(F.col("query_id") == str(q.id))
    return stream_totals(mine, spark.read.parquet(f"{base}/out"))


def _held_back(spark, sf_dir) -> DataFrame:
    """``_resent`` with every 89th event held back to the last step."""
    held = F.when(F.col("event_id") % HELD_EVERY == 0, ARRIVALS - 1).otherwise(F.col("_step"))
    return _resent(spark, sf_dir).withColumn("_step", held)


def _quarantined(spark, sf_dir) -> str:
    out = scratch_path(spark, "quarantine")
    for landing in _arrivals(spark, _held_back(spark, sf_dir), "quarantine-landing"):
        await_all([run_quarantine(file_source(spark, landing), out)])
    return out


@query("stream_late_quarantine")
def q_stream_late_quarantine(spark, sf_dir):
    """Repeated, delayed and late events through the quarantine policy over
    several micro-batches; ``status`` marks each row. Every 89th event is held
    back to the last step, where it is late if the watermark has passed it."""
    out = _quarantined(spark, sf_dir)
    acc = spark.read.parquet(f"{out}/valid").select(*READING_COLUMNS, F.lit("accepted").alias("status"))
    late = read_if_exists(spark, f"{out}/late")
    if late is not None:
        acc = acc.unionByName(late.select(*READING_COLUMNS, F.lit("late").alias("status")))
    return export(acc)


@query("late_rate")
def q_late_rate(spark, sf_dir):
    """Late rate of the same stream."""
    out = _quarantined(spark, sf_dir)
    return export(quarantine_quality(spark, out), ("late_rate",))


@query("stream_table")
def q_stream_table(spark, sf_dir):
    """S10 as a stream: a table's files read until every row has arrived."""
    path = _table(spark, _faulty(readings_raw(spark, sf_dir)))
    return export(_run_stream(spark, stream_table(spark, path, max_files_per_trigger=2), "table-stream"))


@query("stream_id_offsets")
def q_stream_id_offsets(spark, sf_dir):
    """S10 as a stream of ids: the lower half of a table is read, the query stops,
    rows with higher ids come in two appends to the same folder, and it goes on
    from its id."""
    raw = _faulty(readings_raw(spark, sf_dir))
    top = raw.agg(F.max("event_id")).first()[0] or 0
    table, base = scratch_path(spark, "id-table"), scratch_path(spark, "id-stream")
    for after, until in ((None, top // 2), (top // 2, 3 * top // 4), (3 * top // 4, top)):
        part = F.col("event_id") <= until if after is None else F.col("event_id").between(after + 1, until)
        write_table(raw.filter(part), table)
        if until != 3 * top // 4:
            await_all([start_parquet(stream_table_by_id(spark, table), f"{base}/out", f"{base}/checkpoint", available_now=True)])
    return export(spark.read.parquet(f"{base}/out"))


LINES_PER_FILE = 20_000


def _growing_files(spark, readings: DataFrame, folder: str):
    """The readings as simulator CSV files of at most ``LINES_PER_FILE`` lines, which
    grow in three steps; the first two end in the middle of a line. Yields after each."""
    lines = durable(readings.select(
        F.floor(F.col("event_id") / LINES_PER_FILE).alias("_file"), "event_id",
        F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in SIMULATOR_COLUMNS]).alias("line")), "csv-lines")
    header = ",".join(SIMULATOR_COLUMNS)

    def writer(step: int):
        def write(group):
            text = "\n".join([header, *group.sort_values("event_id")["line"], ""]).encode()
            cut = len(text) if step == ARRIVALS else max(text.find(b"\n", len(text) * step // ARRIVALS) - 7, len(header))
            files, root = open_folder(folder)
            files.create_dir(root, recursive=True)
            name = f"{root}/readings-{group['_file'].iloc[0]}.csv"
            with files.open_output_stream(f"{root}/_{name.rpartition('/')[2]}.writing", compression=None) as out:
                out.write(text[:cut])
            files.move(f"{root}/_{name.rpartition('/')[2]}.writing", name)
            return group[["_file"]].head(1)
        return write

    for step in range(1, ARRIVALS + 1):
        lines.groupBy("_file").applyInPandas(writer(step), "_file long").write.format("noop").mode("overwrite").save()
        yield


@query("stream_csv_tail")
def q_stream_csv_tail(spark, sf_dir):
    """Simulator CSV files that grow in three steps, two of which end inside a
    line; the stream restarts after each and reads the complete new lines."""
    raw = _faulty(readings_raw(spark, sf_dir)).withColumn("timestamp", F.date_format("timestamp", ISO_TIME_TEXT))
    folder, base = scratch_path(spark, "growing-csv"), scratch_path(spark, "csv-tail")
    for _ in _growing_files(spark, raw, folder):
        await_all([start_parquet(csv_tail_source(spark, folder), f"{base}/out", f"{base}/checkpoint", available_now=True)])
    return export(spark.read.parquet(f"{base}/out"))


@query("hyper_search")
def q_hyper_search(spark, sf_dir):
    """regParam x elasticNetParam grid on the chronological split."""
    found = grid_search(durable(label_numbered(_features(spark, sf_dir)), "labelled"))
    return export(found, ("mse", "mae", "rmse", "r2"))


@query("stream_features")
def q_stream_features(spark, sf_dir):
    """Features on the stream, over several micro-batches of readings that
    arrive out of order; the stream restarts between them."""
    out = scratch_path(spark, "stream-features")
    for landing in _arrivals(spark, _arrival_steps(readings_raw(spark, sf_dir)), "feature-landing"):
        valid, _ = split_stream(parse_messages(file_source(spark, landing)))
        await_all([run_stream_features(valid.select(*READING_COLUMNS), out)])
    return export(read_features(spark, out, closed=True), ("rolling_avg_temperature",))


@query("prediction_store")
def q_prediction_store(spark, sf_dir):
    """The champion's predictions stored insert-or-ignore by
    (model_version, sensor_id, timestamp) with the scoring time."""
    feats = _features(spark, sf_dir)
    reg = _champion(spark, feats)
    path = scratch_path(spark, "prediction-store")
    store_predictions(score_features(feats, reg.load()), path, reg.alias_version())
    return export(spark.read.parquet(path).withColumn("prediction", F.round("prediction", 4)).drop("scored_at"))
