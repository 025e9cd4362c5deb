import json
import os
import time

from pyspark.sql import functions as F

from sensorlake.schemas import READING_COLUMNS
from sensorlake.streaming.consumer import (
    await_all,
    deduplicate,
    file_source,
    parse_messages,
    split_stream,
    start_parquet,
)

BATCHES = [["00:00", "01:00"], ["00:20", "01:05"], ["00:21", "00:50", "00:56"], ["01:05"]]


def _write_batch(folder, i, times):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/batch-{i}.json"
    with open(path, "w") as f:
        for t in times:
            f.write(json.dumps({"sensor_id": "A", "timestamp": f"2024-01-01T{t}:00Z", "temperature": 370.0,
                                "humidity": 55.0, "is_faulty": False, "fault_type": None,
                                "source": "csv"}) + "\n")
    stamp = 1_700_000_000 + 10 * i
    os.utime(path, (stamp, stamp))


def _pipeline(spark, landing):
    valid, _ = split_stream(parse_messages(file_source(spark, landing, max_files_per_trigger=1)))
    return deduplicate(valid).select(*READING_COLUMNS)


def _times(spark, out):
    return sorted(r[0].strftime("%H:%M") for r in spark.read.parquet(out).select("timestamp").collect())


def test_late_rows_and_duplicates(spark, tmp_path):
    landing, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    for i, b in enumerate(BATCHES):
        _write_batch(landing, i, b)
    q = start_parquet(_pipeline(spark, landing), out, ck, available_now=True)
    await_all([q])
    assert _times(spark, out) == ["00:00", "00:20", "00:56", "01:00", "01:05"]
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
                  if p["stateOperators"])
    assert dropped == 2


def test_restart_from_checkpoint_keeps_state(spark, tmp_path):
    landing, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    for i, b in enumerate(BATCHES[:2]):
        _write_batch(landing, i, b)
    await_all([start_parquet(_pipeline(spark, landing), out, ck, available_now=True)])
    assert _times(spark, out) == ["00:00", "00:20", "01:00", "01:05"]
    for i, b in enumerate(BATCHES[2:], start=2):
        _write_batch(landing, i, b)
    time.sleep(0.1)
    await_all([start_parquet(_pipeline(spark, landing), out, ck, available_now=True)])
    # the repeated 01:05 is still known after the restart; late rows still dropped
    assert _times(spark, out) == ["00:00", "00:20", "00:56", "01:00", "01:05"]


def test_json_parsing_modes(spark):
    vals = ['{"sensor_id": "A", "timestamp": "2024-01-01T00:00:00Z", "temperature": 372.63, "humidity": 55}',
            '{"sensor_id": "A", "timestamp": "2024-01-01T00:00:00Z", "temperature": "372.63", "humidity": "55"}',
            '{"sensor_id": "A", "timestamp": "", "temperature": ""}',
            'garbage']
    msgs = spark.createDataFrame([(v, "t", 0, i) for i, v in enumerate(vals)],
                                 "value string, topic string, partition int, offset long")
    text = {r["offset"]: r for r in parse_messages(msgs).collect()}
    strict = {r["offset"]: r for r in parse_messages(msgs, strict=True).collect()}
    assert text[0]["temperature"] == 372.63 and strict[0]["temperature"] == 372.63
    assert text[1]["temperature"] == 372.63 and strict[1]["temperature"] is None
    assert text[2]["temperature"] is None and text[2]["timestamp"] is None
    assert text[3]["sensor_id"] is None and text[3]["value"] == "garbage"
    _, invalid = split_stream(parse_messages(msgs))
    reasons = {r["offset"]: r["reasons"] for r in invalid.collect()}
    assert reasons[2] == "Timestamp is missing, Temperature is missing, Humidity is missing"
    assert reasons[3].startswith("Sensor ID is missing")


def test_duplicate_event_sent_twice(spark, tmp_path):
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    os.makedirs(landing)
    ev = {"sensor_id": "TEST_SENSOR_01", "timestamp": "2026-10-06T12:00:00", "temperature": 370.50,
          "humidity": 55.00, "is_faulty": False, "fault_type": None, "source": "test"}
    with open(f"{landing}/a.json", "w") as f:
        f.write(json.dumps(ev) + "\n" + json.dumps(ev) + "\n")
    await_all([start_parquet(_pipeline(spark, landing), out, str(tmp_path / "ck"), available_now=True)])
    assert spark.read.parquet(out).count() == 1
    assert spark.read.parquet(out).filter(F.col("sensor_id") == "TEST_SENSOR_01").count() == 1


def test_quarantine_keeps_late_rows(spark, tmp_path):
    from sensorlake.streaming.consumer import quarantine_batch, run_quarantine
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i, b in enumerate(BATCHES):
        _write_batch(landing, i, b)
    await_all([run_quarantine(file_source(spark, landing, max_files_per_trigger=1), out)])
    assert _times(spark, f"{out}/valid") == ["00:00", "00:20", "00:56", "01:00", "01:05"]
    assert _times(spark, f"{out}/late") == ["00:21", "00:50"]
    # a retried batch replaces its own output instead of adding to it
    batch2 = spark.read.parquet(f"{out}/valid").filter(F.col("batch_id") == 2).drop("batch_id")
    quarantine_batch(batch2, 2, out)
    assert _times(spark, f"{out}/valid") == ["00:00", "00:20", "00:56", "01:00", "01:05"]


def test_stream_features_across_batches_equal_batch(spark, tmp_path):
    from conftest import SF_SMALL
    from sensorlake.operators.features import add_features
    from sensorlake.sinks.files import readings_to_json_value
    from sensorlake.sources.events import readings_raw
    from sensorlake.operators.validate import validate_reading
    from sensorlake.streaming.features import read_features, run_stream_features
    raw = readings_raw(spark, SF_SMALL)
    lines = [r["value"] for r in readings_to_json_value(raw.orderBy("timestamp", "event_id")).collect()]
    landing = tmp_path / "in"
    landing.mkdir()
    step = len(lines) // 4 + 1
    for i in range(4):
        p = landing / f"part-{i}.json"
        p.write_text("\n".join(lines[i * step:(i + 1) * step]) + "\n")
        os.utime(p, (1_700_000_000 + 10 * i,) * 2)
    valid, _ = split_stream(parse_messages(file_source(spark, str(landing), max_files_per_trigger=1)))
    out = str(tmp_path / "out")
    q = run_stream_features(valid.select(*READING_COLUMNS), out)
    await_all([q])
    assert len(q.recentProgress) >= 4
    assert spark.read.parquet(f"{out}/features").count() > 0      # most rows do not wait for the end
    assert spark.read.parquet(f"{out}/_state/3").count() < 200    # and few are carried on
    got = {r["event_id"]: r for r in read_features(spark, out, closed=True).collect()}
    batch = add_features(validate_reading(raw)[0]).filter(F.col("target_temperature").isNotNull())
    want = {r["event_id"]: r for r in batch.collect()}
    assert set(got) == set(want)
    for k, w in want.items():
        g = got[k]
        assert g["target_temperature"] == w["target_temperature"]
        assert g["temperature_change"] == w["temperature_change"] or \
            (g["temperature_change"] is None and w["temperature_change"] is None)
        assert abs(g["rolling_avg_temperature"] - w["rolling_avg_temperature"]) < 1e-9


def test_consumer_reports_quality_metrics(spark, tmp_path):
    from sensorlake.streaming.consumer import run_consumer
    landing = tmp_path / "in"
    landing.mkdir()
    rows = [{"sensor_id": "A", "timestamp": "2024-01-01T00:00:00Z", "temperature": 370.0, "humidity": 55.0,
             "source": "csv"},
            {"sensor_id": " ", "timestamp": "2024-01-01T00:01:00Z", "temperature": 500.0, "humidity": 55.0,
             "source": "csv"},
            {"sensor_id": "A", "timestamp": "2024-01-01T00:00:00Z", "temperature": 370.0, "humidity": 55.0,
             "source": "csv"}]
    (landing / "a.json").write_text("\n".join(json.dumps(r) for r in rows) + "\n")
    out = str(tmp_path / "out")
    q = run_consumer(file_source(spark, str(landing)), out, available_now=True)
    await_all([q])
    m = [p["observedMetrics"]["etl_quality"] for p in q.recentProgress if p.get("observedMetrics")]
    assert m and m[0]["rows"] == 3 and m[0]["valid_rows"] == 2 and m[0]["invalid_rows"] == 1
    assert sum(p["numInputRows"] for p in q.recentProgress) == 3          # the source is read once
    assert m[0]["missing_sensor_id"] == 1 and m[0]["temperature_out_of_range"] == 1
    assert spark.read.parquet(f"{out}/valid").count() == 1          # the repeat is dropped
    assert spark.read.parquet(f"{out}/invalid").count() == 1
    assert spark.read.parquet(f"{out}/raw").count() == 3


def test_aggregate_dedup_matches_state_dedup(spark, tmp_path):
    landing, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    for i, b in enumerate(BATCHES + [["03:00"]]):
        _write_batch(landing, i, b)
    valid, _ = split_stream(parse_messages(file_source(spark, landing, max_files_per_trigger=1)))
    q = start_parquet(deduplicate(valid.select(*READING_COLUMNS), mode="aggregate"), out, ck, available_now=True)
    await_all([q])
    got = _times(spark, out)
    # every key the watermark has passed is emitted once; late rows are dropped as with the native operator
    assert [t for t in got if t < "02:50"] == ["00:00", "00:20", "00:56", "01:00", "01:05"]


def test_stream_features_accept_disorder_and_keep_late_rows(spark, readings, tmp_path):
    """Rows inside the lateness are placed, one past it goes to ``late/``, a
    retried batch changes nothing."""
    from sensorlake.operators.features import add_features
    from sensorlake.streaming.features import features_batch, read_features
    out = str(tmp_path / "out")

    def row(i):
        return (i, "A" if i % 3 else "B", f"2024-01-01 {i // 60:02d}:{i % 60:02d}:00", 300.0 + i % 17, 50.0)
    batches = [[i for i in range(0, 60) if i % 10 != 5 or i < 50], [55, *range(60, 120)], [15, 112, *range(120, 150)]]
    # 112 is a repeat of a row, 15 is far behind the watermark (01:49), 55 is inside (00:49)
    rows = [[row(i) for i in b] for b in batches]
    for n, batch in enumerate(rows):
        features_batch(readings(batch), n, out)
    before = sorted(tuple(r) for r in read_features(spark, out, closed=True).collect())
    features_batch(readings(rows[2]), 2, out)
    assert sorted(tuple(r) for r in read_features(spark, out, closed=True).collect()) == before
    assert [r["event_id"] for r in spark.read.parquet(f"{out}/late").collect()] == [15]
    placed = readings([r for n, batch in enumerate(rows) for r in batch if (n, r[0]) != (2, 15)])
    want = add_features(placed).filter(F.col("target_temperature").isNotNull())
    key = lambda r: (r["event_id"], r["temperature_change"] or 0.0)
    got = sorted(read_features(spark, out, closed=True).collect(), key=key)
    want = sorted(want.collect(), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert (g["event_id"], g["target_temperature"], g["temperature_change"]) == \
            (w["event_id"], w["target_temperature"], w["temperature_change"])
        assert abs(g["rolling_avg_temperature"] - w["rolling_avg_temperature"]) < 1e-9
