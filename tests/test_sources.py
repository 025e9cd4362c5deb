import json

import pytest

from pyspark.sql import functions as F

from conftest import SF_SMALL
from sensorlake.sinks.files import readings_to_wide_csv
from sensorlake.sources.events import readings_raw
from sensorlake.sources.files import load_all, load_csv, load_json
from sensorlake.sources.table import load_mark, load_table, pull_increment, write_table


def _rows(df):
    return sorted(tuple(r) for r in df.select("event_id", "timestamp", "temperature", "humidity").collect())


def test_wide_csv_round_trip(spark, tmp_path):
    raw = readings_raw(spark, SF_SMALL)
    readings_to_wide_csv(raw, str(tmp_path / "csv"))
    back = load_csv(spark, str(tmp_path / "csv"), id_col="event_id")
    assert _rows(back) == _rows(raw)
    assert {r[0] for r in back.select("sensor_id").distinct().collect()} == {"MANUFACTURING_01"}


def test_json_object_or_array(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"sensor_id": "S", "timestamp": "2024-01-01 00:00:00",
                                                 "temperature": 370, "humidity": "55.5"}))
    (tmp_path / "b.json").write_text(json.dumps([{"sensor_id": "S", "timestamp": "bad", "temperature": 1},
                                                 {"sensor_id": "T"}]))
    df = load_json(spark, str(tmp_path), multi_line=True)
    got = sorted((r["sensor_id"], r["temperature"], r["humidity"], r["timestamp"] is None) for r in df.collect())
    assert got == [("S", 1.0, None, True), ("S", 370.0, 55.5, False), ("T", None, None, True)]


def test_table_round_trip_and_incremental_pull(spark, tmp_path):
    raw = readings_raw(spark, SF_SMALL)
    one, two, marks = str(tmp_path / "one"), str(tmp_path / "two"), str(tmp_path / "marks")
    write_table(raw, one)
    assert _rows(load_table(spark, one)) == _rows(raw)

    def ids(tables):
        got = []
        pull_increment(spark, tables, marks, lambda rows: got.extend(r["event_id"] for r in rows.collect()))
        return sorted(got)
    lower = raw.filter("event_id between 1 and 50")
    write_table(lower, two)
    assert len(ids([one, two])) == raw.count() + 50 and ids([one, two]) == []
    # the second table's new ids are below the first one's mark
    write_table(raw.filter("event_id between 51 and 80"), two)
    assert ids([one, two]) == list(range(51, 81))
    # negative ids are read, and a failing consumer loses nothing
    three = str(tmp_path / "three")
    write_table(lower.withColumn("event_id", F.col("event_id") - 100), three)

    def fail(rows):
        raise RuntimeError("sink down")
    with pytest.raises(RuntimeError):
        pull_increment(spark, [three], marks, fail)
    assert load_mark(spark, marks, three) is None and ids([three]) == list(range(-99, -49))


def test_only_a_missing_table_counts_as_empty(spark, tmp_path):
    from sensorlake.session import read_if_exists
    assert read_if_exists(spark, str(tmp_path / "nothing")) is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_if_exists(spark, str(tmp_path / "bad")).count()


def test_published_message_has_explicit_nulls(spark, readings):
    from sensorlake.sinks.files import readings_to_json_value
    got = json.loads(readings_to_json_value(readings([(7, None, None, None, 50.0)])).first()["value"])
    assert got == {"sensor_id": None, "timestamp": None, "temperature": None, "humidity": 50.0, "is_faulty": False,
                   "fault_type": None, "source": "csv", "event_id": 7, "source_id": 7}


def test_union_sources_keeps_every_row(spark, tmp_path):
    raw = readings_raw(spark, SF_SMALL)
    readings_to_wide_csv(raw.filter(F.col("source") == "csv"), str(tmp_path / "csv"))
    db = str(tmp_path / "db")
    write_table(raw.filter(F.col("source") == "database"), db)
    from sensorlake.sinks.files import readings_to_json
    readings_to_json(raw.filter(F.col("source") == "api"), str(tmp_path / "api"))
    u = load_all(load_csv(spark, str(tmp_path / "csv"), id_col="event_id"),
                 load_json(spark, str(tmp_path / "api")), load_table(spark, db))
    assert _rows(u) == _rows(raw)


def test_simulator_csv_stream(spark, tmp_path):
    from sensorlake.streaming.consumer import await_all, csv_file_source, start_parquet
    from sensorlake.operators.validate import with_reasons
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text(
        "sensor_id,timestamp,temperature,humidity,is_faulty,fault_type,source,event_id\n"
        "MANUFACTURING_01,2026-10-06T12:00:00+05:30,372.63,55.1,False,,simulator,1\n"
        "MANUFACTURING_02,,370.0,54.0,True,missing_timestamp,simulator,2\n"
        " ,2026-10-06T12:01:00+05:30,371.0,56.0,True,missing_sensor_id,simulator,3\n")
    out = str(tmp_path / "out")
    await_all([start_parquet(csv_file_source(spark, str(folder)), out, str(tmp_path / "ck"), available_now=True)])
    rows = {r["event_id"]: r for r in with_reasons(spark.read.parquet(out)).collect()}
    assert rows[1]["timestamp"].isoformat().startswith("2026-10-06T06:30:00")     # offset applied, UTC
    assert rows[1]["reasons"] == "" and rows[1]["temperature"] == 372.63
    assert rows[2]["reasons"] == "Timestamp is missing"
    assert rows[2]["is_faulty"] is True and rows[2]["fault_type"] == "missing_timestamp" and rows[1]["is_faulty"] is False
    assert rows[3]["reasons"] == "Sensor ID is missing"
