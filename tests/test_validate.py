import math

from pyspark.sql import functions as F

from sensorlake.operators.validate import dq_summary, validate_reading, with_reasons

OK = ("A", "2024-01-01 00:00:00", 370.0, 55.0)


def _reasons(readings, rows, blank="exact_space"):
    df = readings([(i, *r) for i, r in enumerate(rows)])
    return [r["reasons"] for r in with_reasons(df, blank).orderBy("event_id").collect()]


def test_bounds_are_inclusive(readings):
    rows = [("A", OK[1], 300.0, 55.0), ("A", OK[1], 450.0, 55.0), ("A", OK[1], 370.0, 30.0),
            ("A", OK[1], 370.0, 80.0)]
    assert _reasons(readings, rows) == ["", "", "", ""]


def test_out_of_range_and_nan(readings):
    rows = [("A", OK[1], 299.99, 55.0), ("A", OK[1], 450.01, 55.0), ("A", OK[1], math.nan, 55.0),
            ("A", OK[1], 370.0, 29.99), ("A", OK[1], 370.0, 80.01)]
    assert _reasons(readings, rows) == ["Temperature is out of range"] * 3 + ["Humidity is out of range"] * 2


def test_blank_sensor_ids(readings):
    rows = [(None, OK[1], 370.0, 55.0), (" ", OK[1], 370.0, 55.0), ("", OK[1], 370.0, 55.0),
            ("  ", OK[1], 370.0, 55.0)]
    assert _reasons(readings, rows) == ["Sensor ID is missing", "Sensor ID is missing", "", ""]
    assert _reasons(readings, rows, "trim") == ["Sensor ID is missing"] * 4


def test_reason_order_and_join(readings):
    rows = [(None, None, None, None), ("A", OK[1], 500.0, 10.0)]
    assert _reasons(readings, rows) == [
        "Sensor ID is missing, Timestamp is missing, Temperature is missing, Humidity is missing",
        "Temperature is out of range, Humidity is out of range"]


def test_valid_invalid_partition_input(spark):
    from sensorlake.sources.events import readings_raw
    from conftest import SF_SMALL
    raw = readings_raw(spark, SF_SMALL)
    valid, invalid = validate_reading(raw)
    ids_v = {r[0] for r in valid.select("event_id").collect()}
    ids_i = {r[0] for r in invalid.select("event_id").collect()}
    ids = {r[0] for r in raw.select("event_id").collect()}
    assert ids_v.isdisjoint(ids_i) and ids_v | ids_i == ids
    assert set(valid.columns) == set(raw.columns) and "reasons" in invalid.columns
    s = dq_summary(raw).first()
    assert s["valid_rows"] == len(ids_v) and s["invalid_rows"] == len(ids_i)
    assert invalid.filter(F.col("reasons") == "").count() == 0
