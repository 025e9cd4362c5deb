"""Randomised properties: the skew-safe operators equal their plain forms on
inputs built to stress them (ties, same-second peers, tiny chunks)."""
import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plain_forms import features_window
from sensorlake.operators.features import add_features
from sensorlake.operators.splits import label_reference_current
from sensorlake.operators.validate import validate_reading, with_reasons
from sensorlake.schemas import READING

BASE = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)

reading = st.tuples(
    st.sampled_from(["A", "B", "", "C"]),
    st.integers(0, 5400),                      # whole seconds over 90 minutes
    st.sampled_from([0, 250_000, 999_999]),    # sub-second offsets: same-second peers
    st.floats(300, 450, allow_nan=False),
    st.floats(30, 80, allow_nan=False),
)


def _frame(spark, rows):
    data = [(i, s, BASE + dt.timedelta(seconds=sec, microseconds=us), t, h, "csv")
            for i, (s, sec, us, t, h) in enumerate(rows)]
    return spark.createDataFrame(data, READING)


def _pdf(df):
    return df.toPandas().sort_values("event_id").reset_index(drop=True)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(reading, min_size=1, max_size=120), st.sampled_from([13, 20, 37]),
       st.sampled_from([1800, 3600]))
def test_chunked_features_equal_window(spark, rows, chunk_rows, chunk_seconds):
    df = _frame(spark, rows)
    a = _pdf(add_features(df, chunk_rows=chunk_rows, chunk_seconds=chunk_seconds, humidity_trend=True))
    b = _pdf(features_window(df, humidity_trend=True))
    for c in ["temperature_change", "rolling_avg_temperature", "target_temperature", "humidity_trend"]:
        pd.testing.assert_series_equal(a[c], b[c], check_exact=False, rtol=1e-9, atol=1e-9)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(reading, min_size=1, max_size=80))
def test_reference_split_is_prefix_by_time(spark, rows):
    lab = label_reference_current(_frame(spark, rows)).toPandas()
    lab = lab.sort_values(["timestamp", "event_id"]).reset_index(drop=True)
    n = len(rows)
    assert list(lab["row_number"]) == list(range(1, n + 1))
    cut = int(n * 0.80)
    assert list(lab["slice"]) == ["reference"] * cut + ["current"] * (n - cut)


def _py_reasons(s, ts, t, h):
    out = []
    if s is None or s == " ":
        out.append("Sensor ID is missing")
    if ts is None:
        out.append("Timestamp is missing")
    if t is None:
        out.append("Temperature is missing")
    elif t != t or t < 300 or t > 450:
        out.append("Temperature is out of range")
    if h is None:
        out.append("Humidity is missing")
    elif h != h or h < 30 or h > 80:
        out.append("Humidity is out of range")
    return ", ".join(out)


raw_reading = st.tuples(
    st.sampled_from([None, "", " ", "  ", "A"]),
    st.one_of(st.none(), st.just(BASE)),
    st.one_of(st.none(), st.floats(250, 500), st.just(float("nan")), st.sampled_from([300.0, 450.0])),
    st.one_of(st.none(), st.floats(0, 100), st.sampled_from([30.0, 80.0])),
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(raw_reading, min_size=1, max_size=60))
def test_reasons_and_split_match_brute_force(spark, rows):
    df = spark.createDataFrame([(i, s, ts, t, h, "api") for i, (s, ts, t, h) in enumerate(rows)], READING)
    got = {r["event_id"]: r["reasons"] for r in with_reasons(df).collect()}
    want = {i: _py_reasons(*r) for i, r in enumerate(rows)}
    assert got == want
    valid, invalid = validate_reading(df)
    assert {r[0] for r in valid.select("event_id").collect()} == {i for i, w in want.items() if w == ""}
    assert {r[0] for r in invalid.select("event_id").collect()} == {i for i, w in want.items() if w != ""}


def test_empty_input(spark):
    empty = spark.createDataFrame([], READING)
    assert add_features(empty).count() == 0
    assert label_reference_current(empty).count() == 0
    assert add_features(empty, target=False, rolling=False).count() == 0
