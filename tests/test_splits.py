from pyspark.sql import functions as F

from sensorlake.operators.metrics import drift_report
from sensorlake.operators.splits import label_chrono, label_reference_current


def _sensor(spark, n, sensor="A"):
    return spark.range(1, n + 1).select(
        F.col("id").alias("event_id"), F.lit(sensor).alias("sensor_id"),
        F.timestamp_seconds(F.col("id") * 300).alias("timestamp"),
        F.lit(370.0).alias("temperature"), F.lit(55.0).alias("humidity"),
        F.lit(1.0).alias("temperature_change"), F.lit(370.0).alias("rolling_avg_temperature"),
        F.lit(371.0).alias("target_temperature"))


def test_split_bounds_truncate_double(spark):
    for n, (tr, va) in {10: (7, 8), 90: (62, 76), 170: (118, 144), 1: (0, 0)}.items():
        lab = label_chrono(_sensor(spark, n)).first()
        assert (lab["train_end"], lab["validation_end"]) == (tr, va), n


def test_splits_disjoint_and_complete(spark):
    df = _sensor(spark, 90, "A").unionByName(_sensor(spark, 33, "B"))
    lab = label_chrono(df)
    counts = {(r["sensor_id"], r["split"]): r["c"] for r in
              lab.groupBy("sensor_id", "split").agg(F.count("*").alias("c")).collect()}
    assert counts[("A", "train")] == 62 and counts[("A", "validation")] == 14 and counts[("A", "test")] == 14
    assert sum(v for (s, _), v in counts.items() if s == "B") == 33
    assert lab.select("event_id", "sensor_id").distinct().count() == 123


def test_reference_current_split(spark):
    df = _sensor(spark, 10).drop("temperature_change", "rolling_avg_temperature", "target_temperature")
    lab = label_reference_current(df)
    got = {r["event_id"]: r["slice"] for r in lab.collect()}
    assert [got[i] for i in range(1, 11)] == ["reference"] * 8 + ["current"] * 2


def _drift(spark, ref, cur):
    rows = [("reference", v, 50.0) for v in ref] + [("current", v, 50.0) for v in cur]
    df = spark.createDataFrame(rows, "slice string, temperature double, humidity double")
    return {(r["column_name"], r["statistic"]): r for r in drift_report(df).collect()}


def test_drift_threshold_is_strict(spark):
    r = _drift(spark, [100.0, 100.0], [110.0, 110.0])[("temperature", "mean")]
    assert abs(r["change_percent"] - 10.0) < 1e-9 and r["status"] == "OK"
    r = _drift(spark, [100.0, 100.0], [110.01, 110.01])[("temperature", "mean")]
    assert r["status"] == "DRIFT"
    rep = _drift(spark, [0.0, 0.0], [1.0, 1.0])
    assert rep[("temperature", "mean")]["status"] == "UNKNOWN"
    assert rep[("temperature", "stddev")]["status"] == "UNKNOWN"


def test_filtered_features_are_split_by_what_is_left(spark):
    from pyspark.sql import functions as F
    from sensorlake.operators.faults import reading_grid
    from sensorlake.operators.features import add_features
    from sensorlake.operators.splits import label_chrono
    f = add_features(reading_grid(spark, per_sensor=100), with_seq=True)
    later = f.filter(F.col("seq") > 50)
    def sizes(df):
        return {r["split"]: r["count"] for r in label_chrono(df).groupBy("split").count().collect()}
    assert sizes(later) == sizes(later.drop("seq", "key_rows"))


def test_numbers_of_the_features_give_the_same_splits(spark, readings):
    from sensorlake.operators.features import add_features
    from sensorlake.operators.splits import label_numbered, labelled_features
    # sensors of 1, 12, 13, 14 and 90 readings, ties in time, a null id
    rows = [(1000 * s + i, sid, f"2024-01-01 00:{i // 2:02d}:00", 350.0 + (i * 7) % 11, 50.0)
            for s, (sid, n) in enumerate([("A", 1), ("B", 12), ("C", 13), ("D", 14), ("E", 90), (None, 20), ("", 30)]) for i in range(n)]
    f = add_features(readings(rows), with_seq=True)
    for everywhere in (True, False):
        want = label_chrono(f, drop_null_change_everywhere=everywhere)
        got = label_numbered(f, drop_null_change_everywhere=everywhere)
        assert sorted(got.columns) == sorted(want.columns)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert labelled_features(readings(rows)).count() == label_chrono(f).count() > 0
    assert labelled_features(readings([])).count() == 0


def test_a_reading_without_temperature_is_not_split_silently(spark, readings):
    import pytest
    from sensorlake.operators.splits import labelled_features
    rows = [(i, "A", f"2024-01-01 00:{i:02d}:00", None if i == 20 else 350.0, 50.0) for i in range(40)]
    with pytest.raises(Exception, match="no temperature"):
        labelled_features(readings(rows)).collect()
