import random

import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sensorlake.operators.features import add_features
from plain_forms import features_window, row_number_window
from sensorlake.operators.sequence import sequence_index
from sensorlake.operators.validate import validate_reading
from sensorlake.sources.events import readings_raw


def test_rolling_window_fixture(readings):
    # 1800 s inclusive, whole-second peers; 01:01 sees only itself
    rows = [(1, "A", "2024-01-01 00:00:00", 1.0, 50.0), (2, "A", "2024-01-01 00:10:00", 2.0, 50.0),
            (3, "A", "2024-01-01 00:30:00", 3.0, 50.0), (4, "A", "2024-01-01 00:30:00.900000", 4.0, 50.0),
            (5, "A", "2024-01-01 01:01:00", 5.0, 50.0)]
    for out in (add_features(readings(rows), chunk_rows=13, chunk_seconds=1800), features_window(readings(rows))):
        got = [r["rolling_avg_temperature"] for r in out.orderBy("event_id").collect()]
        assert got == [1.0, 1.5, 2.5, 2.5, 5.0]


def test_target_is_twelve_rows_ahead(readings):
    base = "2024-01-01 00:{:02d}:00"
    thirteen = [(i, "A", base.format(i), float(i), 50.0) for i in range(13)]
    out = add_features(readings(thirteen), chunk_rows=13).orderBy("event_id").collect()
    assert [r["target_temperature"] for r in out] == [12.0] + [None] * 12
    twelve = add_features(readings(thirteen[:12]), chunk_rows=13)
    assert twelve.filter(F.col("target_temperature").isNotNull()).count() == 0
    assert out[0]["temperature_change"] is None and out[5]["temperature_change"] == 1.0


def _compare(a, b, cols):
    pa = a.toPandas().sort_values("event_id").reset_index(drop=True)
    pb = b.toPandas().sort_values("event_id").reset_index(drop=True)
    for c in cols:
        pd.testing.assert_series_equal(pa[c], pb[c], check_exact=False, rtol=1e-12)


def test_chunked_equals_window_on_events(spark):
    valid = validate_reading(readings_raw(spark, SF_SMALL))[0]
    cols = ["temperature_change", "rolling_avg_temperature", "target_temperature", "humidity_trend"]
    plain = features_window(valid, humidity_trend=True)
    for chunk_rows, chunk_seconds in ((13, 1800), (50, 7200), (1 << 20, 86400)):
        chunked = add_features(valid, chunk_rows=chunk_rows, chunk_seconds=chunk_seconds, humidity_trend=True)
        _compare(chunked, plain, cols)


def test_sequence_index_equals_row_number(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["a", "b", "c", None]), rnd.randint(0, 40)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, k string, t long")
    for keys in (["k"], []):
        a = sequence_index(df, keys, ["t", "id"], count_col="n", partitions=7)
        b = row_number_window(df, keys, ["t", "id"])
        got = {r["id"]: r["seq"] for r in a.collect()}
        want = {r["id"]: r["seq"] for r in b.collect()}
        assert got == want
        counts = {r["id"]: r["n"] for r in a.collect()}
        sizes = {r["k"]: r["c"] for r in df.groupBy("k").agg(F.count("*").alias("c")).collect()}
        for rid, k, _ in rows[:50]:
            assert counts[rid] == (sizes[k] if keys else len(rows))


def test_hot_sensor_is_split_across_tasks(spark):
    # one sensor holding every row still lands in many range partitions of the stage table
    import glob
    import os
    from sensorlake.session import work_dir
    df = spark.range(0, 20000).select(F.col("id").alias("event_id"), F.lit("HOT").alias("sensor_id"),
                                      F.timestamp_seconds(F.col("id") * 60).alias("timestamp"))
    before = set(glob.glob(f"{work_dir(spark)}/sequence-*"))
    laid = sequence_index(df, ["sensor_id"], ["timestamp", "event_id"], partitions=8)
    assert laid.agg(F.max("seq")).first()[0] == 20000
    (stage,) = set(glob.glob(f"{work_dir(spark)}/sequence-*")) - before
    parts = spark.read.parquet(stage).groupBy("_part").count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) <= 20000 * 0.25
    assert os.path.isdir(stage)


def test_rolling_across_day_chunks_before_1970(readings):
    # rows either side of a day boundary (and of the epoch) see each other within 30 minutes
    rows = [(1, "A", "1969-12-31 23:50:00", 1.0, 50.0), (2, "A", "1970-01-01 00:10:00", 3.0, 50.0),
            (3, "A", "1969-12-30 23:59:00", 5.0, 50.0), (4, "A", "1969-12-31 00:01:00", 7.0, 50.0)]
    got = {r["event_id"]: r["rolling_avg_temperature"]
           for r in add_features(readings(rows), chunk_rows=13, chunk_seconds=3600).collect()}
    want = {r["event_id"]: r["rolling_avg_temperature"] for r in features_window(readings(rows)).collect()}
    assert got == want == {1: 1.0, 2: 2.0, 3: 5.0, 4: 6.0}
