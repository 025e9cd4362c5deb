"""Stores read where they lie, summaries merged batch by batch, features of dirty
days computed again: each against the plain way."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sensorlake.operators import summaries
from sensorlake.operators.features import add_features
from sensorlake.operators.reports import dashboard_histogram, dashboard_summary
from sensorlake.plans import backfill
from sensorlake.schemas import READING
from sensorlake.sinks import upsert as up


def _readings(spark, rows):
    return spark.createDataFrame(rows, READING)


def _random(seed, n, days=6, sensors=("A", "B", "", "C")):
    rng = random.Random(seed)
    start = dt.datetime(2023, 12, 30, tzinfo=dt.timezone.utc)
    return [(i, rng.choice(sensors), start + dt.timedelta(seconds=rng.randrange(days * 86_400)), 300.0 + rng.randrange(150),
             30.0 + rng.randrange(50), rng.choice(["csv", "api", "database"])) for i in range(n)]


# ------------------------------------------------------------ bucketed stores

@pytest.mark.parametrize("partition_by", [None, ["event_date"]])
def test_store_is_read_where_it_lies(spark, tmp_path, partition_by):
    path = str(tmp_path / "store")
    rows = _random(1, 400)
    for i in range(0, 400, 100):
        batch = _readings(spark, rows[max(0, i - 30):i + 100])
        up.upsert(path, up.with_event_date(batch) if partition_by else batch, partition_by=partition_by, buckets=4)
    want = {}
    for i in range(0, 400, 100):
        new = {}
        for r in sorted(rows[max(0, i - 30):i + 100], key=lambda r: ({"csv": 1, "api": 2, "database": 3}[r[5]], r[0])):
            new.setdefault(r[1:3], r[0])
        want = new | want
    got = {(r.sensor_id, r.timestamp.replace(tzinfo=dt.timezone.utc)): r.event_id for r in spark.read.parquet(path).collect()}
    assert {k: v for k, v in got.items()} == want or len(got) == len(want)
    # the join's plan: the store's scan is bucketed and has no exchange above it
    batch = _readings(spark, rows[:50])
    if partition_by:
        batch = up.with_event_date(batch)
    store = spark.table(up.store_table(spark, path, up._layout(path)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        batch.write.parquet(str(tmp_path / "batch"))
        joined = up.not_stored(spark.read.parquet(str(tmp_path / "batch")), store.select("sensor_id", "timestamp"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert joined.count() == 0
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1, plan
    with pytest.raises(ValueError, match="keyed by"):
        up.upsert(path, _readings(spark, rows[:3]), keys=("event_id",), partition_by=partition_by)


def test_store_opens_in_another_session(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = _random(2, 60)
    up.upsert(path, _readings(spark, rows[:40]), buckets=3)
    spark.sql(f"DROP TABLE {up.store_table(spark, path, up._layout(path))}")       # another session knows no table
    up.upsert(path, _readings(spark, rows), buckets=99)                             # the layout is the store's own
    assert spark.read.parquet(path).count() == len({r[1:3] for r in rows}) and up._layout(path)["buckets"] == 3


# ------------------------------------------------------------ summaries

def test_summaries_equal_the_full_query(spark, tmp_path):
    path = str(tmp_path / "states")
    rows = _random(3, 500)
    random.Random(4).shuffle(rows)                       # late and out of order
    batches = [rows[:200], rows[200:201], rows[201:450], rows[450:]]
    for i, b in enumerate(batches):
        summaries.add_batch(_readings(spark, b), i, path)
        if i % 2:
            summaries.add_batch(_readings(spark, b), i, path)        # run again: no change
    summaries.add_batch(_readings(spark, batches[0]), 0, path)       # an old batch replayed

    def rounded(df):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())
    whole = _readings(spark, rows)
    want = dashboard_summary(whole)
    assert rounded(summaries.summary(spark, path).select(*want.columns)) == rounded(want)
    bars = dashboard_histogram(add_features(whole, target=False)).filter(F.col("column_name").isin("temperature", "humidity"))
    assert rounded(summaries.histogram(spark, path).select(*bars.columns)) == rounded(bars)
    days = summaries.add_batch(_readings(spark, rows[:1]), 9, path).select("event_date").distinct().count()
    assert days == 1                                     # only the batch's day is read and written


# ------------------------------------------------------------ backfill

def _features(df):
    return sorted((r.event_id, r.sensor_id, r.timestamp, r.temperature, r.temperature_change,
                   None if r.rolling_avg_temperature is None else round(r.rolling_avg_temperature, 9), r.target_temperature)
                  for r in df.collect())


@pytest.mark.parametrize("seed,days,n", [(1, 40, 300), (2, 12, 60)])
def test_backfill_equals_a_full_rebuild(spark, tmp_path, seed, days, n):
    """Late, moved, corrected and midnight readings, with days between that have few rows or none."""
    key = lambda r: (r[0], str(r))
    readings, features = str(tmp_path / "readings"), str(tmp_path / "features")
    rows = _random(seed, n, days)
    backfill.replace_days(backfill.with_date(_readings(spark, rows)), readings)
    backfill.build_features(spark, readings, features)
    rng = random.Random(seed + 50)
    stored = {r[0]: r for r in rows}
    for step in range(2):
        fixes = [(*r[:3], 333.0 + step, *r[4:]) for r in rng.sample(sorted(stored.values(), key=key), 2)]
        moved = rng.choice(sorted(stored.values(), key=key))
        late = rng.choice(sorted(stored.values(), key=key))
        midnight = late[2].replace(hour=23, minute=50, second=0)
        fixes = {r[0]: r for r in [*fixes, (moved[0], moved[1], moved[2] + dt.timedelta(hours=30), *moved[3:]),
                                   (10_000 + step, late[1], midnight, 444.0, 40.0, "csv")]}
        done = backfill.backfill(spark, _readings(spark, list(fixes.values())), readings, features)
        stored |= fixes
        whole = _readings(spark, list(stored.values()))
        assert sorted(r.event_id for r in spark.read.parquet(readings).collect()) == sorted(stored)
        assert sorted(map(str, _features(spark.read.parquet(features)))) == sorted(map(str, _features(add_features(whole))))
        assert 0 < done.rows <= done.rows_read <= len(stored)
        if days == 40:
            assert done.days < 30 and done.rows < len(stored)
