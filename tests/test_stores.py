from sensorlake.sinks.upsert import first_wins, upsert, with_event_date

T = "2024-01-01 00:00:00"


def test_first_wins_by_source_then_id(readings):
    batch = readings([(5, "A", T, 371.0, 50.0, "database"), (9, "A", T, 372.0, 50.0, "api"),
                      (7, "A", T, 373.0, 50.0, "api"), (3, "B", T, 374.0, 50.0, "database"),
                      (8, "A", T, 375.0, 50.0, "other")])
    got = {r["sensor_id"]: (r["event_id"], r["source"]) for r in first_wins(batch).collect()}
    assert got == {"A": (7, "api"), "B": (3, "database")}


def test_stored_row_wins_and_rerun_is_idempotent(spark, readings, tmp_path):
    path = str(tmp_path / "store")
    upsert(path, readings([(1, "A", T, 370.0, 50.0, "database")]))
    upsert(path, readings([(2, "A", T, 999.0, 50.0, "csv"), (3, "A", "2024-01-01 00:05:00", 371.0, 50.0, "csv")]))
    upsert(path, readings([(2, "A", T, 999.0, 50.0, "csv"), (3, "A", "2024-01-01 00:05:00", 371.0, 50.0, "csv")]))
    rows = sorted((r["event_id"], r["temperature"]) for r in spark.read.parquet(path).collect())
    assert rows == [(1, 370.0), (3, 371.0)]


def test_partitioned_store_prunes_but_keeps_keys(spark, readings, tmp_path):
    path = str(tmp_path / "store")
    day1 = [(i, "A", f"2024-01-01 0{i}:00:00", 370.0 + i, 50.0) for i in range(1, 4)]
    day2 = [(10 + i, "A", f"2024-01-02 0{i}:00:00", 380.0 + i, 50.0) for i in range(1, 4)]
    upsert(path, with_event_date(readings(day1)), partition_by=["event_date"])
    # the second batch repeats one day-1 key and adds day 2
    upsert(path, with_event_date(readings([day1[2]] + day2)), partition_by=["event_date"])
    store = spark.read.parquet(path)
    assert store.count() == 6
    assert sorted(r[0] for r in store.select("event_date").distinct().collect())[0].isoformat() == "2024-01-01"
