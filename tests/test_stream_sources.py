"""Streams by id offset and of growing files; the consumer's tables under one
commit record; the progress log; numbers that two writers never share."""
import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from sensorlake.schemas import READING_COLUMNS
from sensorlake.sources.id_stream import IdRange, ReadingTableById
from sensorlake.sources.table import TABLE_SCHEMA, stream_table_by_id, write_table
from sensorlake.sources.tail import ByteRange, TailReader, end_of_lines
from sensorlake.streaming import consumer
from sensorlake.streaming.consumer import await_all, file_source, read_consumer, run_consumer, start_parquet


def _table(spark, first, last):
    return (spark.range(first, last + 1).select(
        F.col("id").alias("event_id"), F.lit("S").alias("sensor_id"), F.timestamp_seconds(F.col("id")).alias("timestamp"),
        (F.lit(350.0) + F.col("id") % 7).alias("temperature"), F.lit(50.0).alias("humidity"), F.lit("database").alias("source")))


def _reader(spark, path, **options):
    from pyspark.sql.types import StructType
    source = ReadingTableById({"path": path, **{k: str(v) for k, v in options.items()}})
    return source.streamReader(StructType.fromDDL(TABLE_SCHEMA))


def _ids(reader, parts):
    return sorted(i for p in parts for batch in reader.read(p) for i in batch.column("id").to_pylist())


def test_id_ranges_come_from_statistics(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.conf.set("parquet.block.size", str(64 << 10))
    try:
        write_table(_table(spark, 1, 30_000), path)
        write_table(_table(spark, 30_001, 40_000), path)
    finally:
        spark.conf.unset("parquet.block.size")
    r = _reader(spark, path, partition_rows=5000)
    assert r.initialOffset() == {"id": -(1 << 63)} and r.latestOffset() == {"id": 40_000}
    parts = r.partitions({"id": 29_990}, {"id": 30_010})
    assert _ids(r, parts) == list(range(29_991, 30_011))
    touched = sum(len(groups) for p in parts for _, groups in p.groups)
    every = r.partitions(r.initialOffset(), r.latestOffset())
    assert touched < sum(len(groups) for p in every for _, groups in p.groups) and len(every) > 4
    assert _ids(r, every) == list(range(1, 40_001))
    # a second plan of the same range, from a new reader, reads the same rows
    again = _reader(spark, path)
    assert _ids(again, again.partitions({"id": 100}, {"id": 250})) == list(range(101, 251))
    assert r.partitions({"id": 40_000}, {"id": 40_000}) == [IdRange([], 40_000, 40_000)]


def test_id_stream_ignores_unfinished_writes(spark, tmp_path):
    path = str(tmp_path / "table")
    assert _reader(spark, path).latestOffset() == {"id": -(1 << 63)}
    write_table(_table(spark, 1, 50), path)
    write_table(_table(spark, 51, 80), str(tmp_path / "other"))
    late = [f for f in os.listdir(tmp_path / "other") if f.endswith(".parquet")][0]
    os.link(tmp_path / "other" / late, tmp_path / "table" / "part-99999-unfinished.parquet")
    os.utime(tmp_path / "table" / "part-99999-unfinished.parquet", (2e9, 2e9))
    r = _reader(spark, path)
    assert r.latestOffset()["id"] == 50
    assert _reader(spark, path, require_mark="false").latestOffset()["id"] > 50
    os.utime(tmp_path / "table" / "_SUCCESS", (2e9 + 1, 2e9 + 1))          # its job ends
    assert r.latestOffset()["id"] > 50


def test_id_stream_restarts_in_the_middle_and_replays_exactly(spark, tmp_path):
    path, out, ck = (str(tmp_path / x) for x in ("table", "out", "ck"))
    write_table(_table(spark, 1, 100), path)

    def run(after=None):
        await_all([start_parquet(stream_table_by_id(spark, path, after=after), out, ck, available_now=True)])
        return sorted(r[0] for r in spark.read.parquet(out).select("event_id").collect())
    assert run(after=10) == list(range(11, 101))
    assert run(after=10) == list(range(11, 101))
    write_table(_table(spark, 101, 160), path)
    # the first batch's commit is lost: it runs again, over its own ids, though more rows are there; the next run has those
    os.remove(f"{ck}/commits/0")
    os.remove(f"{ck}/commits/.0.crc")
    assert run(after=10) == list(range(11, 101))
    assert run(after=10) == list(range(11, 161))
    ranges = [json.loads(open(f"{ck}/offsets/{n}").read().splitlines()[-1])["id"] for n in sorted(os.listdir(f"{ck}/offsets"))
              if n.isdigit()]
    assert ranges == [100, 160]
    # files rewritten into one: nothing comes twice
    whole = spark.read.parquet(path).coalesce(1).collect()
    spark.createDataFrame(whole, TABLE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)
    assert run(after=10) == list(range(11, 161))


# ------------------------------------------------------------ growing files

def _tail(reader, start, end):
    rows = []
    for p in reader.partitions(start, end):
        for b in reader.read(p):
            rows += zip(b.column("file").to_pylist(), b.column("position").to_pylist(), b.column("value").to_pylist())
    return sorted(rows)


@pytest.mark.parametrize("range_bytes", [1, 3, 7, 64, 1 << 20])
def test_growing_files_give_complete_lines_once(tmp_path, range_bytes):
    a, b = tmp_path / "a.csv", tmp_path / "sub" / "b.csv"
    b.parent.mkdir()
    reader = TailReader({"path": str(tmp_path), "ending": ".csv", "range_bytes": str(range_bytes)})
    steps = [("h\nöne\r\ntw", "x"), ("o\n\nthree\nfou", "yz\n" + "long " * 50), ("r\n", "\n"), ("", "last without an end")]
    text = {"a.csv": "", "sub/b.csv": ""}
    at, got = reader.initialOffset(), []
    for one, two in steps:
        text["a.csv"] += one
        text["sub/b.csv"] += two
        a.write_bytes(text["a.csv"].encode())
        b.write_bytes(text["sub/b.csv"].encode())
        (tmp_path / "_hidden.csv").write_text("no\n")
        (tmp_path / "other.txt").write_text("no\n")
        end = reader.latestOffset()
        new = _tail(reader, at, end)
        assert new == _tail(TailReader({"path": str(tmp_path), "ending": ".csv"}), at, end)      # whatever the ranges
        got, at = got + new, end
    want = []
    for name, whole in text.items():
        data, pos = whole.encode(), 0
        while (stop := data.find(b"\n", pos)) >= 0:
            want.append((name, pos, data[pos:stop].decode().removesuffix("\r")))
            pos = stop + 1
    assert sorted(got) == sorted(want) and ("a.csv", 2, "öne") in want
    a.write_text("new\n")                                       # replaced by a shorter file
    assert ("a.csv", 0, "new") in _tail(reader, at, reader.latestOffset())


def test_end_of_lines_looks_back_over_blocks(tmp_path):
    import pyarrow.fs as pafs
    path = tmp_path / "x"
    path.write_bytes(b"a\n" + b"b" * 200_000)
    with pafs.LocalFileSystem().open_input_file(str(path)) as f:
        assert end_of_lines(f, 200_002) == 2 and end_of_lines(f, 1) == 0 and end_of_lines(f, 2) == 2
    assert TailReader({"path": str(tmp_path / "none")}).latestOffset() == {"files": {}}
    assert list(TailReader({"path": str(tmp_path)}).read(ByteRange("", 0, 0, 0))) == []


def test_csv_tail_restarts_inside_a_line(spark, tmp_path):
    folder, out, ck = tmp_path / "csv", str(tmp_path / "out"), str(tmp_path / "ck")
    folder.mkdir()
    header = ",".join(consumer.SIMULATOR_COLUMNS) + "\n"
    line = "MANUFACTURING_0{0},2026-10-06T12:0{0}:00+05:30,37{0}.5,55.1,False,,simulator,{0}\n".format
    text = header + line(1) + line(2) + line(3) + " ,,bad,,,,,\n" + '"q,uoted",2026-10-06 00:00:00,1,2,true,x,y,9\n'
    for cut in (5, len(header) + len(line(1)) + 9, len(text) - 3, len(text)):
        (folder / "a.csv").write_text(text[:cut])
        await_all([start_parquet(consumer.csv_tail_source(spark, str(folder)), out, ck, available_now=True)])
    rows = spark.read.parquet(out).collect()
    assert sorted(str(r.event_id) for r in rows) == ["1", "2", "3", "9", "None"]
    by = {r.event_id: r for r in rows}
    assert by[2].temperature == 372.5 and by[9].sensor_id == "q,uoted" and by[None].sensor_id == " " and by[None].temperature is None


# ------------------------------------------------------------ the consumer

def _messages(folder, n, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"m{n}.json").write_text("".join(json.dumps(dict(zip(
        ("event_id", "sensor_id", "timestamp", "temperature", "humidity", "source"), r))) + "\n" for r in rows))


@pytest.mark.parametrize("broken", ["invalid", "commit"])
def test_consumer_stopped_between_two_tables(spark, tmp_path, monkeypatch, broken):
    """Whatever a failed batch had written, the next run replaces it, and readers
    never see a batch without its commit record."""
    landing, out = tmp_path / "in", str(tmp_path / "out")

    def run():
        await_all([run_consumer(file_source(spark, str(landing)), out, available_now=True, keep_late=True)])

    def row(i, t=370.0):
        return (i, "A", f"2024-01-01T00:{i:02d}:00Z", t, 55.0, "csv")
    _messages(landing, 0, [row(1), row(2), row(3, 999.0)])
    run()
    _messages(landing, 1, [row(2), row(4), row(5, 1.0), row(6)])
    real_replace, real_create = consumer.replace_batch, type(spark).createDataFrame
    if broken == "commit":
        def no_commit(self, data, schema=None, *a, **k):
            if schema == consumer.COMMIT_SCHEMA:
                raise RuntimeError("stopped here")
            return real_create(self, data, schema, *a, **k)
        monkeypatch.setattr(type(spark), "createDataFrame", no_commit)
    else:
        def stop(rows, path):
            if path.endswith(f"/{broken}"):
                raise RuntimeError("stopped here")
            real_replace(rows, path)
        monkeypatch.setattr(consumer, "replace_batch", stop)
    with pytest.raises(Exception, match="stopped here"):
        run()
    monkeypatch.undo()

    def ids(sink):
        return sorted(r.event_id for r in read_consumer(spark, out, sink).collect())
    assert ids("valid") == [1, 2] and ids("invalid") == [3] and read_consumer(spark, out, "raw").count() == 3
    _messages(landing, 2, [row(7), row(4)])
    run()
    assert ids("valid") == [1, 2, 4, 6, 7] and ids("invalid") == [3, 5] and read_consumer(spark, out, "raw").count() == 9
    commits = consumer.consumer_commits(spark, out).orderBy("batch_id").collect()
    assert [(c.rows, c.valid_rows, c.accepted_rows, c.duplicate_rows, c.late_rows) for c in commits] == \
        [(3, 2, 2, 0, 0), (4, 3, 2, 1, 0), (2, 2, 1, 1, 0)]
    assert set(READING_COLUMNS) <= set(read_consumer(spark, out, "valid").columns)


def test_consumer_reads_its_source_once(spark, tmp_path):
    """The source's scan is in one job of the batch: all tables come from the stage."""
    landing, out = tmp_path / "in", str(tmp_path / "out")
    _messages(landing, 0, [(i, "A", f"2024-01-01T00:{i:02d}:00Z", 370.0 if i % 3 else 1.0, 55.0, "csv") for i in range(30)])
    q = run_consumer(file_source(spark, str(landing)), out, available_now=True)
    await_all([q])
    assert sum(p["numInputRows"] for p in q.recentProgress) == 30
    assert read_consumer(spark, out, "late") is None and read_consumer(spark, str(tmp_path / "none"), "valid") is None
    c = consumer.consumer_commits(spark, out).first()
    assert (c.rows, c.valid_rows, c.invalid_rows, c.temperature_out_of_range) == (30, 20, 10, 10)


def test_hot_key_collapses_before_the_shuffle(spark, tmp_path):
    """A key that floods a micro-batch reaches its task as a few rows, and the
    result is that of the plain operator, without delay."""
    rows = [(i, "HOT" if i % 10 else f"S{i}", None if i % 7 == 3 else "2024-01-01T00:00:00Z", 370.0, 55.0, None if i % 2 else "csv")
            for i in range(20_000)]
    frame = spark.createDataFrame(rows, "event_id long, sensor_id string, timestamp string, temperature double, humidity double, source string") \
        .withColumn("timestamp", F.col("timestamp").cast("timestamp")).repartition(4)
    few = consumer.collapse_repeats(frame)
    keys = ["sensor_id", "timestamp", "source"]
    assert few.select(*keys).distinct().count() == frame.select(*keys).distinct().count()
    hot = few.groupBy("sensor_id", "source").count().filter("sensor_id = 'HOT'").collect()
    assert all(r["count"] <= 2 * 4 * 2 for r in hot) and few.columns == frame.columns      # batches x tasks x times
    landing, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    _messages(landing, 0, [(i, "A", "2024-01-01T00:00:00Z", 370.0, 55.0, "csv") for i in range(5000)]
              + [(9000 + i, "A", f"2024-01-01T00:00:{i:02d}Z", 370.0, 55.0, "csv") for i in range(1, 5)])
    valid, _ = consumer.split_stream(consumer.parse_messages(file_source(spark, str(landing))))
    q = start_parquet(consumer.deduplicate(valid.select(*READING_COLUMNS), collapse=True), out, ck, available_now=True)
    await_all([q])
    assert spark.read.parquet(out).count() == 5


def test_kafka_reader_options(spark):
    """Without the connector the reader cannot load, but its options are set first."""
    class Reader:
        def __init__(self):
            self.set = {}

        def format(self, name):
            self.set["format"] = name
            return self

        def option(self, key, value):
            self.set[key] = value
            return self

        def load(self):
            return self.set

    class Session:
        readStream = Reader()
    got = consumer.kafka_source(Session(), "h:9092", starting_offsets="earliest", maxOffsetsPerTrigger=5)
    assert got == {"format": "kafka", "kafka.bootstrap.servers": "h:9092", "subscribe": "raw-sensor-readings",
                   "startingOffsets": "earliest", "maxOffsetsPerTrigger": 5}


# ------------------------------------------------------------ progress, numbers

def test_progress_record_and_reruns(spark, tmp_path):
    from sensorlake.streaming.metrics import progress_record, read_progress, stream_totals
    report = {"id": "q", "runId": "r1", "name": None, "batchId": 0, "timestamp": "2024-01-01T00:00:00.000Z", "numInputRows": 5,
              "durationMs": {"triggerExecution": 12, "addBatch": 7}, "stateOperators": [{"numRowsDroppedByWatermark": 2}],
              "observedMetrics": {"etl_quality": {"rows": 5, "valid_rows": 4, "invalid_rows": 1, "missing_humidity": 1}}}
    runs = [report, {**report, "runId": "r2", "timestamp": "2024-01-01T00:01:00.000Z", "numInputRows": 6},
            {**report, "batchId": 1, "observedMetrics": {}, "stateOperators": []}]
    for i, r in enumerate(runs):
        (tmp_path / f"{i}.json").write_text(json.dumps(progress_record(r)) + "\n")
    rows = read_progress(spark, str(tmp_path)).orderBy("batch_id").collect()
    assert [(r.batch_id, r.run_id, r.input_rows, r.late_rows, r.trigger_ms, r.valid_rows, r.missing_humidity) for r in rows] == \
        [(0, "r2", 6, 2, 12, 4, 1), (1, "r1", 5, 0, 12, 0, 0)]
    total = stream_totals(read_progress(spark, str(tmp_path)), spark.range(1)).first()
    assert (total.valid_rows, total.late_rows, total.accepted_rows, total.duplicate_rows) == (4, 2, 1, 1)
    assert read_progress(spark, str(tmp_path / "none")).count() == 0


def test_two_writers_get_two_versions_and_one_champion(spark, tmp_path):
    from sensorlake.ml.model import train_model
    from sensorlake.ml.registry import Registry
    rows = spark.range(30).select(F.col("id").cast("double").alias("temperature"), (F.col("id") % 5).cast("double").alias("humidity"),
                                  (F.col("id") % 3).cast("double").alias("temperature_change"),
                                  (F.col("id") % 7).cast("double").alias("rolling_avg_temperature"),
                                  (F.col("id") * 2.0).alias("target_temperature"))
    model, root = train_model(rows), str(tmp_path / "registry")
    start, got, failed = threading.Barrier(4), [], []

    def work(i):
        try:
            reg = Registry(spark, root)
            start.wait()
            version = reg.register(model, f"run{i}", {"mae": float(i)})
            reg.set_alias(version)
            got.append(version)
        except Exception as e:  # noqa: BLE001
            failed.append(e)
    threads = [threading.Thread(target=work, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and sorted(got) == [1, 2, 3, 4]
    reg = Registry(spark, root)
    assert sorted((r.version, r.path.rsplit("=", 1)[1]) for r in reg.versions().collect()) == [(i, str(i)) for i in (1, 2, 3, 4)]
    assert reg.aliases().count() == 1 and reg.alias_version() in got
    assert reg.load().transform(rows).count() == 30
    reg.set_alias(2)
    assert reg.alias_version() == 2
