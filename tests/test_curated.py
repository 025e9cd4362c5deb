"""Compaction of the curated layout: file counts, whole rows, readers and writers beside it."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from sensorlake.sinks import curated
from sensorlake.sinks.curated import compact_curated, curated_files, packing_plan, read_curated, vacuum_curated, write_curated


def _rows(start, n, day=1):
    return [(start + i, "ABC"[i % 3], f"2024-01-{day + i % 2:02d} {i // 3600:02d}:{i // 60 % 60:02d}:{i % 60:02d}",
             350.0 + i % 50, 40.0 + i % 30) for i in range(n)]


def _appended(readings, path, parts=4, n=40):
    for p in range(parts):
        write_curated(readings(_rows(1000 * p, n)), path)


def _ids(df):
    return sorted(r["event_id"] for r in df.select("event_id").collect())


def test_small_files_of_a_day_become_one_and_rows_stay(spark, readings, tmp_path):
    path = str(tmp_path / "curated")
    _appended(readings, path)
    before = read_curated(spark, path)
    want, columns, n_files = sorted(map(tuple, before.collect())), before.columns, curated_files(spark, path).count()
    assert n_files >= 8
    done = compact_curated(spark, path)
    after = read_curated(spark, path)
    assert done == {"replaced": n_files, "written": 2} and after.columns == columns
    assert sorted(map(tuple, after.collect())) == want
    files = curated_files(spark, path).collect()
    assert sorted(f["event_date"] for f in files) == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    assert compact_curated(spark, path) == {"replaced": 0, "written": 0}
    # a reader's dates still prune
    assert {r[0] for r in read_curated(spark, path, start=dt.date(2024, 1, 2)).select("event_date").distinct().collect()} == {dt.date(2024, 1, 2)}


def test_readers_and_appends_beside_a_compaction(spark, readings, tmp_path, monkeypatch):
    path = str(tmp_path / "curated")
    _appended(readings, path)
    old = read_curated(spark, path)
    want = _ids(old)
    seen = {}
    publish = curated._publish

    def meanwhile(spark_, path_, record):
        # output written, record not yet: nobody sees it; an append goes on
        seen["unpublished"] = _ids(read_curated(spark, path))
        write_curated(readings(_rows(90_000, 6)), path)
        return publish(spark_, path_, record)

    monkeypatch.setattr(curated, "_publish", meanwhile)
    compact_curated(spark, path)
    monkeypatch.undo()
    assert seen["unpublished"] == want
    assert _ids(old) == want                                         # planned before, read after
    both = sorted(want + list(range(90_000, 90_006)))
    assert _ids(read_curated(spark, path)) == both
    n = vacuum_curated(spark, path)
    assert n == 8 and _ids(read_curated(spark, path)) == both
    assert compact_curated(spark, path)["written"] == 2              # the append's small files, with the others
    assert vacuum_curated(spark, path) == 4 and vacuum_curated(spark, path) == 0
    assert _ids(read_curated(spark, path)) == both == _ids(spark.read.parquet(path))


def test_second_of_two_compactions_fails_and_leaves_nothing(spark, readings, tmp_path, monkeypatch):
    path = str(tmp_path / "curated")
    _appended(readings, path, parts=2)
    want = _ids(read_curated(spark, path))
    publish = curated._publish

    def overtaken(spark_, path_, record):
        monkeypatch.undo()
        assert compact_curated(spark, path)["written"] == 2
        return publish(spark_, path_, record)

    monkeypatch.setattr(curated, "_publish", overtaken)
    with pytest.raises(FileExistsError):
        compact_curated(spark, path)
    assert _ids(read_curated(spark, path)) == want and curated_files(spark, path).count() == 2
    assert sum(p.name.startswith("batch=c") for p in (tmp_path / "curated").iterdir()) == 1


def test_compaction_lost_before_its_record_and_unfinished_append(spark, readings, tmp_path, monkeypatch):
    path = str(tmp_path / "curated")
    _appended(readings, path, parts=2)
    want = _ids(read_curated(spark, path))

    def lost(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(curated, "_publish", lost)
    with pytest.raises(KeyboardInterrupt):
        compact_curated(spark, path)
    monkeypatch.undo()
    # an append whose job never ended has no mark
    write_curated(readings(_rows(50_000, 4)), path)
    mark = next(p for p in (tmp_path / "curated").glob("batch=a*/_SUCCESS")
                if 50_000 in _ids(spark.read.parquet(str(p.parent))))
    mark.unlink()
    assert _ids(read_curated(spark, path)) == want
    assert vacuum_curated(spark, path) == 1                          # the lost output
    assert compact_curated(spark, path)["written"] == 2 and _ids(read_curated(spark, path)) == want


def test_plan_packs_by_size_and_leaves_large_files(spark):
    files = spark.createDataFrame(
        [("a1", dt.date(2024, 1, 1), f"f{i}", 30) for i in range(7)] + [("a2", dt.date(2024, 1, 1), "big", 90)]
        + [("a1", dt.date(2024, 1, 2), "alone", 10)] + [("a1", None, f"n{i}", 5) for i in range(3)],
        "batch string, event_date date, file_name string, file_size long")
    got = packing_plan(files, 100).collect()
    slots = {}
    for r in got:
        slots.setdefault((r["event_date"], r["slot"]), []).append(r["file_size"])
    # 210 bytes of a day into 3 files, three of no day into one, the large one and the single one stay
    assert sorted(map(sum, slots.values())) == [15, 60, 60, 90]
    assert sorted({r["slot"] for r in got}) == [0, 1, 2, 3]
    assert packing_plan(files.limit(0), 100).count() == 0


def test_rows_without_a_time_are_compacted_too(spark, readings, tmp_path):
    path = str(tmp_path / "curated")
    for i in range(3):
        write_curated(readings(_rows(100 * i, 3)).withColumn("timestamp", F.lit(None).cast("timestamp")), path)
    assert compact_curated(spark, path) == {"replaced": 3, "written": 1}
    assert _ids(read_curated(spark, path)) == [0, 1, 2, 100, 101, 102, 200, 201, 202]
    assert vacuum_curated(spark, path) == 3 and len(_ids(read_curated(spark, path))) == 9
