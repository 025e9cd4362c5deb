"""Curated (silver) layout of valid readings (B2).

``<path>/batch=<id>/event_date=<day>/*.parquet``: every write is a batch folder of its
own, partitioned by ``event_date`` so that time-bounded reads (drift slices, dashboards)
prune whole folders. The sensor id stays a column rather than a folder level: a
partition folder cannot hold '' (it would read back as NULL), and '' is a distinct,
valid sensor id here. Rows are range-partitioned on (date, sensor, time) before the
write, so a hot day is spread over several tasks (no task holds a whole date), and
each file covers a narrow (sensor, time) range: tight Parquet min/max statistics.

What a reader sees is settled by partition values alone: appended batches that are
complete (Spark's ``_SUCCESS``), compacted batches named by the newest record of
``_compactions``, without the days that this record calls replaced. Both are partition
columns, so the choice is partition pruning and costs no data.

``compact_curated`` packs the small files of each day by size into files of about
``target_bytes``. Its output is a batch that nobody sees until its record is published:
a file whose name is the next number, put there whole and only if absent. So readers see
all of a compaction or nothing of it, frames planned before it keep their files, appends
go on meanwhile, and of two compactions at once one fails and leaves nothing.
``vacuum_curated`` then deletes what was replaced, once no older reader is left.

Readers go through ``read_curated``: between a compaction and its vacuum the folder
holds replaced days twice.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyarrow.fs import FileSelector, FileType
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import delete_path, durable, publish
from ..sources.folder import open_folder

TARGET_BYTES = 256 << 20
_RECORDS = "_compactions"
_NO_RECORD = {"number": 0, "batches": [], "replaced": []}
_APPENDED, _COMPACTED = "a", "c"


def write_curated(valid: DataFrame, path: str, mode: str = "append") -> None:
    """Adds a batch; ``overwrite`` starts the table anew."""
    if mode == "overwrite":
        delete_path(valid.sparkSession, path)
    elif mode != "append":
        raise ValueError(f"mode is append or overwrite, not {mode}")
    (valid.withColumn("event_date", F.to_date("timestamp"))
     .repartitionByRange("event_date", "sensor_id", "timestamp")
     .sortWithinPartitions("event_date", "sensor_id", "timestamp")
     .write.partitionBy("event_date").parquet(f"{path}/batch={_APPENDED}{uuid.uuid4().hex}"))


def read_curated(spark: SparkSession, path: str, start: _dt.date | None = None,
                 end: _dt.date | None = None) -> DataFrame:
    """Rows with event_date in [start, end] (either bound optional); the
    filter prunes partitions."""
    live = _visible(path)           # before the listing
    df = _dated(spark.read.parquet(path)).filter(live)
    if start is not None:
        df = df.filter(F.col("event_date") >= F.lit(start))
    if end is not None:
        df = df.filter(F.col("event_date") <= F.lit(end))
    return df.drop("batch")


def _unit() -> Column:
    """A batch's folder of one day, as records name it."""
    return F.concat_ws("/", "batch", F.coalesce(F.col("event_date").cast("string"), F.lit("null")))


def _record(path: str) -> dict:
    """The newest record: number, compacted batches, replaced units."""
    files, root = open_folder(path)
    found = [f.path for f in files.get_file_info(FileSelector(f"{root}/{_RECORDS}", allow_not_found=True))
             if f.base_name.endswith(".json")]
    if not found:
        return dict(_NO_RECORD)
    with files.open_input_stream(max(found)) as f:       # numbers have leading zeros
        return json.loads(f.read())


def _batches(path: str) -> dict[str, bool]:
    """Batch folders and whether their write is complete."""
    files, root = open_folder(path)
    names = [f.base_name.split("=", 1)[1] for f in files.get_file_info(FileSelector(root, allow_not_found=True))
             if f.type == FileType.Directory and f.base_name.startswith("batch=")]
    done = files.get_file_info([f"{root}/batch={n}/_SUCCESS" for n in names]) if names else []
    return {n: d.type == FileType.File for n, d in zip(names, done)}


def _dated(files: DataFrame) -> DataFrame:
    """Without any day the listing gives the column no type."""
    return files.withColumn("event_date", F.col("event_date").cast("date"))


def _visible(path: str) -> Column:
    """What the newest record and the complete appends show. Settled before the
    files are listed: what is named here is complete then, so the listing has it."""
    record = _record(path)
    seen = [n for n, done in _batches(path).items() if done and n.startswith(_APPENDED)] + record["batches"]
    live = F.col("batch").isin(seen)
    return live & ~_unit().isin(record["replaced"]) if record["replaced"] else live


def curated_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per visible file: ``batch``, ``event_date``, ``file_name``,
    ``file_size``. A listing: no file's content is read."""
    live = _visible(path)
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
              .select("batch", "event_date", "_metadata.file_name", "_metadata.file_size"))
    return _dated(listed).filter(live)


def packing_plan(files: DataFrame, target_bytes: int) -> DataFrame:
    """Output file of each small file: ``slot`` from 0 over all days, for the days
    that get fewer files. A batch's day with files of half the target or more on
    average stays as it is, so data are not rewritten time and again. A day's files
    go, in their order, into ceil(bytes / target) output files of equal shares."""
    unit, day = Window.partitionBy("batch", "event_date"), Window.partitionBy("event_date")
    small = files.withColumn("_mean", F.avg("file_size").over(unit)).filter(F.col("_mean") < target_bytes / 2)
    small = (small.withColumns({"_bytes": F.sum("file_size").over(day), "_files": F.count(F.lit(1)).over(day)})
             .withColumn("_into", F.ceil(F.col("_bytes") / F.lit(target_bytes)))
             .filter(F.col("_files") > F.col("_into")))
    # a file belongs where its middle lies
    ordered = day.orderBy("batch", "file_name").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.sum("file_size").over(ordered) - F.col("file_size") / 2
    at = F.least(F.floor(middle * F.col("_into") / F.col("_bytes")), F.col("_into") - 1).cast("long")
    placed = small.withColumn("_at", at)
    # over one row per day
    days = placed.groupBy("event_date").agg(F.max("_into").alias("_n"))
    before = Window.orderBy("event_date").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select(F.col("event_date").alias("_day"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return (placed.join(days, F.col("event_date").eqNullSafe(F.col("_day")))
            .select("batch", "event_date", "file_name", "file_size", (F.col("_base") + F.col("_at")).cast("int").alias("slot")))


def compact_curated(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES) -> dict[str, int]:
    """Packs small files; returns the numbers of files ``replaced`` and ``written``
    (0 and 0: nothing to do). Raises FileExistsError if another compaction was
    published meanwhile; the table is then as that one left it."""
    record = _record(path)
    plan = durable(packing_plan(curated_files(spark, path), target_bytes), "packing-plan")
    replaced, last = plan.agg(F.count(F.lit(1)), F.max("slot")).first()
    if not replaced:
        return {"replaced": 0, "written": 0}
    units = [r[0] for r in plan.select(_unit().alias("unit")).distinct().collect()]     # folders of the listing
    batch = f"{_COMPACTED}{uuid.uuid4().hex}"
    rows = spark.read.parquet(path).withColumn("_file", F.col("_metadata.file_name"))
    columns = [c for c in rows.columns if c not in ("batch", "event_date", "_file")]
    rows = (_dated(rows).filter(_unit().isin(units))
            .select(*columns, "event_date", F.col("batch").alias("_batch"), "_file"))
    # part names are unique in a folder, and a folder's rows have its batch and day
    slots = plan.select(F.col("batch").alias("_p_batch"), F.col("event_date").alias("_p_day"), F.col("file_name").alias("_p_file"), "slot")
    placed = rows.join(slots, (F.col("_batch") == F.col("_p_batch")) & F.col("event_date").eqNullSafe(F.col("_p_day"))
                       & (F.col("_file") == F.col("_p_file")))
    written = f"{path}/batch={batch}"
    (placed.select(*columns, "event_date", "slot").repartitionById(last + 1, F.col("slot"))
     .sortWithinPartitions("event_date", "sensor_id", "timestamp").drop("slot")
     .write.partitionBy("event_date").parquet(written))
    new = {"number": record["number"] + 1, "batches": [*record["batches"], batch], "replaced": [*record["replaced"], *units]}
    if not _publish(spark, path, new):
        delete_path(spark, written)
        raise FileExistsError(f"another compaction of {path} came first")
    return {"replaced": replaced, "written": last + 1}


def _publish(spark: SparkSession, path: str, record: dict) -> bool:
    return publish(spark, f"{path}/{_RECORDS}/{record['number']:012d}.json", json.dumps(record).encode())


def vacuum_curated(spark: SparkSession, path: str) -> int:
    """Deletes the replaced folders and outputs of compactions that were never
    published; returns how many. Only when no compaction runs and no reader
    planned before the last one is left."""
    record = _record(path)
    doomed = [f"{path}/batch={batch}/event_date={'__HIVE_DEFAULT_PARTITION__' if day == 'null' else day}"
              for batch, day in (unit.split("/") for unit in record["replaced"])]
    doomed += [f"{path}/batch={n}" for n in _batches(path) if n.startswith(_COMPACTED) and n not in record["batches"]]
    for folder in doomed:
        delete_path(spark, folder)
    # afterwards: a record without the units must not show a folder that is still there
    if record["replaced"] and not _publish(spark, path, {**record, "number": record["number"] + 1, "replaced": []}):
        raise FileExistsError(f"a compaction of {path} came in between")
    return len(doomed)
