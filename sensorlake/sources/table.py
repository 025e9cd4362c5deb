"""Reading tables on shared storage (S3) and their incremental pull.

A table is a Parquet folder (or, through ``jdbc_table``, a database that the
cluster reaches) with ``id, sensor_id, timestamp, temperature, humidity`` and
optionally ``is_faulty, fault_type, source``. Only Spark opens files: id bounds are
filters that Parquet pushes down, and new rows of a stream come from the file
source. Each table has a high-water mark of its own, stored only after the
caller has used the rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import READING_COLUMNS
from ..session import read_if_exists
from .files import reading_columns
from .id_stream import ReadingTableById

TABLE_SCHEMA = ("id long, sensor_id string, timestamp string, temperature double, humidity double, "
                "is_faulty boolean, fault_type string, source string")
TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
EXTRA = ["is_faulty", "fault_type"]


def jdbc_table(spark: SparkSession, url: str, table: str, *, lower: int, upper: int, partitions: int,
               properties: dict[str, str] | None = None) -> DataFrame:
    """A database's reading table, read in id ranges by the executors."""
    return spark.read.jdbc(url, table, column="id", lowerBound=lower, upperBound=upper, numPartitions=partitions,
                           properties=properties or {})


def read_rows(spark: SparkSession, path: str, *, after_id: int | None = None, until_id: int | None = None) -> DataFrame:
    """Rows with ``after_id`` < id <= ``until_id`` (None: no bound)."""
    rows = spark.read.schema(TABLE_SCHEMA).parquet(path)
    if after_id is not None:
        rows = rows.filter(F.col("id") > after_id)
    return rows if until_id is None else rows.filter(F.col("id") <= until_id)


def to_readings(rows: DataFrame, source: str | None = "database", *, extra: bool = False) -> DataFrame:
    """READING columns; ``source=None`` keeps the table's own, ``extra`` also
    its fault columns."""
    kind = F.col("source") if source is None else F.lit(source)
    cols = reading_columns(F.col("sensor_id"), F.col("timestamp"), F.col("temperature"), F.col("humidity"), kind, F.col("id"))
    return rows.select(*cols, *(EXTRA if extra else [])).select(*READING_COLUMNS, *(EXTRA if extra else []))


def load_table(spark: SparkSession, path: str) -> DataFrame:
    """S3: every row of the table, as READING with ``event_id`` = the table id."""
    return to_readings(read_rows(spark, path))


def stream_table(spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None) -> DataFrame:
    """S10 as a stream: rows of the files that are new since the checkpoint."""
    r = spark.readStream.schema(TABLE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return to_readings(r.parquet(path), None, extra=True)


def stream_table_by_id(spark: SparkSession, path: str, *, after: int | None = None) -> DataFrame:
    """S10 as a stream of ids: rows above the offset (at first above ``after``; None:
    all), whichever files hold them."""
    spark.dataSource.register(ReadingTableById)
    r = spark.readStream.format(ReadingTableById.name()).option("path", path)
    return to_readings((r if after is None else r.option("after", after)).load(), None, extra=True)


def write_table(readings: DataFrame, path: str, mode: str = "append") -> None:
    """Readings as a reading table, in order of id inside each file (so that
    an id bound skips files and row groups)."""
    has = set(readings.columns)
    (readings.select(F.col("event_id").alias("id"), "sensor_id", F.date_format("timestamp", TIME_TEXT).alias("timestamp"),
                     "temperature", "humidity",
                     (F.col("is_faulty") if "is_faulty" in has else F.lit(False)).alias("is_faulty"),
                     (F.col("fault_type") if "fault_type" in has else F.lit(None).cast("string")).alias("fault_type"), "source")
     .repartitionByRange("id").sortWithinPartitions("id").write.mode(mode).parquet(path))


def load_mark(spark: SparkSession, marks: str, table: str) -> int | None:
    """The table's stored high-water mark (the latest record wins)."""
    seen = read_if_exists(spark, marks, "name string, high_water_mark long, saved_at timestamp")
    if seen is None:
        return None
    return seen.filter(F.col("name") == table).agg(F.max_by("high_water_mark", "saved_at")).first()[0]


def save_mark(spark: SparkSession, marks: str, table: str, mark: int) -> None:
    (spark.createDataFrame([(table, int(mark))], "name string, high_water_mark long")
     .withColumn("saved_at", F.current_timestamp()).write.mode("append").parquet(marks))


def pull_increment(spark: SparkSession, tables: list[str], marks: str, use: Callable[[DataFrame], None]) -> int:
    """For each table ``use`` gets the rows above its own mark, up to its
    highest id now; the mark is stored after ``use`` returned, so a failure
    repeats the rows instead of losing them. Returns the number of tables with new rows."""
    pulled = 0
    for table in tables:
        mark = load_mark(spark, marks, table)
        latest = read_rows(spark, table, after_id=mark).agg(F.max("id")).first()[0]
        if latest is not None:
            use(to_readings(read_rows(spark, table, after_id=mark, until_id=latest), None, extra=True))
            save_mark(spark, marks, table, latest)
            pulled += 1
    return pulled
