"""Adapter from the driver's ``events`` table to readings.

``events(event_id, ts, user_id, event_type, value, props)`` is the only input
table shaped like sensor readings. Users fold onto three sensors, and a fixed
share of rows gets a missing or blank field, so that validation, features and
splits see the same kinds of faults as live sensor data. Every row of the
table is kept; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import READING_COLUMNS

# --- fixed values: fault pattern of the adapter (event_id divisors) -------
NULL_SENSOR_EVERY = 101
BLANK_SENSOR_EVERY = 103
EMPTY_SENSOR_EVERY = 107
NULL_TIMESTAMP_EVERY = 109
NULL_TEMPERATURE_EVERY = 113
NULL_HUMIDITY_EVERY = 127
SENSOR_FOLD = 3
SENSOR_PREFIX = "MANUFACTURING_0"
TEMPERATURE_OFFSET = 298.0
HUMIDITY_OFFSET = 28.0
HUMIDITY_SCALE = 0.55
SOURCE_BY_REMAINDER = ("csv", "database", "api")   # event_id % 3 = 0, 1, 2
DUPLICATE_EVERY = 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(n: int) -> Column:
    return (F.col("event_id") % F.lit(n)) == 0


def readings_from_events(events: DataFrame) -> DataFrame:
    """events -> READING rows (one per event)."""
    sensor = (
        F.when(_every(NULL_SENSOR_EVERY), F.lit(None).cast("string"))
        .when(_every(BLANK_SENSOR_EVERY), F.lit(" "))
        .when(_every(EMPTY_SENSOR_EVERY), F.lit(""))
        .otherwise(F.concat(F.lit(SENSOR_PREFIX),
                            (F.col("user_id") % SENSOR_FOLD + 1).cast("string")))
    )
    ts = F.when(_every(NULL_TIMESTAMP_EVERY), F.lit(None)) \
        .otherwise(F.col("ts").cast("timestamp"))
    temperature = F.when(_every(NULL_TEMPERATURE_EVERY), F.lit(None)) \
        .otherwise(F.lit(TEMPERATURE_OFFSET) + F.col("value"))
    k = F.get_json_object(F.col("props"), "$.k").try_cast("double")
    humidity = F.when(_every(NULL_HUMIDITY_EVERY), F.lit(None)) \
        .otherwise(F.lit(HUMIDITY_OFFSET) + F.lit(HUMIDITY_SCALE) * k)
    source = F.element_at(F.array(*[F.lit(s) for s in SOURCE_BY_REMAINDER]),
                          (F.col("event_id") % 3 + 1).cast("int"))
    return events.select(
        F.col("event_id").cast("long").alias("event_id"),
        sensor.alias("sensor_id"),
        ts.cast("timestamp").alias("timestamp"),
        temperature.cast("double").alias("temperature"),
        humidity.cast("double").alias("humidity"),
        source.alias("source"),
    ).select(*READING_COLUMNS)


def readings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from_events(read_table(spark, sf_dir, "events"))


def repeated(raw: DataFrame) -> DataFrame:
    """The readings that are sent twice."""
    return raw.filter(_every(DUPLICATE_EVERY))


def readings_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """readings_raw plus exact copies of every 20th event, so that duplicate
    keys exist and any first-wins rule has one right answer. Every event is
    kept; the rule only chooses which events are sent twice."""
    raw = readings_raw(spark, sf_dir)
    return raw.unionByName(repeated(raw))
