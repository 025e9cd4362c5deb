"""File sources: the wide process CSV (S1) and JSON reading objects.

Both are read with an explicit schema (no inference pass, and one bad value
cannot change a column's type) and every field is converted with try_cast,
so malformed text becomes NULL and is rejected by validation with a reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import config as C
from ..schemas import READING_COLUMNS, WIDE_CSV_COLUMNS


def _text_schema(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


def reading_columns(sensor_id, timestamp, temperature, humidity, source, event_id=None) -> list:
    """Typed READING projection from text (or typed) columns."""
    return [
        (event_id.try_cast("long") if event_id is not None else F.lit(None).cast("long")).alias("event_id"),
        sensor_id.cast("string").alias("sensor_id"),
        timestamp.cast("string").try_cast("timestamp").alias("timestamp"),
        temperature.try_cast("double").alias("temperature"),
        humidity.try_cast("double").alias("humidity"),
        source.alias("source"),
    ]


def load_csv(spark: SparkSession, path: str, *, id_col: str | None = None,
             sensor_id: str = C.CSV_SENSOR_ID, source: str = "csv") -> DataFrame:
    """Wide process CSV with a header -> READING. The file carries no sensor
    column: every row gets the constant ``sensor_id``. ``id_col`` names an
    optional extra column holding a row id (the tiebreak for equal times)."""
    names = list(WIDE_CSV_COLUMNS) + ([id_col] if id_col else [])
    df = (spark.read.schema(_text_schema(names)).option("header", True)
          .option("enforceSchema", False).option("mode", "PERMISSIVE").csv(path))
    return df.select(*reading_columns(
        F.lit(sensor_id), F.col(f"`{C.CSV_TIMESTAMP_COLUMN}`"), F.col(f"`{C.CSV_TEMPERATURE_COLUMN}`"),
        F.col(f"`{C.CSV_HUMIDITY_COLUMN}`"), F.lit(source), F.col(id_col) if id_col else None,
    )).select(*READING_COLUMNS)


JSON_FIELDS = ["sensor_id", "timestamp", "temperature", "humidity", "is_faulty", "fault_type", "source",
               "event_id"]


def load_json(spark: SparkSession, path: str, *, multi_line: bool = False, source: str = "api") -> DataFrame:
    """Reading objects -> READING. JSON Lines by default (splittable); with
    ``multi_line`` a file may hold one object or an array of them, as an
    HTTP endpoint returns (each such file is read by one task). Missing keys
    become NULL; numbers may be quoted."""
    df = spark.read.schema(_text_schema(JSON_FIELDS)).option("multiLine", multi_line) \
        .option("mode", "PERMISSIVE").json(path)
    return df.select(*reading_columns(
        F.col("sensor_id"), F.col("timestamp"), F.col("temperature"), F.col("humidity"),
        F.lit(source) if source is not None else F.col("source"),
        F.col("event_id"),
    )).select(*READING_COLUMNS)


def load_all(csv_df: DataFrame, json_df: DataFrame, table_df: DataFrame) -> DataFrame:
    """Union by name in loader order (csv, api, database); no dedup."""
    return csv_df.unionByName(json_df).unionByName(table_df)
