"""File sinks: rejects (K1), predictions (K4), wide CSV and JSON exports.

All writes are distributed (one file per task) with ``mode`` semantics of the
DataFrame writer; nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import WIDE_CSV_COLUMNS

# Text form of event time in exported files (microseconds kept).
TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
ISO_TIME_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header + values; blanks are kept as written (a single space stays a
    space), event times keep their microseconds. NULL and '' both leave an empty
    field, which reads back as NULL."""
    (df.write.mode(mode).option("header", True).option("timestampFormat", ISO_TIME_TEXT)
     .option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def write_invalid(invalid: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """K1: rejects with every input column and ``reasons``."""
    if fmt == "csv":
        write_csv(invalid, path, mode)
    else:
        invalid.write.mode(mode).parquet(path)


def write_predictions(pred: DataFrame, path: str, *, with_keys: bool = False, fmt: str = "csv",
                      mode: str = "overwrite") -> None:
    """K4: timestamp, temperature, prediction (+ sensor_id with ``with_keys``)."""
    cols = (["sensor_id"] if with_keys else []) + ["timestamp", "temperature", "prediction"]
    out = pred.select(*cols)
    if fmt == "csv":
        write_csv(out, path, mode)
    else:
        out.write.mode(mode).parquet(path)


def readings_to_wide_csv(readings: DataFrame, path: str, *, id_col: str = "event_id") -> None:
    """Readings as the 15-column process CSV (plus an id column); the columns
    the loader does not use are left empty."""
    cols = []
    for name in WIDE_CSV_COLUMNS:
        if name == "Timestamp":
            cols.append(F.date_format("timestamp", TIME_TEXT).alias(name))
        elif name.startswith("Current Temperature"):
            cols.append(F.col("temperature").cast("string").alias(name))
        elif name.startswith("Humidity"):
            cols.append(F.col("humidity").cast("string").alias(name))
        else:
            cols.append(F.lit(None).cast("string").alias(name))
    cols.append(F.col("event_id").cast("string").alias(id_col))
    write_csv(readings.select(*cols), path)


def readings_to_json_value(readings: DataFrame) -> DataFrame:
    """One JSON object per reading in column ``value`` (the message a
    producer publishes). Event time is ISO-8601 text with offset."""
    body = F.struct(
        F.col("sensor_id"),
        F.date_format("timestamp", ISO_TIME_TEXT).alias("timestamp"),
        F.col("temperature"),
        F.col("humidity"),
        (F.col("is_faulty") if "is_faulty" in readings.columns else F.lit(False)).alias("is_faulty"),
        (F.col("fault_type") if "fault_type" in readings.columns else F.lit(None).cast("string")).alias("fault_type"),
        F.col("source"),
        F.col("event_id"),
        F.col("event_id").alias("source_id"),
    )
    # a missing value is published as an explicit null, not left out
    return readings.select(F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def readings_to_json(readings: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON Lines landing files, one object per reading."""
    readings_to_json_value(readings).write.mode(mode).text(path)
