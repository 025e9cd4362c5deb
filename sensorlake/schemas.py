"""Fixed schemas. Every source is parsed into READING before anything else."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# One reading per sensor per instant. ``event_id`` is the row's stable id
# (file line, table id or event id); it breaks ties between equal timestamps
# and orders the input for "file order" statistics. ``source`` names the
# origin (csv, api, database, ...), which ranks duplicates.
READING = StructType([
    StructField("event_id", LongType(), True),
    StructField("sensor_id", StringType(), True),
    StructField("timestamp", TimestampType(), True),
    StructField("temperature", DoubleType(), True),
    StructField("humidity", DoubleType(), True),
    StructField("source", StringType(), True),
])

READING_COLUMNS = [f.name for f in READING.fields]

# The JSON value of a stream event. Numbers and flags are read as text and
# converted with try_cast, because one producer quotes every field.
STREAM_VALUE_TEXT = StructType([
    StructField("sensor_id", StringType(), True),
    StructField("timestamp", StringType(), True),
    StructField("temperature", StringType(), True),
    StructField("humidity", StringType(), True),
    StructField("is_faulty", StringType(), True),
    StructField("fault_type", StringType(), True),
    StructField("source", StringType(), True),
    StructField("event_id", StringType(), True),
])

# The same event with native JSON types (numbers as numbers); a quoted number
# becomes NULL under this schema.
STREAM_VALUE_STRICT = StructType([
    StructField("sensor_id", StringType(), True),
    StructField("timestamp", StringType(), True),
    StructField("temperature", DoubleType(), True),
    StructField("humidity", DoubleType(), True),
    StructField("is_faulty", BooleanType(), True),
    StructField("fault_type", StringType(), True),
    StructField("source", StringType(), True),
    StructField("event_id", LongType(), True),
])

# --- fixed values: the wide process CSV header (15 columns, in file order);
# only three feed a reading.
WIDE_CSV_COLUMNS = [
    "Timestamp",
    "Current Temperature (°C)",
    "Setpoint Temperature (°C)",
    "Temperature Error (°C)",
    "PID Control Output (%)",
    "Fuzzy PID Control Output (%)",
    "Overshoot (°C)",
    "Response Time (s)",
    "Steady-State Error (°C)",
    "Ambient Temperature (°C)",
    "Humidity (%)",
    "PID Kp",
    "PID Ki",
    "PID Kd",
    "Fuzzy Rule Base Parameters",
]

FEATURE_COLUMNS = [
    "temperature",
    "humidity",
    "temperature_change",
    "rolling_avg_temperature",
]
TARGET_COLUMN = "target_temperature"

# Columns kept by the feature store (the target is not stored).
FEATURE_STORE_COLUMNS = [
    "sensor_id",
    "timestamp",
    "temperature",
    "humidity",
    "temperature_change",
    "rolling_avg_temperature",
]
