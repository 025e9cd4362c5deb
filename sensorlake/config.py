"""Fixed values. These must equal the behaviour being reproduced; they are the
rule texts, bounds, thresholds and defaults of the pipeline, stated once."""

from __future__ import annotations

# --- fixed values: validation -------------------------------------------
TEMPERATURE_RANGE = (300.0, 450.0)
HUMIDITY_RANGE = (30.0, 80.0)
REASON_SENSOR_MISSING = "Sensor ID is missing"
REASON_TIMESTAMP_MISSING = "Timestamp is missing"
REASON_TEMPERATURE_MISSING = "Temperature is missing"
REASON_TEMPERATURE_RANGE = "Temperature is out of range"
REASON_HUMIDITY_MISSING = "Humidity is missing"
REASON_HUMIDITY_RANGE = "Humidity is out of range"
REASON_SEPARATOR = ", "
BLANK_SENSOR_ID = " "   # exactly one space counts as missing; '' does not

# --- fixed values: features ----------------------------------------------
ROLLING_WINDOW_SECONDS = 30 * 60
TARGET_LEAD_ROWS = 12

# --- fixed values: splits ------------------------------------------------
TRAIN_FRACTION = 0.70
VALIDATION_FRACTION = 0.85
REFERENCE_FRACTION = 0.80

# --- fixed values: training / gate / monitoring (configuration file) -----
REG_PARAM = 0.0
ELASTIC_NET_PARAM = 0.0
MAX_VALIDATION_MAE = 15.0
DRIFT_THRESHOLD_PERCENT = 10.0
MONITORING_COLUMNS = ("temperature", "humidity")
MODEL_NAME = "sensor-forecast"
CHAMPION_ALIAS = "champion"

# --- fixed values: sources -----------------------------------------------
CSV_SENSOR_ID = "MANUFACTURING_01"
CSV_TIMESTAMP_COLUMN = "Timestamp"
CSV_TEMPERATURE_COLUMN = "Current Temperature (°C)"
CSV_HUMIDITY_COLUMN = "Humidity (%)"
# Union order of the batch loader; the first source wins a duplicate key.
SOURCE_PRIORITY = ("csv", "api", "database")

# --- fixed values: stream ------------------------------------------------
STREAM_TOPIC = "raw-sensor-readings"
WATERMARK_DELAY = "10 minutes"
WATERMARK_SECONDS = 600
STREAM_DEDUP_KEYS = ("sensor_id", "timestamp", "source")

# --- fixed values: simulator (fault injection and calibration) -----------
FAULT_TYPES = (
    "missing_sensor_id",
    "missing_timestamp",
    "missing_temperature",
    "missing_humidity",
    "temperature_out_of_range",
    "humidity_out_of_range",
)
SENSOR_IDS = ("MANUFACTURING_01", "MANUFACTURING_02", "MANUFACTURING_03")
SIMULATOR_DEFAULTS = {
    "temp_min": 300.0,
    "temp_max": 450.0,
    "hum_min": 30.0,
    "hum_max": 80.0,
    "temp_step": 1.0,
    "hum_step": 0.8,
    "coupling": -0.5,
    "fault_rate": 0.05,
}
COUPLING_CLAMP = 2.0
STEP_STD_FRACTION = 0.1
MIN_CALIBRATION_ROWS = 3

# --- fixed values: reading grid generator ---------------------------------
GRID_READINGS_PER_SENSOR = 2000
GRID_INTERVAL_MINUTES = 5
