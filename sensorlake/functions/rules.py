"""Column expressions for reading validation (JVM-side builtins only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def sensor_missing(blank: str = "exact_space") -> Column:
    """Null, or blank. ``exact_space``: only a single space is blank (an empty
    string passes); ``trim``: anything that trims to '' is blank."""
    sid = F.col("sensor_id")
    if blank == "trim":
        return sid.isNull() | (F.trim(sid) == "")
    return sid.isNull() | (sid == F.lit(C.BLANK_SENSOR_ID))


def _out_of(col: str, bounds: tuple[float, float]) -> Column:
    c = F.col(col)
    # NaN compares above every number, so it is out of range.
    return c.isNotNull() & ((c < bounds[0]) | (c > bounds[1]))


def reason_columns(blank: str = "exact_space") -> list[Column]:
    """One nullable reason per rule, in rule order."""
    return [
        F.when(sensor_missing(blank), F.lit(C.REASON_SENSOR_MISSING)),
        F.when(F.col("timestamp").isNull(), F.lit(C.REASON_TIMESTAMP_MISSING)),
        F.when(F.col("temperature").isNull(), F.lit(C.REASON_TEMPERATURE_MISSING)),
        F.when(_out_of("temperature", C.TEMPERATURE_RANGE), F.lit(C.REASON_TEMPERATURE_RANGE)),
        F.when(F.col("humidity").isNull(), F.lit(C.REASON_HUMIDITY_MISSING)),
        F.when(_out_of("humidity", C.HUMIDITY_RANGE), F.lit(C.REASON_HUMIDITY_RANGE)),
    ]


# names of the rules' counts, in rule order
RULE_NAMES = (
    "missing_sensor_id",
    "missing_timestamp",
    "missing_temperature",
    "temperature_out_of_range",
    "missing_humidity",
    "humidity_out_of_range",
)


def reasons(blank: str = "exact_space") -> Column:
    """Non-null reasons joined by ', ' in rule order; '' for a clean row.
    concat_ws skips nulls, so no intermediate array is needed."""
    return F.concat_ws(C.REASON_SEPARATOR, *reason_columns(blank))


def is_valid(blank: str = "exact_space") -> Column:
    """The same rule set as a plain conjunction: true iff ``reasons`` is ''.
    Written this way so Parquet can push it down when readings are stored."""
    t, h = F.col("temperature"), F.col("humidity")
    return (
        ~sensor_missing(blank)
        & F.col("timestamp").isNotNull()
        & t.isNotNull() & (t >= C.TEMPERATURE_RANGE[0]) & (t <= C.TEMPERATURE_RANGE[1])
        & h.isNotNull() & (h >= C.HUMIDITY_RANGE[0]) & (h <= C.HUMIDITY_RANGE[1])
    )
