"""Fault injection into a readings table (G2) and the reading grid (G1).

Faults are chosen per row from (seed, event_id) alone, so the result is the
same on every run and every executor, with no shuffle: at ``rate`` a row gets
one of six faults, each touching one field, and is labelled ``is_faulty`` /
``fault_type``. Out-of-range values lie U(1, 0.2 * span) beyond a bound,
either side, in whole hundredths.

The per-row draws are a multiplicative hash in exact 64-bit integer
arithmetic (``(id mod 2^31) * a + c mod 2^31``), so any SQL engine computes
the same faults - the injection is checked against SQL.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C

_UNIT = 1 << 30
_M = 1 << 31
# multiplier per independent draw (distinct odd constants)
_MULT = {"rate": 1103515245, "kind": 22695477, "blank": 1664525, "side": 214013, "mag": 134775813}


def _draw(seed: int, name: str, key: str = "event_id") -> Column:
    """Deterministic U[0, 1) per row from (seed, name, key)."""
    c = (seed * 7919 + list(_MULT).index(name) * 104729) % _M
    return F.pmod(F.pmod(F.col(key), F.lit(_M)) * F.lit(_MULT[name]) + F.lit(c), F.lit(_M)).cast("double") / _M


def inject_faults(readings: DataFrame, *, rate: float = C.SIMULATOR_DEFAULTS["fault_rate"], seed: int = 0,
                  bounds: dict | None = None) -> DataFrame:
    b = dict(C.SIMULATOR_DEFAULTS, **(bounds or {}))
    hit = _draw(seed, "rate") < F.lit(rate)
    kind = F.element_at(F.array(*[F.lit(f) for f in C.FAULT_TYPES]),
                        (F.floor(_draw(seed, "kind") * len(C.FAULT_TYPES)) + 1).cast("int"))
    fault = F.when(hit, kind)
    blank = F.element_at(F.array(F.lit(None).cast("string"), F.lit(""), F.lit(" ")),
                         (F.floor(_draw(seed, "blank") * 3) + 1).cast("int"))

    def beyond(lo: float, hi: float) -> Column:
        span_cents = int(round(0.2 * (hi - lo) * 100))
        cents = F.lit(100) + F.floor(_draw(seed, "mag") * F.lit(span_cents - 100))
        low = _draw(seed, "side") < 0.5
        return F.when(low, (F.lit(int(round(lo * 100))) - cents) / 100.0) \
            .otherwise((F.lit(int(round(hi * 100))) + cents) / 100.0)

    def only(name: str, value: Column, col: str) -> Column:
        return F.when(fault == name, value).otherwise(F.col(col))

    return readings.select(
        "event_id",
        only("missing_sensor_id", blank, "sensor_id").alias("sensor_id"),
        only("missing_timestamp", F.lit(None).cast("timestamp"), "timestamp").alias("timestamp"),
        F.when(fault == "missing_temperature", F.lit(None).cast("double"))
        .when(fault == "temperature_out_of_range", beyond(b["temp_min"], b["temp_max"]))
        .otherwise(F.col("temperature")).alias("temperature"),
        F.when(fault == "missing_humidity", F.lit(None).cast("double"))
        .when(fault == "humidity_out_of_range", beyond(b["hum_min"], b["hum_max"]))
        .otherwise(F.col("humidity")).alias("humidity"),
        "source",
        hit.alias("is_faulty"),
        fault.alias("fault_type"),
    )


def reading_grid(spark: SparkSession, *, sensors=C.SENSOR_IDS, per_sensor: int = C.GRID_READINGS_PER_SENSOR,
                 start: _dt.datetime = _dt.datetime(2026, 10, 1),
                 interval_minutes: int = C.GRID_INTERVAL_MINUTES, seed: int = 7) -> DataFrame:
    """G1: sensors x per_sensor readings every ``interval_minutes``: base
    U(360, 380) per sensor, noise U(-2, 2), an upward trend of 3 over the
    series; humidity base U(50, 60) per sensor, noise U(-1.5, 1.5); values
    rounded to 2 places. Generated in parallel from ``spark.range``."""
    n = len(sensors)
    ids = spark.range(0, n * per_sensor, numPartitions=max(1, min(64, n * per_sensor // 100_000 + 1)))
    s_idx = (F.col("id") / per_sensor).cast("int")
    i = F.col("id") % per_sensor
    sensor = F.element_at(F.array(*[F.lit(s) for s in sensors]), s_idx + 1)

    def u(salt: str, key: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), key), F.lit(_UNIT)).cast("double") / _UNIT

    base_t = F.lit(360.0) + u("base_t", s_idx) * 20.0
    base_h = F.lit(50.0) + u("base_h", s_idx) * 10.0
    t = base_t + (u("noise_t", F.col("id")) * 4.0 - 2.0) + F.lit(3.0) * i / per_sensor
    h = base_h + (u("noise_h", F.col("id")) * 3.0 - 1.5)
    start_s = int(start.replace(tzinfo=_dt.timezone.utc).timestamp())
    return ids.select(
        (F.col("id") + 1).alias("event_id"),
        sensor.alias("sensor_id"),
        F.timestamp_seconds(F.lit(start_s) + i * (interval_minutes * 60)).alias("timestamp"),
        F.round(t, 2).alias("temperature"),
        F.round(h, 2).alias("humidity"),
        F.lit("database").alias("source"),
    )
