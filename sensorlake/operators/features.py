"""Per-sensor time-series features.

* ``temperature_change`` = temperature - previous reading's temperature
  (per sensor, by timestamp; NULL on a sensor's first row);
* ``rolling_avg_temperature`` = mean temperature over the readings of the
  same sensor whose whole-second time is within [t - 1800 s, t] (a RANGE
  frame: readings in the same second are peers and all count);
* ``target_temperature`` = temperature 12 readings later (rows, not time);
* optional ``humidity_trend`` = humidity - previous humidity.

A single sensor may hold a third of all rows, so nothing is partitioned by
sensor alone:
  - rows get an exact per-sensor sequence number (``sequence_index``), are cut
    into chunks of ``chunk_rows`` consecutive rows, and each chunk is sent
    the one row before it and the 12 rows after it (a halo), so lag/lead run
    as ordinary windows over (sensor, chunk) - every task holds at most
    ``chunk_rows + 13`` rows;
  - the rolling mean is pre-aggregated to one (sum, count) per sensor and
    second (partial aggregation before the shuffle), cut into day chunks
    with the previous 1800 seconds as halo (at most 86,400 + 1,800 rows per
    task whatever the data rate), and joined back on (sensor, second).

The tests check the result against the plain per-sensor window form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from .sequence import sequence_index

DEFAULT_CHUNK_ROWS = 1 << 12   # rows per lag/lead window group (+13 halo rows)
DEFAULT_CHUNK_SECONDS = 86_400
ORDER = ["timestamp", "event_id"]


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since the epoch (floor), as the RANGE frame orders by."""
    return F.unix_seconds(ts)


# ---------------------------------------------------------------- lag / lead

def offset_values(seq_df: DataFrame, keys: list[str], specs: list[tuple[str, str, int]], *,
                  seq_col: str = "seq", chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """For each (out, col, k) adds ``out`` = value of ``col`` k rows later
    (k > 0, lead) or -k rows earlier (k < 0, lag) within the same key, by
    ``seq_col``. Exact; each task holds at most one chunk plus its halo."""
    before = max([-k for _, _, k in specs if k < 0], default=0)
    after = max([k for _, _, k in specs if k > 0], default=0)
    if chunk_rows <= max(before, after):
        raise ValueError("chunk_rows must exceed every offset")
    seq = F.col(seq_col)
    chunk = F.expr(f"({seq_col} - 1) div {chunk_rows}")
    pos = (seq - 1) % chunk_rows
    # Every row goes to its own chunk; the last ``before`` rows of a chunk
    # also go to the next one (its predecessors) and the first ``after`` rows
    # to the previous one (its successors). One scan, one explode.
    targets = [chunk]
    if before:
        targets.append(F.when(pos >= chunk_rows - before, chunk + 1))
    if after:
        targets.append(F.when((pos < after) & (chunk > 0), chunk - 1))
    ext = seq_df.select("*", chunk.alias("_home"), F.explode(F.array_compact(F.array(*targets))).alias("_chunk"))
    w = Window.partitionBy(*keys, "_chunk").orderBy(seq_col)
    cols = [F.lead(c, k).over(w).alias(out) if k > 0 else F.lag(c, -k).over(w).alias(out)
            for out, c, k in specs]
    return (ext.select("*", *cols).filter(F.col("_chunk") == F.col("_home"))
            .drop("_chunk", "_home"))


# ---------------------------------------------------------------- rolling mean

def rolling_mean_by_second(df: DataFrame, keys: list[str], value: str, *, ts_col: str = "timestamp",
                           window_seconds: int = C.ROLLING_WINDOW_SECONDS,
                           chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
                           out: str = "rolling") -> DataFrame:
    """One row per (keys, second) present in ``df``: ``_sec`` and ``out`` = mean
    of ``value`` over that key's rows with second in [_sec - window, _sec]."""
    if chunk_seconds < window_seconds:
        raise ValueError("chunk_seconds must be at least window_seconds")
    per_sec = df.groupBy(*keys, epoch_seconds(F.col(ts_col)).alias("_sec")).agg(
        F.sum(value).alias("_sum"), F.count(value).alias("_cnt"))
    day = F.floor(F.col("_sec") / F.lit(chunk_seconds)).cast("long")   # floor: also before 1970
    # a second in the last ``window`` seconds of its day also feeds the next day
    tail = F.col("_sec") - day * chunk_seconds >= chunk_seconds - window_seconds
    ext = per_sec.select("*", day.alias("_home"),
                         F.explode(F.array_compact(F.array(day, F.when(tail, day + 1)))).alias("_day"))
    w = (Window.partitionBy(*keys, "_day").orderBy("_sec")
         .rangeBetween(-window_seconds, Window.currentRow))
    mean = F.try_divide(F.sum("_sum").over(w), F.sum("_cnt").over(w))
    return (ext.select(*keys, "_sec", "_day", "_home", mean.alias(out))
            .filter(F.col("_day") == F.col("_home")).drop("_day", "_home"))


# ---------------------------------------------------------------- features

def _feature_names(change: bool, rolling: bool, target: bool, humidity_trend: bool) -> list[str]:
    return ((["temperature_change"] if change else []) + (["rolling_avg_temperature"] if rolling else [])
            + (["target_temperature"] if target else []) + (["humidity_trend"] if humidity_trend else []))


def add_features(valid: DataFrame, *, keys: tuple[str, ...] = ("sensor_id",),
                 chunk_rows: int = DEFAULT_CHUNK_ROWS, chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
                 change: bool = True, rolling: bool = True, target: bool = True,
                 humidity_trend: bool = False, with_seq: bool = False, target_time: bool = False) -> DataFrame:
    """F1 change, F2 rolling mean, F3 target (optionally the humidity trend),
    appended to the input columns. Ties on timestamp are broken by
    ``event_id``. Only the requested features are computed. ``with_seq``
    also keeps ``seq`` (row number per sensor) and ``key_rows`` (rows of the
    sensor); ``target_time`` adds the event time of the target's reading."""
    keys = list(keys)
    names = _feature_names(change, rolling, target, humidity_trend)
    # the rolling mean needs no numbers: without another feature nothing is sorted
    seq_df = sequence_index(valid, keys, ORDER, count_col="key_rows") \
        if change or target or humidity_trend or with_seq or target_time else valid
    specs = []
    if change:
        specs.append(("_prev_t", "temperature", -1))
    if humidity_trend:
        specs.append(("_prev_h", "humidity", -1))
    if target:
        specs.append(("target_temperature", "temperature", C.TARGET_LEAD_ROWS))
    if target_time:
        specs.append(("target_time", "timestamp", C.TARGET_LEAD_ROWS))
    out = offset_values(seq_df, keys, specs, chunk_rows=chunk_rows) if specs else seq_df
    if rolling:
        rmean = rolling_mean_by_second(seq_df, keys, "temperature", chunk_seconds=chunk_seconds,
                                       out="rolling_avg_temperature")
        left = out.withColumn("_sec", epoch_seconds(F.col("timestamp")))
        r = rmean.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_sec").alias("_k_sec"),
                         "rolling_avg_temperature")
        cond = left["_sec"].eqNullSafe(r["_k_sec"])
        for k in keys:
            cond = cond & left[k].eqNullSafe(r[f"_k_{k}"])
        out = left.join(r, cond, "left").drop("_sec", "_k_sec", *[f"_k_{k}" for k in keys])
    if change:
        out = out.withColumn("temperature_change", F.col("temperature") - F.col("_prev_t"))
    if humidity_trend:
        out = out.withColumn("humidity_trend", F.col("humidity") - F.col("_prev_h"))
    return out.select(*valid.columns, *(["seq", "key_rows"] if with_seq else []), *names,
                      *(["target_time"] if target_time else []))


__all__ = ["add_features", "offset_values", "rolling_mean_by_second", "epoch_seconds"]
