"""Backfill of what late or corrected readings change.

Readings and features are kept by day (``event_date`` partitions). A late or
corrected reading changes its own features, the change of its successor, the
rolling means of the next 30 minutes and the targets of the 12 readings before
it. So its day is dirty, and so are the days that hold those readings: found from
a table of row counts per sensor and day (running counts, no readings), however
large the gaps between days with data. Only the dirty days are computed again, from
themselves and the days that their own frames reach, and replaced; all other
features stay as they are.

``corrections`` replace the stored reading of the same ``event_id``, or are new.
The readings are replaced first, the features after: a run that failed in
between is repeated with the same corrections.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from ..operators.features import add_features
from ..schemas import READING_COLUMNS
from ..session import durable, read_if_exists

FEATURES = ["temperature_change", "rolling_avg_temperature", "target_temperature"]


@dataclass
class Backfill:
    """What a backfill did: days and rows computed again, rows read for it."""
    days: int
    rows: int
    rows_read: int


def with_date(rows: DataFrame) -> DataFrame:
    return rows.withColumn("event_date", F.to_date("timestamp"))


def replace_days(rows: DataFrame, path: str) -> None:
    """Replaces the days that ``rows`` (stored, with ``event_date``) have."""
    (rows.repartitionByRange("event_date", "sensor_id", "timestamp").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path))


def _reach(per_day: DataFrame, days: DataFrame, before: int, after: int) -> DataFrame:
    """``days`` and, of every sensor, the days that hold its last ``before`` rows
    ahead of one of them, its first ``after`` rows behind one, and the next day (30
    minutes reach over midnight). ``per_day``: sensor_id, event_date, n."""
    marked = per_day.join(days.withColumn("_hit", F.lit(True)), "event_date", "left").fillna(False, ["_hit"])
    w = Window.partitionBy("sensor_id").orderBy("event_date")
    ahead = w.rowsBetween(1, Window.unboundedFollowing)
    behind = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0))
    s = marked.withColumns({"_upto": upto, "_from": upto - F.col("n")})
    # rows between this day and the nearest dirty day: after it, and before it
    next_hit = F.min(F.when(F.col("_hit"), F.col("_from"))).over(ahead)
    last_hit = F.max(F.when(F.col("_hit"), F.col("_upto"))).over(behind)
    s = s.select("event_date", "_hit", (next_hit - F.col("_upto")).alias("_to_next"), (F.col("_from") - last_hit).alias("_to_last"))
    near = (F.col("_hit") | (F.col("_to_next") < before) | (F.col("_to_last") < after))
    return (s.filter(near).select("event_date").unionByName(days.select(F.date_add("event_date", 1).alias("event_date")))
            .unionByName(days.select("event_date")).distinct())


def build_features(spark: SparkSession, readings_path: str, features_path: str) -> None:
    """All features of the stored readings, by day."""
    rows = spark.read.parquet(readings_path).select(*READING_COLUMNS)
    replace_days(durable(with_date(add_features(rows)), "features"), features_path)


def backfill(spark: SparkSession, corrections: DataFrame, readings_path: str, features_path: str) -> Backfill:
    """Puts valid ``corrections`` (reading columns) into the stored readings and
    brings the stored features up to date."""
    new = durable(with_date(corrections.select(*READING_COLUMNS)), "corrections")
    stored = spark.read.parquet(readings_path)
    # days of the corrected readings, old and new ones: a correction may move a reading to another day
    old = durable(stored.join(new.select("event_id"), "event_id", "left_semi").select("event_date").distinct(), "old-days")
    dirty = durable(old.unionByName(new.select("event_date")).distinct(), "dirty-days")
    kept = (stored.join(dirty, "event_date", "left_semi").join(new.select("event_id"), "event_id", "left_anti"))
    changed = durable(kept.select(*new.columns).unionByName(new), "changed-days")
    replace_days(changed, readings_path)
    # a day that lost its last reading has no rows to replace it with
    emptied = [r[0] for r in dirty.join(changed.select("event_date").distinct(), "event_date", "left_anti").collect()]
    _drop_days(spark, readings_path, emptied)

    rows = spark.read.parquet(readings_path)
    per_day = durable(rows.groupBy("sensor_id", "event_date").agg(F.count(F.lit(1)).alias("n")), "rows-per-day")
    again = durable(_reach(per_day, dirty, C.TARGET_LEAD_ROWS, 1), "days-again")
    # what the frames of those days reach: the row and the 30 minutes before, 12 rows behind
    needed = (_reach(per_day, again, 1, C.TARGET_LEAD_ROWS)
              .unionByName(again.select(F.date_sub("event_date", 1).alias("event_date"))).distinct())
    source = durable(rows.join(needed, "event_date", "left_semi"), "readings-again")
    features = durable(add_features(source.select(*READING_COLUMNS)).withColumn("event_date", F.to_date("timestamp"))
                       .join(again, "event_date", "left_semi"), "features-again")
    replace_days(features.select(*READING_COLUMNS, *FEATURES, "event_date"), features_path)
    _drop_days(spark, features_path, emptied)
    return Backfill(again.count(), features.count(), source.count())


def _drop_days(spark: SparkSession, path: str, days: list) -> None:
    from ..session import delete_path
    for day in days:
        if read_if_exists(spark, f"{path}/event_date={day}") is not None:
            delete_path(spark, f"{path}/event_date={day}")
