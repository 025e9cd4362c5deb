"""Chronological splits.

* ``split_chrono``: per sensor, over rows with a target, n rows numbered by
  time; train = row <= int(n * 0.70), validation = (train_end, int(n * 0.85)],
  test = the rest. The bounds use double arithmetic truncated to int, exactly
  as written (int(90 * 0.70) = 62, not 63).
* ``split_reference_current``: the first int(N * 0.80) rows by time over all
  sensors are ``reference``, the rest ``current``.

Both number rows with ``sequence_index`` (range-partitioned, exact), so
neither a sensor nor the whole table is ever one task, and neither needs the
count-per-sensor self-join: the per-key count comes from the run table. Where the
features were numbered for their own sake and none was dropped, ``label_numbered``
takes those numbers: the rows with a target are all but the last 12 of a sensor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .features import ORDER, add_features
from .sequence import sequence_index

C_TARGET = "target_temperature"


def _bound(n: str, fraction: float):
    # double arithmetic, truncated toward zero (n >= 0)
    return (F.col(n).cast("double") * F.lit(fraction)).cast("long")


def label_chrono(features: DataFrame, *, keys: tuple[str, ...] = ("sensor_id",),
                 drop_null_change_everywhere: bool = True) -> DataFrame:
    """Rows with a non-null target, labelled ``split`` in {train, validation,
    test}, with ``row_num``, ``total_rows``, ``train_end``, ``validation_end``.
    The rows are always numbered here, so filtered features are split by what
    is left of them.
    The first row of a sensor has no change and is dropped; by default from
    every split (a one-row sensor would otherwise put a NULL feature into
    test). With n >= 2 the first row is always in train, so both rules agree."""
    rows = features.filter(F.col(C_TARGET).isNotNull())
    s = sequence_index(rows.drop("seq", "key_rows"), list(keys), ORDER, seq_col="row_num", count_col="total_rows")
    return _with_split(s, drop_null_change_everywhere)


def label_numbered(features: DataFrame, *, drop_null_change_everywhere: bool = True) -> DataFrame:
    """``label_chrono`` of everything that ``add_features(..., with_seq=True)``
    returned, none filtered since, by the numbers that it already has: no row is
    sorted or stored again. A reading without a temperature (no valid one is) would
    make other rows lack a target; it raises an error."""
    n = F.col("key_rows") - C.TARGET_LEAD_ROWS
    target = F.coalesce(C_TARGET, F.raise_error(F.lit("label_numbered: a reading has no temperature")).cast("double"))
    rows = (features.filter(F.col("seq") <= n).withColumns({C_TARGET: target, "total_rows": n})
            .withColumnRenamed("seq", "row_num").drop("key_rows"))
    return _with_split(rows, drop_null_change_everywhere)


def labelled_features(valid: DataFrame, *, drop_null_change_everywhere: bool = True, **feature_kw) -> DataFrame:
    """Features and splits of validated readings with one numbering."""
    return label_numbered(add_features(valid, with_seq=True, **feature_kw),
                          drop_null_change_everywhere=drop_null_change_everywhere)


def _with_split(s: DataFrame, drop_null_change_everywhere: bool) -> DataFrame:
    s = (s.withColumn("train_end", _bound("total_rows", C.TRAIN_FRACTION))
          .withColumn("validation_end", _bound("total_rows", C.VALIDATION_FRACTION)))
    split = (F.when(F.col("row_num") <= F.col("train_end"), F.lit("train"))
             .when(F.col("row_num") <= F.col("validation_end"), F.lit("validation"))
             .otherwise(F.lit("test")))
    s = s.withColumn("split", split)
    keep_null = F.col("temperature_change").isNotNull()
    if not drop_null_change_everywhere:
        keep_null = keep_null | (F.col("split") != "train")
    return s.filter(keep_null)


def split_chrono(features: DataFrame, **kw) -> tuple[DataFrame, DataFrame, DataFrame]:
    labelled = label_chrono(features, **kw)
    return tuple(labelled.filter(F.col("split") == name).drop("split")
                 for name in ("train", "validation", "test"))


def label_reference_current(df: DataFrame, *, fraction: float = C.REFERENCE_FRACTION) -> DataFrame:
    """Adds global ``row_number`` (by timestamp, event_id), ``total_rows`` and
    ``slice`` in {reference, current}."""
    s = sequence_index(df, [], ORDER, seq_col="row_number", count_col="total_rows")
    cut = _bound("total_rows", fraction)
    return s.withColumn("slice", F.when(F.col("row_number") <= cut, F.lit("reference"))
                        .otherwise(F.lit("current")))


def split_reference_current(df: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    labelled = label_reference_current(df, **kw)
    return (labelled.filter(F.col("slice") == "reference").drop("slice", "row_number", "total_rows"),
            labelled.filter(F.col("slice") == "current").drop("slice", "row_number", "total_rows"))
