"""Exact per-key row numbers without putting a whole key into one task.

``row_number() OVER (PARTITION BY key ORDER BY ...)`` sends every row of a key
to one task, and an unpartitioned window sends the whole table to one task.
With three sensors, one key holds a third of all rows. Instead:

1. range-partition on (key, order...) and sort inside each partition, so a hot
   key is spread over many contiguous, ordered partitions;
2. tag each row with its partition and position, and write the result as a
   table in the shared work folder, because range bounds come from sampling
   and a recomputation could move rows;
3. count rows per (partition, key) run - a table of at most
   partitions + keys rows - and turn the counts into start offsets with a
   running sum per key;
4. join the offsets back and add the local position. Spark picks the join from
   its own statistics of the run table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable

def sequence_index(df: DataFrame, keys: list[str], order: list[str], *,
                   seq_col: str = "seq", count_col: str | None = None,
                   partitions: int | None = None) -> DataFrame:
    """Adds ``seq_col`` = 1-based row number per ``keys`` in ``order``
    (ascending, nulls first), and optionally ``count_col`` = rows per key.
    ``keys`` may be empty for one global numbering. The numbered layout is
    materialised in the shared work folder first."""
    # Without an explicit count the range exchange uses the session's shuffle
    # partitions and AQE may merge small neighbours; merged partitions are
    # contiguous ranges in order, so positions stay exact.
    ranged = (df.repartitionByRange(partitions, *keys, *order) if partitions
              else df.repartitionByRange(*keys, *order))
    laid = (
        ranged
        .sortWithinPartitions(*keys, *order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    laid = durable(laid, "sequence")

    runs = laid.groupBy("_part", *keys).agg(
        F.count(F.lit(1)).alias("_run_rows"),
        F.min("_pos").alias("_run_pos0"),
    )
    # over the run table (at most one row per partition and key), not the data
    by_key = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = by_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("_part").alias("_r_part"),
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        "_run_pos0",
        F.coalesce(F.sum("_run_rows").over(before), F.lit(0)).alias("_run_base"),
        F.sum("_run_rows").over(by_key).alias("_key_rows"),
    )
    cond = laid["_part"] == runs["_r_part"]
    for k in keys:
        cond = cond & laid[k].eqNullSafe(runs[f"_r_{k}"])
    out = laid.join(runs, cond, "inner")
    out = out.withColumn(seq_col, (F.col("_run_base") + F.col("_pos") - F.col("_run_pos0") + 1).cast("long"))
    if count_col:
        out = out.withColumn(count_col, F.col("_key_rows").cast("long"))
    drop = ["_part", "_pos", "_r_part", "_run_pos0", "_run_base", "_key_rows"] + [f"_r_{k}" for k in keys]
    return out.drop(*drop)
