"""State that a ``foreachBatch`` writer carries from one micro-batch to the next.

One Parquet folder per batch on the shared storage: batch N reads exactly the
folder of N-1 and overwrites its own, so a retried batch starts from the same
state and no batch scans the history. A missing predecessor is an error (the
stream must not silently start again). Folders older than ``KEEP`` batches go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import delete_path

KEEP = 16


def read_state(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """What batch ``batch_id`` starts from; None for the first batch."""
    return None if batch_id == 0 else spark.read.parquet(f"{path}/{batch_id - 1}")


def write_state(state: DataFrame, path: str, batch_id: int) -> None:
    state.write.mode("overwrite").parquet(f"{path}/{batch_id}")
    if batch_id >= KEEP:
        delete_path(state.sparkSession, f"{path}/{batch_id - KEEP}")


def replace_batch(rows: DataFrame, path: str) -> None:
    """Writes one batch's output rows (with ``batch_id``); dynamic overwrite, so
    a retried batch replaces its own output only."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(path))
