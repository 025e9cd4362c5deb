"""Stream metrics as a table.

``ProgressLog`` is a listener that writes each micro-batch's progress as one small
JSON file to shared storage, when Spark reports it: input rows, rows dropped
behind the watermark, durations, and the metrics that ``observe_quality`` counted
while the batch flowed through. ``read_progress`` gives one row per query and
batch; a batch that ran again (after a failure) counts as its last run. The rows
can be joined with counts from the sinks, by any number of readers, long after
the query stopped (``recentProgress`` is gone with its session).
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions.rules import RULE_NAMES
from ..session import read_if_exists
from ..sources.folder import list_files, open_folder

COUNTS = ["rows", "valid_rows", "invalid_rows", *RULE_NAMES]
SCHEMA = ("query_id string, run_id string, name string, batch_id long, at timestamp, input_rows long, late_rows long, "
          "trigger_ms long, add_batch_ms long, " + ", ".join(f"{c} long" for c in COUNTS))


def progress_record(progress: dict, metrics: str = "etl_quality") -> dict:
    """The table's row of a progress report (the dict of its JSON)."""
    observed = (progress.get("observedMetrics") or {}).get(metrics) or {}
    duration = progress.get("durationMs") or {}
    return {"query_id": progress["id"], "run_id": progress["runId"], "name": progress.get("name"),
            "batch_id": progress["batchId"], "at": progress["timestamp"], "input_rows": progress.get("numInputRows", 0),
            "late_rows": sum(s.get("numRowsDroppedByWatermark", 0) for s in progress.get("stateOperators") or []),
            "trigger_ms": duration.get("triggerExecution"), "add_batch_ms": duration.get("addBatch"),
            **{c: observed.get(c, 0) for c in COUNTS}}


class ProgressLog(StreamingQueryListener):
    """Add it with ``spark.streams.addListener(ProgressLog(folder))``; logs every
    query of the session."""

    def __init__(self, folder: str, metrics: str = "etl_quality"):
        self.folder, self.metrics = folder, metrics

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        record = progress_record(json.loads(event.progress.json), self.metrics)
        files, root = open_folder(self.folder)
        files.create_dir(root, recursive=True)
        # the name tells a batch's runs apart; a report that comes twice replaces itself
        name = f"{record['query_id']}-{record['batch_id']:012d}-{record['run_id']}-{record['at'].replace(':', '')}.json"
        with files.open_output_stream(f"{root}/{name}", compression=None) as out:
            out.write(json.dumps(record).encode() + b"\n")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def await_logged(folder: str, queries: list[StreamingQuery], seconds: float = 30.0) -> None:
    """Waits until the last report of each (stopped) query is in the log: Spark
    hands reports to listeners a little later."""
    wanted = {(q.lastProgress["runId"], q.lastProgress["batchId"]) for q in queries if q.lastProgress}
    until = time.monotonic() + seconds
    while True:
        files, root = open_folder(folder)
        names = [f.base_name for f in list_files(files, root, ".json")]
        missing = [w for w in wanted if not any(f"-{w[1]:012d}-{w[0]}-" in n for n in names)]
        if not missing:
            return
        if time.monotonic() > until:
            raise TimeoutError(f"no report of {missing} in {folder} after {seconds} s")
        time.sleep(0.05)


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    """One row per query and batch."""
    rows = read_if_exists(spark, folder, SCHEMA, fmt="json")
    rows = spark.createDataFrame([], SCHEMA) if rows is None else rows
    last = Window.partitionBy("query_id", "batch_id").orderBy(F.desc("at"), F.desc("input_rows"))
    return rows.withColumn("_n", F.row_number().over(last)).filter(F.col("_n") == 1).drop("_n")


def stream_totals(progress: DataFrame, accepted: DataFrame) -> DataFrame:
    """The log's counts over all batches beside the rows of the sink
    (``accepted_rows``); what is valid, neither late nor accepted, repeated a key."""
    seen = progress.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in [*COUNTS, "late_rows"]])
    stored = accepted.agg(F.count(F.lit(1)).alias("accepted_rows"))
    both = seen.withColumn("accepted_rows", F.lit(0).cast("long")).unionByName(
        stored.select(*[F.lit(0).cast("long").alias(c) for c in [*COUNTS, "late_rows"]], "accepted_rows"))
    total = both.agg(*[F.sum(c).cast("long").alias(c) for c in both.columns])
    return total.withColumn("duplicate_rows", F.col("valid_rows") - F.col("late_rows") - F.col("accepted_rows"))
