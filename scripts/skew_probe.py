"""Skew probe: largest task per stage, skew-safe features vs the plain
per-sensor window form, on a generated table where one sensor holds two
thirds of the rows. Reads Spark's event log (written to a scratch folder).

    python scripts/skew_probe.py [rows]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


def _events(log_dir):
    import zstandard
    for f in sorted(glob.glob(f"{log_dir}/*/events_*") + glob.glob(f"{log_dir}/*")):
        if os.path.isdir(f):
            continue
        raw = open(f, "rb")
        stream = zstandard.ZstdDecompressor().stream_reader(raw) if f.endswith(".zstd") else raw
        for line in io.TextIOWrapper(stream, encoding="utf-8"):
            yield json.loads(line)


def main():
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    log_dir = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    from pyspark.sql import functions as F
    from plain_forms import features_window, row_number_window
    from sensorlake.operators.features import add_features
    from sensorlake.operators.splits import label_reference_current
    from sensorlake.session import build_session
    spark = build_session("local[8]", app="skew-probe", shuffle_partitions=32,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    sc = spark.sparkContext
    hot = 2 * n // 3
    ids = spark.range(0, n, numPartitions=32)
    sensor = F.when(F.col("id") < hot, F.lit("HOT")).otherwise(
        F.concat(F.lit("S"), (F.col("id") % 2).cast("string")))
    readings = ids.select(
        F.col("id").alias("event_id"), sensor.alias("sensor_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + (F.col("id") % hot) * 3).alias("timestamp"),
        (F.lit(370.0) + F.sin(F.col("id").cast("double"))).alias("temperature"),
        F.lit(55.0).alias("humidity"), F.lit("csv").alias("source"))
    times = {}
    forms = (("skew-safe features", lambda d: add_features(d)), ("plain window features", features_window),
             ("distributed global split", label_reference_current),
             ("unpartitioned global window", lambda d: row_number_window(d, [], ["timestamp", "event_id"])))
    for name, fn in forms:
        sc.setJobGroup(name, name)
        t0 = time.perf_counter()
        fn(readings).write.format("noop").mode("overwrite").save()
        times[name] = time.perf_counter() - t0
    sc.setJobGroup("end", "end")
    spark.stop()
    stage_group, per_stage = {}, {}
    for e in _events(log_dir):
        if e["Event"] == "SparkListenerJobStart":
            for sid in e.get("Stage IDs", []):
                stage_group[sid] = e.get("Properties", {}).get("spark.jobGroup.id")
        elif e["Event"] == "SparkListenerTaskEnd":
            g = stage_group.get(e.get("Stage ID"))
            m = e.get("Task Metrics") or {}
            r = (m.get("Shuffle Read Metrics") or {})
            recs = r.get("Total Records Read", 0)
            if g in times and recs:
                st = per_stage.setdefault((g, e["Stage ID"]), [])
                st.append(recs)
    print(f"rows {n}, hot sensor {hot} rows ({hot / n:.0%}), 32 shuffle partitions, local[8]")
    print("| form | seconds | stage | tasks reading shuffle | largest task rows | largest task share |")
    print("|---|---|---|---|---|---|")
    for (g, sid), recs in sorted(per_stage.items()):
        print(f"| {g} | {times[g]:.1f} | {sid} | {len(recs)} | {max(recs)} | {max(recs) / sum(recs):.1%} |")


if __name__ == "__main__":
    main()
