"""Batch pipelines in order: train -> infer -> monitor.

    python -m sensorlake.plans.run_all --events /path/to/sf_dir --work /shared/folder

Readings come from the driver's ``events`` table (``--events``) or from a
Parquet table with the READING columns (``--readings``). Every output lands
under ``--work`` (default: the session's ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import argparse
import json

from ..session import build_session, work_dir
from ..sources.events import readings_raw
from .infer import run_inference
from .monitor import run_monitoring
from .train import run_training


def main(argv=None) -> dict:
    ap = argparse.ArgumentParser()
    ap.add_argument("--events", help="folder holding events.parquet")
    ap.add_argument("--readings", help="Parquet table with READING columns")
    ap.add_argument("--work", help="output folder (default: spark.checkpoint.dir)")
    ap.add_argument("--master", default="local[*]")
    args = ap.parse_args(argv)
    spark = build_session(args.master, app="sensorlake-run-all")
    readings = spark.read.parquet(args.readings) if args.readings else readings_raw(spark, args.events)
    root = (args.work or work_dir(spark)).rstrip("/")
    res = run_training(readings, registry_root=f"{root}/registry", store_root=f"{root}/stores",
                       invalid_path=f"{root}/invalid")
    summary = {"training": {"passed": res.passed, "version": res.version, **res.metrics,
                            "splits": res.split_counts}}
    from ..ml.registry import Registry
    reg = Registry(spark, f"{root}/registry")
    champion = reg.load() if reg.alias_version() is not None else None
    if champion is not None:
        pred = run_inference(readings, champion, f"{root}/predictions")
        summary["inference"] = {"predictions": f"{root}/predictions"}
        del pred
    mon = run_monitoring(readings, champion, registry_root=f"{root}/registry")
    summary["monitoring"] = mon.metrics
    print(json.dumps(summary, default=str))
    return summary


if __name__ == "__main__":
    main()
