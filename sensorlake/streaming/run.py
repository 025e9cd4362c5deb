"""Run the stream consumer (T4).

    python -m sensorlake.streaming.run --kafka host:9092 --out /shared/stream
    python -m sensorlake.streaming.run --landing /shared/landing --out /shared/stream --available-now

One checkpointed query that writes raw messages, deduplicated valid readings and
rejects under ``--out``; ``--late quarantine`` also keeps the rows behind the
watermark. Waits until it stops.
"""

from __future__ import annotations

import argparse

from .. import config as C
from ..session import build_session
from .consumer import await_all, file_source, kafka_source, run_consumer


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", help="bootstrap servers")
    src.add_argument("--landing", help="folder of JSON Lines message files")
    ap.add_argument("--topic", default=C.STREAM_TOPIC)
    ap.add_argument("--starting-offsets", default="latest")
    ap.add_argument("--out", required=True)
    ap.add_argument("--trigger", default=None, help="processing-time trigger, e.g. '5 seconds'")
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--late", choices=("drop", "quarantine"), default="drop")
    ap.add_argument("--master", default="local[*]")
    args = ap.parse_args(argv)
    spark = build_session(args.master, app="sensorlake-consumer")
    messages = (kafka_source(spark, args.kafka, args.topic, args.starting_offsets) if args.kafka
                else file_source(spark, args.landing))
    await_all([run_consumer(messages, args.out, available_now=args.available_now, processing_time=args.trigger,
                            keep_late=args.late == "quarantine")])


if __name__ == "__main__":
    main()
