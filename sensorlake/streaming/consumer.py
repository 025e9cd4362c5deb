"""Reading events on Structured Streaming.

The message bus is Kafka in production (``kafka_source``, ``kafka_sink``; the
connector jar must be on the classpath). Any source that yields a ``value``
column holding the JSON text of one reading works the same way; tests and
replays use a folder of JSON Lines files (``file_source``).

decode -> parse -> validate is stateless; the valid branch then gets a
10-minute watermark on event time and deduplication on (sensor_id,
timestamp, source), whose state expires past the watermark. A single branch
writes to a checkpointed sink (``start_parquet``); the whole consumer
(``run_consumer``) reads its source once and writes all tables of a micro-batch
under one commit record. A restarted job resumes where it stopped and keeps its
deduplication state.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import config as C
from ..functions.rules import RULE_NAMES, is_valid, reason_columns
from ..operators.validate import validate_reading
from ..schemas import READING_COLUMNS, STREAM_VALUE_STRICT, STREAM_VALUE_TEXT
from ..session import durable, read_if_exists, temporary_stages
from ..sinks.upsert import first_wins
from ..sources.tail import GrowingTextFiles
from .state import read_state, replace_batch, write_state

ENVELOPE = ["topic", "partition", "offset"]


# ------------------------------------------------------------------ sources

def kafka_source(spark: SparkSession, servers: str, topic: str = C.STREAM_TOPIC,
                 starting_offsets: str = "latest", **options) -> DataFrame:
    """Subscribe to the readings topic."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def file_source(spark: SparkSession, landing: str, *, max_files_per_trigger: int | None = None,
                topic: str = C.STREAM_TOPIC) -> DataFrame:
    """Stand-in for the topic: each line of each new file is one message."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(landing).select(
        F.col("value"), F.lit(topic).alias("topic"), F.lit(None).cast("int").alias("partition"),
        F.lit(None).cast("long").alias("offset"))


# The simulator's columns, in file order, with the event id that ours carry
SIMULATOR_COLUMNS = ["sensor_id", "timestamp", "temperature", "humidity", "is_faulty", "fault_type", "source", "event_id"]


def _simulator_readings(text: DataFrame) -> DataFrame:
    """Typed columns from the simulator's text ones; what cannot be read is NULL."""
    return text.select(
        F.col("event_id").try_cast("long").alias("event_id"),
        "sensor_id",
        F.col("timestamp").try_cast("timestamp").alias("timestamp"),
        F.col("temperature").try_cast("double").alias("temperature"),
        F.col("humidity").try_cast("double").alias("humidity"),
        F.col("is_faulty").try_cast("boolean").alias("is_faulty"),
        "fault_type",
        "source",
    )


def csv_file_source(spark: SparkSession, folder: str, *, max_files_per_trigger: int | None = 1) -> DataFrame:
    """S9, file by file: the simulator's CSV where each file is one unit of
    arrival (the checkpoint replaces an offset file). An empty field is NULL: CSV
    cannot tell NULL from '', and an empty sensor id is a missing one (the
    simulator's ``missing_sensor_id`` fault)."""
    from pyspark.sql.types import StringType, StructField, StructType
    schema = StructType([StructField(n, StringType(), True) for n in SIMULATOR_COLUMNS])
    r = spark.readStream.schema(schema).option("header", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return _simulator_readings(r.csv(folder))


def csv_tail_source(spark: SparkSession, folder: str, *, header: bool = True, range_bytes: int | None = None) -> DataFrame:
    """S9, line by line: the simulator's CSV files while they grow; complete new
    lines only. A field cannot hold a line end. ``header``: the first line of each
    file is one."""
    spark.dataSource.register(GrowingTextFiles)
    r = spark.readStream.format(GrowingTextFiles.name()).option("path", folder).option("ending", ".csv")
    lines = (r if range_bytes is None else r.option("range_bytes", range_bytes)).load()
    if header:
        lines = lines.filter(F.col("position") > 0)
    parsed = F.from_csv("value", ", ".join(f"{c} string" for c in SIMULATOR_COLUMNS))
    return _simulator_readings(lines.select(parsed.alias("_r")).select("_r.*"))


# ------------------------------------------------------------------ decode / parse

def decode(messages: DataFrame) -> DataFrame:
    """Message bytes -> text, keeping the envelope."""
    return messages.select(F.col("value").cast("string").alias("value"), *ENVELOPE)


def _to_bool(c: Column) -> Column:
    return F.lower(c).try_cast("boolean")


def parse(decoded: DataFrame, *, strict: bool = False) -> DataFrame:
    """JSON text -> typed reading + envelope + raw ``value``.

    Numbers are read as text and try_cast, so a producer that quotes every
    field still yields numbers (``strict=True`` reads them with numeric types,
    turning quoted numbers into NULL). Event time is parsed with try_cast:
    empty or malformed text becomes NULL and the row is rejected with
    'Timestamp is missing' instead of failing the query. Malformed JSON gives
    an all-NULL reading; its raw text stays in ``value``."""
    schema = STREAM_VALUE_STRICT if strict else STREAM_VALUE_TEXT
    d = decoded.select(F.from_json("value", schema).alias("d"), "value", *ENVELOPE)
    eid, t, h, flag = (F.col(f"d.{c}") for c in ("event_id", "temperature", "humidity", "is_faulty"))
    if not strict:
        eid, t, h, flag = eid.try_cast("long"), t.try_cast("double"), h.try_cast("double"), _to_bool(flag)
    return d.select(
        eid.alias("event_id"),
        F.col("d.sensor_id").alias("sensor_id"),
        F.col("d.timestamp").try_cast("timestamp").alias("timestamp"),
        t.alias("temperature"), h.alias("humidity"), flag.alias("is_faulty"),
        F.col("d.fault_type").alias("fault_type"),
        F.col("d.source").alias("source"),
        "value", *ENVELOPE,
    )


def parse_messages(messages: DataFrame, *, strict: bool = False) -> DataFrame:
    return parse(decode(messages), strict=strict)


# ------------------------------------------------------------------ branches

def split_stream(parsed: DataFrame, *, blank: str = "exact_space") -> tuple[DataFrame, DataFrame]:
    """The batch validation rules, unchanged (they are stateless)."""
    return validate_reading(parsed, blank)


def collapse_repeats(rows: DataFrame, keys=C.STREAM_DEDUP_KEYS) -> DataFrame:
    """Drops repeats of a key inside each Arrow batch of each task (the first row
    stays): no state and no shuffle, so it works on a stream before the
    operator that has both, and a key that floods a micro-batch gets there as
    one row per batch of a task."""
    names = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch]).select(names).append_column("_at", pa.array(range(batch.num_rows), pa.int64()))
            first = table.group_by(names).aggregate([("_at", "min")])["_at_min"]
            yield batch.take(first.combine_chunks().sort())
    return rows.mapInArrow(run, rows.schema)


def deduplicate(valid: DataFrame, *, delay: str = C.WATERMARK_DELAY,
                keys=C.STREAM_DEDUP_KEYS, mode: str = "state", collapse: bool = False) -> DataFrame:
    """Watermark on event time, then drop repeats of (sensor_id,
    timestamp, source). Rows older than the watermark are dropped; the state
    for a key is removed once the watermark passes its event time.

    ``mode="state"`` (default): the native deduplication operator; a row is
    emitted as soon as it first arrives. ``mode="aggregate"``: a windowless
    streaming aggregation keeping the first row per key (``min_by`` on
    ``event_id``), emitted in append mode once the watermark passes the key's
    event time. It aggregates partially before the shuffle, so a key repeated
    millions of times in one micro-batch reaches its task as one row per map
    task; the price is output delayed by the watermark.

    ``collapse``: repeats inside a task's Arrow batches go first
    (``collapse_repeats``), for hot keys without that delay."""
    w = (collapse_repeats(valid, keys) if collapse else valid).withWatermark("timestamp", delay)
    if mode == "state":
        return w.dropDuplicates(list(keys))
    others = [c for c in valid.columns if c not in keys]
    order = F.struct(F.coalesce(F.col("event_id"), F.lit(0)).alias("k")) if "event_id" in valid.columns \
        else F.struct(F.lit(0).alias("k"))
    picked = w.groupBy(*keys).agg(F.min_by(F.struct(*others), order).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*valid.columns)


def observe_quality(parsed: DataFrame, name: str = "etl_quality") -> DataFrame:
    """B11 on a stream: per micro-batch row, valid and invalid counts and one
    count per rule, reported in ``StreamingQueryProgress.observedMetrics``
    (computed while the batch flows through, no extra pass)."""
    metrics = [F.count(F.lit(1)).alias("rows"), F.count_if(is_valid()).alias("valid_rows"),
               F.count_if(~is_valid()).alias("invalid_rows")]
    metrics += [F.count_if(r.isNotNull()).alias(n) for r, n in zip(reason_columns(), RULE_NAMES)]
    return parsed.observe(name, *metrics)


# ------------------------------------------------------------------ sinks

def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str):
    """S11 on the bus: publish readings as JSON values (no message key)."""
    from ..sinks.files import readings_to_json_value
    return (readings_to_json_value(df).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint))


def start_parquet(df: DataFrame, path: str | None, checkpoint: str, *, available_now: bool = False,
                  processing_time: str | None = None, partition_by: list[str] | None = None,
                  name: str | None = None, fmt: str = "parquet") -> StreamingQuery:
    """Checkpointed append sink. ``fmt`` is ``parquet`` (default; idempotent
    on replay), ``console`` (K5, for watching) or ``memory`` (tests; needs
    ``name``)."""
    w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if fmt == "console":
        w = w.option("truncate", False)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start(path) if path and fmt == "parquet" else w.start()


def accept(rows: DataFrame, batch_id: int, out_dir: str, *, delay_seconds: int, keys) -> tuple[DataFrame, DataFrame]:
    """(accepted, late) rows of one micro-batch of valid readings, with the native
    operator's thresholds: rows at or before the watermark (the newest event time
    of the batches up to two before, minus the delay) are late; the others are
    deduplicated against themselves and against the accepted keys after the
    watermark. Only those keys and the newest event times are carried on, so a
    batch reads no history."""
    spark = rows.sparkSession
    marks = read_state(spark, f"{out_dir}/_marks", batch_id)
    seen = read_state(spark, f"{out_dir}/_keys", batch_id)
    mark = marks.first() if marks is not None else {"newest": None, "before": None}
    wm = mark["before"] - _dt.timedelta(seconds=delay_seconds) if mark["before"] is not None else None
    is_late = F.lit(False) if wm is None else (F.col("timestamp") <= F.lit(wm))
    fresh = first_wins(rows.filter(~is_late), keys, [F.col("event_id")] if "event_id" in rows.columns else None)
    if seen is not None:
        if wm is not None:
            seen = seen.filter(F.col("timestamp") > F.lit(wm))
        old = seen.select(*[F.col(k).alias(f"_seen_{k}") for k in keys])
        same = [fresh[k].eqNullSafe(old[f"_seen_{k}"]) for k in keys]      # nulls are equal, as in dropDuplicates
        fresh = fresh.join(old, reduce(and_, same), "left_anti")
    fresh = durable(fresh, "accepted")
    accepted = fresh.select(*keys)
    write_state(accepted if seen is None else seen.unionByName(accepted), f"{out_dir}/_keys", batch_id)
    newest = [t for t in (mark["newest"], rows.agg(F.max("timestamp")).first()[0]) if t is not None]
    write_state(spark.createDataFrame([(max(newest, default=None), mark["newest"])],
                                      "newest timestamp, before timestamp"), f"{out_dir}/_marks", batch_id)
    return fresh, rows.filter(is_late)


SINKS = ("raw", "valid", "invalid", "late")
COMMIT_SCHEMA = ("batch_id long, rows long, valid_rows long, invalid_rows long, accepted_rows long, late_rows long, "
                 "duplicate_rows long, " + ", ".join(f"{n} long" for n in RULE_NAMES) + ", newest timestamp, committed_at timestamp")


def consumer_batch(parsed: DataFrame, batch_id: int, out_dir: str, *, delay_seconds: int = C.WATERMARK_SECONDS,
                   keys=C.STREAM_DEDUP_KEYS, keep_late: bool = False) -> None:
    """One micro-batch of parsed messages into all tables of the consumer. The
    source is read once, into a stage; the tables are written from that, each
    batch replacing its own rows, and the batch's record in ``_commits`` comes
    last. A batch that failed anywhere before runs again and replaces what it had
    written; ``read_consumer`` shows committed batches only."""
    spark = parsed.sparkSession
    with temporary_stages(spark):
        rows = durable(parsed.withColumns({"ingested_at": F.current_timestamp(), "batch_id": F.lit(batch_id).cast("long")}),
                       "consumer-batch")
        valid, invalid = split_stream(rows)
        kept = [*READING_COLUMNS, "is_faulty", "fault_type", *ENVELOPE, "batch_id"]
        accepted, late = accept(valid.select(*kept), batch_id, out_dir, delay_seconds=delay_seconds, keys=keys)
        replace_batch(rows.select("value", *ENVELOPE, "ingested_at", "batch_id"), f"{out_dir}/raw")         # B1
        replace_batch(accepted, f"{out_dir}/valid")
        replace_batch(invalid.drop("ingested_at"), f"{out_dir}/invalid")                                    # B3
        if keep_late:
            replace_batch(late, f"{out_dir}/late")                                                          # B4
        broken = [F.count_if(r.isNotNull()).alias(n) for r, n in zip(reason_columns(), RULE_NAMES)]
        seen = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(is_valid()).alias("valid_rows"), *broken,
                        F.max("timestamp").alias("newest")).first()
        n_accepted, n_late = accepted.count(), late.count()
        record = {"batch_id": batch_id, "rows": seen["rows"], "valid_rows": seen["valid_rows"],
                  "invalid_rows": seen["rows"] - seen["valid_rows"], "accepted_rows": n_accepted, "late_rows": n_late,
                  "duplicate_rows": seen["valid_rows"] - n_accepted - n_late, **{n: seen[n] for n in RULE_NAMES},
                  "newest": seen["newest"], "committed_at": _dt.datetime.now(_dt.timezone.utc)}
        spark.createDataFrame([tuple(record.values())], COMMIT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
            f"{out_dir}/_commits/{batch_id}")


def consumer_commits(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """One row per committed micro-batch: rows in, valid, invalid, accepted,
    late, duplicate and per-rule counts, newest event time, commit time."""
    return read_if_exists(spark, f"{out_dir}/_commits/*")


def read_consumer(spark: SparkSession, out_dir: str, sink: str) -> DataFrame | None:
    """A table of the consumer (one of ``SINKS``), committed batches only."""
    rows, commits = read_if_exists(spark, f"{out_dir}/{sink}"), consumer_commits(spark, out_dir)
    if rows is None or commits is None:
        return None
    last = commits.agg(F.max("batch_id")).first()[0]
    return rows.filter(F.col("batch_id") <= last)


def run_consumer(messages: DataFrame, out_dir: str, *, available_now: bool = False,
                 processing_time: str | None = None, strict: bool = False, keep_late: bool = False) -> StreamingQuery:
    """T4: the full consumer as one query that reads its source once: raw messages
    (B1, with ingestion time), deduplicated valid readings, rejects with reasons
    and the raw message (B3), and with ``keep_late`` the rows behind the watermark (B4)."""
    parsed = observe_quality(parse_messages(messages, strict=strict))
    w = parsed.writeStream.option("checkpointLocation", f"{out_dir}/_checkpoint").foreachBatch(
        lambda df, batch_id: consumer_batch(df, batch_id, out_dir, keep_late=keep_late))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def await_all(queries: list[StreamingQuery]) -> None:
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))


# ------------------------------------------------------------------ late rows

def quarantine_batch(batch: DataFrame, batch_id: int, out_dir: str, *, delay_seconds: int = C.WATERMARK_SECONDS,
                     keys=C.STREAM_DEDUP_KEYS) -> None:
    """One micro-batch of the quarantine policy: accepted rows go to ``valid/``, late
    ones to ``late/`` instead of being dropped. A retried batch replaces its own output."""
    with temporary_stages(batch.sparkSession):
        rows = durable(batch.withColumn("batch_id", F.lit(batch_id).cast("long")), "quarantine-batch")
        fresh, late = accept(rows, batch_id, out_dir, delay_seconds=delay_seconds, keys=keys)
        replace_batch(fresh, f"{out_dir}/valid")
        replace_batch(late, f"{out_dir}/late")


def quarantine_quality(spark: SparkSession, out_dir: str) -> DataFrame:
    """Accepted and late rows of a quarantine run, and the late rate."""
    parts = [(read_if_exists(spark, f"{out_dir}/{name}"), name == "late") for name in ("valid", "late")]
    counted = [t.select(F.lit(is_late).alias("late")) for t, is_late in parts if t is not None]
    counted = reduce(DataFrame.unionByName, counted, spark.createDataFrame([], "late boolean"))
    return counted.agg(F.count_if(~F.col("late")).alias("accepted_rows"), F.count_if("late").alias("late_rows")) \
        .withColumn("late_rate", F.try_divide(F.col("late_rows"), F.col("accepted_rows") + F.col("late_rows")))


def run_quarantine(messages: DataFrame, out_dir: str, *, delay_seconds: int = C.WATERMARK_SECONDS,
                   available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """The consumer's valid branch with late rows kept (``late/``)
    instead of dropped silently. Rejects are not part of this query."""
    valid, _ = split_stream(parse_messages(messages))
    valid = valid.select(*READING_COLUMNS)
    w = valid.writeStream.option("checkpointLocation", f"{out_dir}/_checkpoint").foreachBatch(
        lambda df, bid: quarantine_batch(df, bid, out_dir, delay_seconds=delay_seconds))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
