"""Insert-or-ignore stores keyed by (sensor_id, timestamp).

A stored row always wins; within one batch the first row of a key wins, where
"first" is the batch loader's union order (csv, api, database), then
``event_id``. ``upsert`` is idempotent on rerun. Single writer: two concurrent
writers could both insert the same new key.

A store is a Parquet folder (optionally partitioned) whose files are bucketed and
sorted by the key; the number of buckets is fixed when the store is created and
kept beside it. The anti-join then reads the store where it lies: only the batch
is shuffled, into as many partitions as there are buckets, however large the
store has become. Any reader may read the folder as plain Parquet.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..session import durable, read_if_exists
from ..sources.folder import open_folder

KEY = ("sensor_id", "timestamp")
BUCKETS = 16             # about the store's final size / 256 MB; partitioned stores have as many in each partition
_LAYOUT = "_layout.json"


def source_rank(col: str = "source", order=C.SOURCE_PRIORITY) -> Column:
    """Position of ``source`` in the union order; unknown sources rank last."""
    pos = F.array_position(F.array(*[F.lit(s) for s in order]), F.col(col))
    return F.when(pos > 0, pos).otherwise(F.lit(len(order) + 1)).cast("int")


def first_wins(batch: DataFrame, keys=KEY, priority: list[Column] | None = None) -> DataFrame:
    """One row per key: the one with the smallest ``priority``. An aggregation
    (``min_by`` over a struct), so duplicates collapse map-side before the
    shuffle and no key's rows are sorted as a group."""
    if priority is None:
        if "event_id" not in batch.columns:
            raise ValueError("rows need event_id, or a priority: without one, ties inside a source have no order")
        priority = [source_rank(), F.col("event_id")]
    cols = [c for c in batch.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in cols])
    picked = batch.groupBy(*keys).agg(F.min_by(row, F.struct(*priority)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in cols]).select(*batch.columns)


def with_event_date(df: DataFrame) -> DataFrame:
    """Adds the store's partition column (UTC date of the reading)."""
    return df.withColumn("event_date", F.to_date("timestamp"))


def read_store(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    return read_if_exists(spark, path, schema)


def _layout(path: str) -> dict | None:
    """How the store was created; None for a folder that this module did not create."""
    files, root = open_folder(path)
    if files.get_file_info(f"{root}/{_LAYOUT}").size is None:
        return None
    with files.open_input_stream(f"{root}/{_LAYOUT}") as f:
        return json.loads(f.read())


def create_store(path: str, schema, keys=KEY, *, partition_by: list[str] | None = None, buckets: int = BUCKETS) -> dict:
    """Writes the layout of a new store (columns in the order of ``schema``)."""
    layout = {"keys": list(keys), "buckets": buckets, "partition_by": list(partition_by or []),
              "columns": [[f.name, f.dataType.simpleString()] for f in schema.fields]}
    files, root = open_folder(path)
    files.create_dir(root, recursive=True)
    with files.open_output_stream(f"{root}/{_LAYOUT}", compression=None) as f:
        f.write(json.dumps(layout).encode())
    return layout


def store_table(spark: SparkSession, path: str, layout: dict) -> str:
    """The session's table over a store, which tells Spark how its files are
    bucketed. Only a name: the folder is the store."""
    name = f"store_{hashlib.md5(path.encode()).hexdigest()[:20]}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{c}` {t}" for c, t in layout["columns"])
        keys = ", ".join(f"`{k}`" for k in layout["keys"])
        parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in layout['partition_by'])})" if layout["partition_by"] else ""
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {parts} CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                  f"INTO {layout['buckets']} BUCKETS LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    return name


def not_stored(fresh: DataFrame, store: DataFrame, keys=KEY) -> DataFrame:
    """The rows of a stored batch whose key the store does not have. The store is
    read at the batch's own dates (a semi-join that prunes partitions at run
    time), or inside its [min, max] timestamp."""
    if "event_date" in store.columns:
        dates = fresh.select(F.to_date("timestamp").alias("event_date")).distinct()
        store = store.join(dates, "event_date", "left_semi")
    else:
        lo, hi = fresh.agg(F.min("timestamp"), F.max("timestamp")).first()
        store = store.filter(F.col("timestamp").between(F.lit(lo), F.lit(hi)))
    return fresh.join(store.select(*keys), list(keys), "left_anti")


def upsert(store_path: str, batch: DataFrame, keys=KEY, *, partition_by: list[str] | None = None,
           priority: list[Column] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Appends the batch's new keys to the store; returns the rows appended
    (a lazy view over what was written is not kept: re-read the store). A bucket's
    new rows are written by one task for each partition: one file per bucket and
    partition that the batch touches."""
    spark = batch.sparkSession
    # the batch is read more than once (bounds, anti-join): materialise it
    fresh = durable(first_wins(batch, keys, priority), "upsert-batch")
    layout = _layout(store_path)
    if layout is None:
        layout = create_store(store_path, fresh.schema, keys, partition_by=partition_by, buckets=buckets)
    elif layout["keys"] != list(keys) or layout["partition_by"] != list(partition_by or []):
        raise ValueError(f"{store_path} is keyed by {layout['keys']} and partitioned by {layout['partition_by']}")
    table = store_table(spark, store_path, layout)
    fresh = not_stored(fresh, spark.table(table), keys)
    order = [c for c, _ in layout["columns"] if c not in layout["partition_by"]] + layout["partition_by"]
    # hash partitions equal the buckets
    fresh.select(*order).repartition(layout["buckets"], *keys).write.insertInto(table)
    return fresh
