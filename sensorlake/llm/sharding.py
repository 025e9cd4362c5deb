"""Sharding (operator 9): minimax contiguous partition of atomic groups.

Rows with equal text are one group and stay together. The groups are put in
order of their text's SHA-256, and their running byte sums are stored as a
table. The smallest capacity with which a greedy fill needs at most ``shards``
shards is found by searching between two proven bounds; each pass over the
running sums tests many capacities at once (the greedy step for a capacity is
one ``max`` over the sums it can reach). Then the order is cut: each cut is the
boundary nearest to an even share of what is left, among those from which the
rest still fits the capacity. A shard is so a range of digests, and a row finds
it by comparing its own digest with the cuts: no join, whatever a text's share
of the rows.

Only DataFrame functions are used. Law: ``bytes``. Defined cases: null text
counts as empty (size 1, CRC 0); null ids are numbered like any other; an
empty table gives no rows; with fewer groups than shards some shards are empty;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.sequence import sequence_index
from ..session import durable
from . import common

SHARDS = 8
PROBES = 24          # capacities tested in one pass


def running_sums(groups: DataFrame) -> DataFrame:
    """Adds ``upto``, the sum of ``bytes`` up to and including each row in
    order of ``g``, without a global window: sums inside range partitions plus
    the totals of the partitions before (one row each)."""
    laid = durable(groups.repartitionByRange("g").sortWithinPartitions("g")
                   .withColumn("_part", F.spark_partition_id()), "groups")
    parts = laid.groupBy("_part").agg(F.sum("bytes").alias("_bytes"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_base"))
    inside = F.sum("bytes").over(Window.partitionBy("_part").orderBy("g"))
    return durable(laid.withColumn("_upto", inside).join(parts, "_part")
                   .select("g", "bytes", (F.col("_base") + F.col("_upto")).cast("long").alias("upto")), "sums")


def _fill(sums: DataFrame, starts: list[int], capacities: list[int]) -> list[int]:
    """For each start, the furthest boundary that its capacity reaches."""
    ends = [s + c for s, c in zip(starts, capacities)]
    reach = sums.filter((F.col("upto") > min(starts)) & (F.col("upto") <= max(ends))).agg(*[
        F.max(F.when(F.col("upto") <= e, F.col("upto"))).alias(f"e{i}") for i, e in enumerate(ends)]).first()
    return [max(s, r or 0) for s, r in zip(starts, reach)]


def smallest_capacity(sums: DataFrame, total: int, largest: int, shards: int, probes: int = PROBES) -> int:
    """The least capacity with which a greedy fill needs at most ``shards``."""
    low = max(-(-total // shards), largest)
    high = low + largest            # every shard but the last then holds total / shards or more
    while low < high:
        step = max(1, -(-(high - low) // probes))
        tried = list(range(low, high, step))
        at = [0] * len(tried)
        for _ in range(shards):
            at = _fill(sums, at, tried)
            if min(at) >= total:
                break
        fits = [i for i, x in enumerate(at) if x >= total]
        if not fits:
            low = tried[-1] + 1
        else:
            high = tried[fits[0]]
            low = tried[fits[0] - 1] + 1 if fits[0] else high
    return high


def cuts(sums: DataFrame, total: int, capacity: int, shards: int) -> list[tuple[int, bytes | None]]:
    """Running sum and digest at the end of shards 0 .. shards-2."""
    latest = [total]                # the least boundary from which the rest fits
    for _ in range(shards - 1):
        need = latest[-1] - capacity
        got = 0 if need <= 0 else sums.filter(F.col("upto") >= need).agg(F.min("upto")).first()[0]
        latest.append(got)
    latest = latest[::-1]
    out, at = [], 0
    for i in range(1, shards):
        ideal = at + (total - at) // (shards - i + 1)
        least, most = max(latest[i - 1], at), at + capacity
        row = sums.filter((F.col("upto") >= least) & (F.col("upto") <= most)).agg(
            F.max(F.when(F.col("upto") <= ideal, F.struct("upto", "g"))).alias("a"),
            F.min(F.when(F.col("upto") > ideal, F.struct("upto", "g"))).alias("b")).first()
        near = [(x["upto"], bytes(x["g"])) for x in (row["a"], row["b"]) if x is not None]
        if least <= at:             # an empty shard is allowed
            near.append((at, out[-1][1] if out else None))
        near.sort(key=lambda x: abs(x[0] - ideal))
        out.append(near[0])
        at = near[0][0]
    return out


def shard(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row per document: id, ``size``, ``text_crc32``, ``law``, ``shard``,
    ``slot``, ``grown_shard``."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = durable(docs.select(
        F.col(id_col), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("g")), "texts")
    groups = rows.groupBy("g").agg(F.sum("size").alias("bytes"))
    sums = running_sums(groups)
    total, largest = sums.agg(F.sum("bytes"), F.max("bytes")).first()
    ends = cuts(sums, total, smallest_capacity(sums, total, largest, shards), shards) if total else []
    number = F.lit(0)
    for _, digest in ends:
        number = number + (F.lit(1) if digest is None else F.when(F.col("g") > F.lit(digest), 1).otherwise(0))
    dealt = rows.withColumn("shard", number.cast("int"))
    return sequence_index(dealt, ["shard"], ["g", id_col]).select(
        id_col, "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("seq") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 of nearly equal bytes."""
    common.prepare(spark)
    return shard(common.documents(spark, sf_dir))
