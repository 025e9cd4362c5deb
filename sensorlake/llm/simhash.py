"""SimHash near-dedup (operator 2): covering locality-sensitive hashing.

* Fingerprint: XXH64 of every shingle of ``shingle`` lower-cased words; a bit
  is 1 if it is set in over half of them.
* Candidates: with radius r, bit i gets a non-zero vector phi(i) of r+1 bits,
  and each non-zero vector v a mask of the bits with <phi(i), v> = 1. Two
  fingerprints that differ in at most r bits give at most r linear equations in
  r+1 unknowns, so some v != 0 solves them all: the pair agrees on that mask.
  2^(r+1)-1 tables therefore find every pair, not most of them. A bucket has at
  most one row of each fingerprint, so no bucket exceeds 1/31 of all rows.
* Buckets are read as sorted streams, one at a time; links are local stars, so
  m linked members give m-1 rows, never m^2. A bucket of more than
  ``bucket_rows`` distinct fingerprints is dealt again, exactly: the bits
  outside its mask are split into r+1 blocks, of which a pair within the radius
  agrees on at least one, and (mask + block) are new, smaller buckets. Free
  bits run out, so this ends; nothing is capped.
* Components: large-star / small-star rounds on the fingerprints, each round
  written to the shared work folder, until nothing changes.

Defined cases: null text, text without words: fingerprint zero, linked like any
other. Repeated rows share a fingerprint and a component. A null id is never a
component's name unless all its ids are null (then null); null-id rows still
link others. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable
from . import common

SHINGLE = 4
RADIUS = 4
SEED = 42
BUCKET_ROWS = 4096
HOT = 1024                    # a fingerprint of more than 1/HOT of all rows is hot
_BLOCK = 1 << 15              # shingles hashed at a time


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a whole text."""
    from xxhash import xxh64_intdigest as digest
    words = common.word_bytes(text).lower().split()     # bytes: A-Z only; \x20 and \x09-\x0D
    if not words:
        return 0
    if len(words) <= shingle:
        return digest(b" ".join(words), SEED)           # one hash: over half means its own bits
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), "int64", len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), "int64", len(words)) - 1).tolist()
    stops = (ends - 1).tolist()[shingle - 1:]
    ones = np.zeros(64, "int64")
    for at in range(0, len(stops), _BLOCK):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[at:at + _BLOCK], stops[at:at + _BLOCK])]
        bits = np.unpackbits(np.array(hashes, "<u8").view("uint8").reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype="int64")
    return int(np.packbits(2 * ones > len(stops), bitorder="little").view("<u8")[0])


def fingerprint_column(shingle: int = SHINGLE):
    """UDF: text -> struct(fingerprint as a signed long)."""
    def make():
        def score(texts):
            found = np.array([fingerprint(t, shingle) for t in texts], "uint64")
            return {"fp": found.view("int64")}
        return score
    return common.per_text("fp long", make)


def covering_masks(radius: int) -> list[int]:
    """The 2^(radius+1)-1 masks, as signed longs."""
    vectors = (1 << (radius + 1)) - 1
    phi = [i % vectors + 1 for i in range(64)]
    masks = [sum(1 << i for i in range(64) if (phi[i] & v).bit_count() % 2) for v in range(1, vectors + 1)]
    return np.array(masks, "uint64").view("int64").tolist()


def finer_masks(mask: int, radius: int) -> list[int]:
    """``mask`` plus each of radius+1 blocks of the bits outside it."""
    mask &= (1 << 64) - 1
    free = [i for i in range(64) if not mask >> i & 1]
    parts = [mask | sum(1 << i for i in free[k::radius + 1]) for k in range(radius + 1)]
    return np.array(parts, "uint64").view("int64").tolist()


def local_stars(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(member, root) for every fingerprint of a bucket that is linked, over
    any number of steps inside the bucket, to the root of its component."""
    links: list[tuple[int, int]] = []
    left = fps.view("uint64")
    while len(left) > 1:
        root, left = left[0], left[1:]
        frontier = [root]
        while frontier and len(left):
            at = frontier.pop()
            near = np.bitwise_count(left ^ at) <= radius
            if near.any():
                found = left[near]
                left = left[~near]
                frontier.extend(found)
                links.extend((int(x.view("int64")), int(root.view("int64"))) for x in found)
    return links


def _bucket_links(radius: int, bucket_rows: int):
    """Streams (mask, fp) sorted by (mask, fp & mask); gives links (a, b) and,
    for buckets that are too large, the rows of the finer ones (mask, a)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(mask, a, b):
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (mask, a, b)], names=["mask", "a", "b"])

        def finer(mask, fps):
            for m in finer_masks(mask, radius):
                yield out(np.full(len(fps), m), fps, np.zeros(len(fps), "int64"))

        held: list[np.ndarray] = []        # the open bucket's rows so far
        rows, bucket, too_large = 0, None, False

        def close():
            if not too_large and rows > 1:
                links = local_stars(np.concatenate(held), radius)
                if links:
                    a, b = zip(*links)
                    yield out([None] * len(a), a, b)

        for batch in batches:
            mask = batch.column(0).to_numpy()
            fp = batch.column(1).to_numpy()
            key = mask & fp
            cuts = np.flatnonzero((np.diff(mask) != 0) | (np.diff(key) != 0)) + 1
            bounds = np.array([0, *cuts, len(fp)])
            # a bucket that starts and ends inside the batch with one row has no pair
            worth = np.diff(bounds) > 1
            worth[[0, -1]] = len(fp) > 0
            for i in np.flatnonzero(worth).tolist():
                s, e = int(bounds[i]), int(bounds[i + 1])
                here = (int(mask[s]), int(key[s]))
                if here != bucket:
                    yield from close()
                    held, rows, bucket, too_large = [], 0, here, False
                rows += e - s
                if too_large:
                    yield from finer(here[0], fp[s:e])
                    continue
                held.append(fp[s:e])
                free = 64 - (here[0] & ((1 << 64) - 1)).bit_count()
                if rows > bucket_rows and free > radius + 1:
                    too_large = True
                    yield from finer(here[0], np.concatenate(held))
                    held = []
        yield from close()
    return run


def find_links(fps: DataFrame, *, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) whose closure
    has the components of all pairs within ``radius`` bits."""
    rows = fps.select(F.explode(F.array(*[F.lit(m) for m in covering_masks(radius)])).alias("mask"), "fp")
    found = None
    while True:
        dealt = (rows.withColumn("_key", F.col("mask").bitwiseAND(F.col("fp")))
                 .repartition("mask", "_key").sortWithinPartitions("mask", "_key").select("mask", "fp"))
        step = durable(dealt.mapInArrow(_bucket_links(radius, bucket_rows), "mask long, a long, b long"), "links")
        links = step.filter(F.col("mask").isNull()).select("a", "b")
        found = links if found is None else found.unionByName(links)
        rows = step.filter(F.col("mask").isNotNull()).select("mask", F.col("a").alias("fp"))
        if rows.isEmpty():
            return found.distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): the root is the
    smallest node of its connected component."""
    def ordered(df):
        return (df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .filter(F.col("a") != F.col("b")).distinct())

    def state(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = durable(ordered(links), "edges")
    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.filter(F.col("b") > F.col("a")).join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = durable(ordered(small.select("a", F.col("m").alias("b"))
                                .unionByName(small.select(F.col("b").alias("a"), F.col("m").alias("b")))), "edges")
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def component_ids(marked: DataFrame, id_col: str, *, radius: int = RADIUS,
                  bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(``_fp``, ``component_id``, ``n`` rows) for every distinct ``fp`` of a stored
    frame with ``id_col`` and ``fp``."""
    first = durable(marked.groupBy("fp").agg(F.min(id_col).alias("first_id"), F.count(F.lit(1)).alias("n")), "fingerprints")
    member = durable(components(find_links(first.select("fp"), radius=radius, bucket_rows=bucket_rows)), "members")
    named = member.join(first, member["node"] == first["fp"]).groupBy("root").agg(F.min("first_id").alias("least_id"))
    of_fp = member.join(named, "root").select(F.col("node").alias("_node"), "least_id")
    return (first.join(of_fp, first["fp"] == of_fp["_node"], "left")
            .select(F.col("fp").alias("_fp"), F.coalesce("least_id", "first_id").alias("component_id"), "n"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits) and
    ``component_id`` (smallest id reachable over links)."""
    marked = durable(common.with_fields(docs, [id_col], text_col, fingerprint_column(shingle), ["fp"]), "simhash")
    of_fp = durable(component_ids(marked, id_col, radius=radius, bucket_rows=bucket_rows), "components")
    # fingerprints that hold over a thousandth of all rows each: fewer than HOT of them, so
    # they are broadcast and their rows stay where they are
    total = of_fp.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(of_fp.filter(F.col("n") * HOT > total).select(F.col("_fp").alias("fp"), "component_id"))
    cold = marked.join(hot.select("fp"), "fp", "left_anti").join(of_fp, F.col("fp") == F.col("_fp"))
    columns = [id_col, "fp", "component_id"]
    named = marked.join(hot, "fp").select(*columns).unionByName(cold.select(*columns))
    return named.select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                     radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest
    id (one row of it, if the row repeats). A component without any id keeps
    one row of each of its fingerprints. Columns are those of ``docs``."""
    # the document travels as one column, so its own names cannot clash with ours
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    ident = F.coalesce(F.concat(F.lit("="), F.col(f"`{id_col}`").cast("string")), F.lit(""))
    marked = durable(docs.select(F.col(f"`{id_col}`").alias("_id"), ident.alias("_ident"),
                                 fingerprint_column(shingle)(F.col(f"`{text_col}`"))["fp"].alias("_fp"), row.alias("_row")), "simhash")
    named = component_ids(marked.select("_id", F.col("_fp").alias("fp")), "_id", radius=radius, bucket_rows=bucket_rows)
    named = named.select(F.col("_fp").alias("_named_fp"),
                         F.coalesce(F.concat(F.lit("="), F.col("component_id").cast("string")), F.lit("")).alias("_named"))
    # plain equality on two columns: the join and the removal of repeats use one exchange
    kept = marked.join(named, (marked["_ident"] == named["_named"]) & (marked["_fp"] == named["_named_fp"]), "left_semi")
    kept = kept.dropDuplicates(["_ident", "_fp"])
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies of all documents: 4-word shingles, at most 4 bits apart."""
    common.prepare(spark)
    return near_duplicates(common.documents(spark, sf_dir))
