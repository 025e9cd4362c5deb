"""Hard-negative mining (operator 13): LEMP-style coordinate pruning.

* Vectors become integers, are numbered from long to short (an exact distributed
  numbering) and cut into length buckets of ``bucket_rows``. Buckets are dealt
  in turn to stripes, so every stripe goes from long to short. The query set
  (anchors) is hashed into blocks. One work unit is a block and a stripe: it
  holds the block's anchors and one bucket at a time, whatever the table's size.
* An anchor asks each bucket for scores of at least a threshold: what its k-th
  best so far has. A bucket whose longest vector cannot reach it ends the stripe
  for that anchor. In other buckets the threshold becomes a least cosine t, and
  a coordinate f of a unit vector at an angle of arccos(t) or less from the
  anchor lies in [cos(a + arccos t), cos(a - arccos t)], where cos(a) is the
  anchor's own coordinate. The bucket's sorted list of coordinate f gives that
  range at two binary searches; the ranges of the anchor's ``focus`` largest
  coordinates are intersected, and what is left is verified by its exact
  integer product.
* The first pass finds each anchor's positives, the second the negatives inside
  each positive's band of scores. Stripes hand on at most k rows for each anchor
  and positive; a window takes the first k of those.

An equal vector held by a third of all rows is spread over buckets like any
other. Defined cases: rows with a null label or vector, or a null or non-finite
component take no part; a null id is never an anchor, keeps its label, and comes
after all ids in ties; rows that repeat an id are rows of their own (each an
anchor, and a positive of its copy); vectors of different length are as if
filled up with zeros; a component whose scaled value is beyond +-2^20 counts as
that bound, so that products are exact; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.sequence import sequence_index
from ..session import durable
from . import common

SCALE = 256
ANCHOR_EVERY = 100
POSITIVES = 5
NEGATIVES = 10
LEAST_PERCENT, MOST_PERCENT = 30, 90
BUCKET_ROWS = 1024
STRIPE_ROWS = 8192
MOST_STRIPES = 1024          # a window group has at most so many times k rows
ANCHOR_BLOCK = 4096
FOCUS = 4
_BOUND = 1 << 20
_SLACK = 1e-9
_LAST_ID = (1 << 63) - 1


def vectors(rows: DataFrame, *, id_col: str, vector_col: str, label_col: str, scale: int = SCALE,
            relabel_every: int = 7, labels: int = 10) -> DataFrame:
    """``_row`` (1 is the longest), ``id``, ``label``, ``v`` (integers) of the
    rows that take part; stored by ``sequence_index``."""
    vec, ident = F.col(f"`{vector_col}`"), F.col(f"`{id_col}`").cast("long")
    whole = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    label = F.col(f"`{label_col}`").cast("long")
    moved = F.when(ident % relabel_every == 0, (label + 1) % labels).otherwise(label)
    held = F.transform(vec, lambda x: F.least(F.greatest(F.floor(F.lit(scale) * x.cast("double")), F.lit(-_BOUND)),
                                              F.lit(_BOUND)).cast("int"))
    kept = (rows.filter(vec.isNotNull() & label.isNotNull()).filter(whole)
            .select(ident.alias("id"), moved.alias("label"), held.alias("v")))
    shorter = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a - x.cast("long") * x.cast("long"))
    return sequence_index(kept.withColumn("_shorter", shorter), [], ["_shorter", "id", "label"], seq_col="_row").drop("_shorter")


# ------------------------------------------------------------ one work unit

def matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """A list column as rows of doubles, filled up with zeros to ``width``."""
    sizes = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten(), "float64")
    most = max(width, int(sizes.max(initial=0)))
    if (sizes == most).all():
        return flat.reshape(len(sizes), most)
    out = np.zeros((len(sizes), most))
    out[np.arange(most) < sizes[:, None]] = flat
    return out


class Bucket:
    """Vectors of similar length; coordinate lists are sorted when first asked for."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.lengths = np.sqrt((rows * rows).sum(axis=1))
        self.longest = float(self.lengths.max(initial=0.0))
        self.unit = rows / np.where(self.lengths > 0, self.lengths, 1.0)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.lists[f] = (order, self.unit[order, f])
        return self.lists[f]

    def candidates(self, unit: np.ndarray, focus: np.ndarray, cosine: float) -> np.ndarray:
        """Rows that may have at least that cosine (above zero) with ``unit``."""
        angle = np.arccos(min(1.0, cosine))
        own = np.arccos(np.clip(unit[focus], -1.0, 1.0))
        low = np.cos(np.minimum(np.pi, own + angle)) - _SLACK
        high = np.cos(np.maximum(0.0, own - angle)) + _SLACK
        ranges = []
        for f, a, b in zip(focus.tolist(), low, high):
            order, values = self.sorted_list(f)
            s, e = np.searchsorted(values, a, side="left"), np.searchsorted(values, b, side="right")
            ranges.append((e - s, s, f, a, b))
        ranges.sort()
        size, s, f, _, _ = ranges[0]
        found = self.sorted_list(f)[0][s:s + size]
        for _, _, f, a, b in ranges[1:]:
            values = self.unit[found, f]
            found = found[(values >= a) & (values <= b)]
        return found

    def reaching(self, vector: np.ndarray, length: float, unit: np.ndarray, focus: np.ndarray,
                 threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """(rows, exact scores) that hold every row with a score of at least ``threshold``."""
        if threshold > 0:
            most = length * self.longest
            if threshold > most * (1 + _SLACK):
                return np.empty(0, "int64"), np.empty(0)
            found = self.candidates(unit, focus, threshold / most)
            return found, self.rows[found] @ vector
        return np.arange(len(self.rows)), self.rows @ vector


class Anchor:
    """One query: its vector, and for each slot the best rows so far as
    (-score, id, id is null), the first k of them. A slot takes scores from
    ``low`` to ``high``; a positive's slot takes the anchor's label, a
    negative's any other."""

    def __init__(self, row: int, label: int, vector: np.ndarray, focus: int, k: int, same: bool,
                 slots: list[tuple[float, float]]):
        self.row, self.label, self.vector, self.k, self.same = row, label, vector, k, same
        self.slots = [x if x[0] <= x[1] else (np.inf, -np.inf) for x in slots]      # an empty band asks for nothing
        self.length = float(np.sqrt((vector * vector).sum()))
        self.unit = vector / (self.length or 1.0)
        self.focus = np.argsort(-np.abs(self.unit), kind="stable")[:focus]
        self.best: list[list[tuple[int, int, bool]]] = [[] for _ in slots]
        self.done = all(low > high for low, high in self.slots)

    def threshold(self) -> float:
        """What a score must reach to matter to any slot (ties may)."""
        return min(-b[-1][0] if len(b) == self.k else low for b, (low, _) in zip(self.best, self.slots))

    def ask(self, bucket: Bucket, rows: np.ndarray, labels: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        least = self.threshold()
        if least > 0 and least > self.length * bucket.longest * (1 + _SLACK):
            self.done = True                    # so are all later buckets: they are shorter
            return
        found, scores = bucket.reaching(self.vector, self.length, self.unit, self.focus, least)
        fits = scores >= least
        fits &= (labels[found] == self.label) == self.same
        if self.same:
            fits &= rows[found] != self.row
        if not fits.any():
            return
        found, scores = found[fits], scores[fits]
        order = np.lexsort((ids[found], -scores))
        found, scores = found[order], scores[order]
        for i, (low, high) in enumerate(self.slots):
            a = np.searchsorted(-scores, -high, side="left")
            b = min(np.searchsorted(-scores, -low, side="right"), a + self.k)
            if a < b:
                new = zip((-scores[a:b]).astype("int64").tolist(), ids[found[a:b]].tolist(), nulls[found[a:b]].tolist())
                self.best[i] = sorted([*self.best[i], *new])[:self.k]


def _work(k: int, same: bool, bucket_rows: int, focus: int):
    """Streams work units: their anchors (``side`` 0), then vectors from long to
    short. Gives each unit's best rows for each anchor and slot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: list[Anchor] = []
        open_unit, pending, held = None, [], 0

        def process(parts: list[pa.RecordBatch]):
            alive = [a for a in anchors if not a.done]
            if not alive:
                return
            chunk = pa.Table.from_batches(parts).combine_chunks()
            rows = matrix(chunk.column("v").combine_chunks(), len(alive[0].vector))
            labels, numbers = chunk.column("label").to_numpy(), chunk.column("_row").to_numpy()
            ids = chunk.column("id").combine_chunks()
            nulls, ids = np.asarray(ids.is_null()), np.asarray(ids.fill_null(_LAST_ID))
            for s in range(0, len(rows), bucket_rows):
                part = slice(s, s + bucket_rows)
                bucket = Bucket(rows[part])
                for a in alive:
                    if a.done:
                        continue
                    if len(a.vector) < rows.shape[1]:
                        a.vector, a.unit = (np.pad(x, (0, rows.shape[1] - len(x))) for x in (a.vector, a.unit))
                    a.ask(bucket, numbers[part], labels[part], ids[part], nulls[part])

        def close():
            if pending:
                process(pending)
            out = [(a.row, i, ident, none, -less) for a in anchors for i, best in enumerate(a.best) for less, ident, none in best]
            if out:
                row, slot, ident, none, score = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row, pa.int64()), pa.array(slot, pa.int32()),
                     pa.array(ident, pa.int64(), mask=np.array(none)), pa.array(score, pa.int64())],
                    names=["anchor_row", "slot", "id", "score"])

        for batch in batches:
            unit = np.stack([batch.column(c).to_numpy() for c in ("block", "stripe", "side")], axis=1)
            cuts = np.flatnonzero((np.diff(unit, axis=0) != 0).any(axis=1)) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(unit)]):
                if s == e:
                    continue
                if (here := tuple(unit[s, :2].tolist())) != open_unit:
                    yield from close()
                    open_unit, anchors, pending, held = here, [], [], 0
                part = batch.slice(s, e - s)
                if unit[s, 2] == 0:
                    m = matrix(part.column("v"))
                    for i, (row, label, slots) in enumerate(zip(*(part.column(c).to_pylist() for c in ("_row", "label", "slots")))):
                        anchors.append(Anchor(row, label, m[i], focus, k, same, [(x["low"], x["high"]) for x in slots]))
                    width = max(len(a.vector) for a in anchors)
                    for a in anchors:
                        a.vector, a.unit = (np.pad(x, (0, width - len(x))) for x in (a.vector, a.unit))
                    continue
                pending.append(part)
                held += e - s
                if held >= bucket_rows:
                    process(pending)
                    pending, held = [], 0
        yield from close()
    return run


# ------------------------------------------------------------ the two passes

def best_rows(rows: DataFrame, anchors: DataFrame, k: int, *, same: bool, stripes: int, blocks: int,
              bucket_rows: int = BUCKET_ROWS, focus: int = FOCUS) -> DataFrame:
    """(``anchor_row``, ``slot``, ``rank``, ``id``, ``score``): the first ``k`` of the
    stored ``rows`` for every slot of every anchor (``_row``, ``label``, ``v``,
    ``slots``: array of low, high)."""
    kind = "array<struct<low:double,high:double>>"
    asked = anchors.select(
        F.pmod(F.xxhash64("_row"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"), F.lit(0).alias("side"),
        "_row", "id", "label", "v", F.col("slots").cast(kind).alias("slots"))
    bucket = F.floor((F.col("_row") - 1) / bucket_rows)
    data = rows.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod(bucket, F.lit(stripes)).cast("int").alias("stripe"), F.lit(1).alias("side"),
        "_row", "id", "label", "v", F.array().cast(kind).alias("slots"))
    # as many partitions as work units: the work follows the units, not their bytes
    dealt = (asked.unionByName(data).repartition(stripes * blocks, "block", "stripe")
             .sortWithinPartitions("block", "stripe", "side", "_row"))
    found = dealt.mapInArrow(_work(k, same, bucket_rows, focus), "anchor_row long, slot int, id long, score long")
    first = Window.partitionBy("anchor_row", "slot").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   anchor_every: int = ANCHOR_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   least_percent: int = LEAST_PERCENT, most_percent: int = MOST_PERCENT, bucket_rows: int = BUCKET_ROWS,
                   stripe_rows: int = STRIPE_ROWS, anchor_block: int = ANCHOR_BLOCK, focus: int = FOCUS) -> DataFrame:
    """One row per anchor, positive and negative: ``anchor_id``, ``positive_id``,
    ``rank``, ``negative_id``, ``positive_score``, ``negative_score``."""
    stored = vectors(rows, id_col=id_col, vector_col=vector_col, label_col=label_col)
    stored = durable(stored, "vectors")
    is_anchor = F.col("id") % anchor_every == 0
    n, asked = stored.agg(F.count(F.lit(1)), F.count_if(is_anchor)).first()
    sizes = dict(stripes=max(1, min(MOST_STRIPES, -(-n // stripe_rows))), blocks=max(1, -(-asked // anchor_block)),
                 bucket_rows=bucket_rows, focus=focus)
    anchors = stored.filter(is_anchor)
    anywhere = F.array(F.struct(F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high")))
    near = durable(best_rows(stored, anchors.withColumn("slots", anywhere), positives, same=True, **sizes)
                   .select(F.col("anchor_row").alias("_row"), (F.col("rank") - 1).alias("slot"),
                           F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # the band in whole scores: least <= 100 * score <= most
    low = F.ceil(F.col("positive_score") * least_percent / 100)
    high = F.floor(F.col("positive_score") * most_percent / 100)
    bands = near.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("slot", low.alias("low"), high.alias("high")))).alias("_b"))
    slots = F.transform("_b", lambda b: F.struct(b["low"].cast("double").alias("low"), b["high"].cast("double").alias("high")))
    found = best_rows(stored, anchors.join(bands, "_row").withColumn("slots", slots), negatives, same=False, **sizes)
    names = anchors.select(F.col("_row").alias("anchor_row"), F.col("id").alias("anchor_id"))
    return (found.withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
            .join(near.withColumnRenamed("_row", "anchor_row"), ["anchor_row", "slot"]).join(names, "anchor_row")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
                    "positive_score", "negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 100th embedding, over all embeddings."""
    common.prepare(spark)
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
 AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 10
"""
