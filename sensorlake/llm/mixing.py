"""Mixing sources to target weights (operator 10): hash-threshold histograms.

* A source's target is its weight's share of all words, at most ``max_copies``
  times its own words; what is above goes to the others by weight. That is a
  water level L with target = min(max_copies * size, L * weight), found in a
  few rounds of one aggregate over the table of sources.
* A source takes floor(target / size) copies of every document, and one more of
  those whose hash (of id and text) is below a threshold. The threshold comes
  from histograms: words by (source, leading hash bits); the bucket in which the
  budget runs out is the boundary, and only its documents are summed again by
  the next bits, until the boundary is one hash value, one document as a rule. It
  is taken if that is nearer to the budget. Nothing is sorted, and a source's
  threshold for a smaller budget is below that for a larger one, so mixes are
  nested.
* Rows of equal id and text share the boundary's hash: as many of them are taken
  as come nearest to the budget, by a row number among them alone.

A hot source only adds to partial sums: at most 4096 of them per source, task
and level reach the shuffle. Defined cases: null text has size 0; null source
is a source of its own, last in order; null ids are told apart by their texts;
of rows that repeat, which ones are taken is decided by their other columns; a
source without words has target 0; an empty table gives no rows; other columns
are ignored (or kept, in ``mixed_documents``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.sequence import sequence_index
from ..session import durable
from . import common

WORD = r"[^\x20\x09-\x0D]+"
CYCLE = 3            # weights 1, 2, 3, repeating over the sources in order
MAX_COPIES = 3
HASH_BITS = 60       # leading bits of the MD5 of id and text
LEVEL_BITS = 12


def source_targets(sizes: DataFrame, *, cycle: int = CYCLE, max_copies: int = MAX_COPIES) -> DataFrame:
    """(``_source``, ``source_size``, ``target``) from (``_source``, ``size``)."""
    s = sizes.groupBy("_source").agg(F.sum("size").cast("long").alias("source_size"))
    s = durable(sequence_index(s, [], ["_source"], seq_col="_rank")
                .withColumn("_weight", (F.col("_rank") - 1) % cycle + 1), "sources")
    limit = F.lit(max_copies) * F.col("source_size")
    total, weights = s.agg(F.sum("source_size"), F.sum("_weight")).first()
    level, known = (total / weights if weights else 0.0), -1
    while weights:
        full = limit <= F.lit(level) * F.col("_weight")
        n, held, left = s.agg(F.count_if(full), F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("_weight")))).first()
        if n == known or not left:
            break
        known, level = n, (total - (held or 0)) / left
    return s.select("_source", "source_size",
                    F.least(limit.cast("double"), F.lit(float(level)) * F.col("_weight")).alias("target"))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(``_source``, ``_edge``, ``_edge_rows``, ``_edge_taken``) for (``_source``,
    ``_budget``): documents with hash < edge are taken, and ``_edge_taken`` of the
    ``_edge_rows`` at the edge, which have one size."""
    state = budgets.select("_source", "_budget", F.lit(0).cast("long").alias("_prefix"),
                           F.lit(0).cast("long").alias("_below"))
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        lead = F.col("hash").bitwiseAND(F.lit((1 << HASH_BITS) - 1))
        inside = rows.join(state, "_source").filter(F.shiftright(lead, shift + LEVEL_BITS) == F.col("_prefix"))
        sums = (inside.groupBy("_source", "_budget", "_below", F.shiftright(lead, shift).alias("_bucket"))
                .agg(F.sum("size").alias("_words"), F.count(F.lit(1)).alias("_rows")))
        # at most 4096 rows of a source
        upto = F.sum("_words").over(Window.partitionBy("_source").orderBy("_bucket"))
        sums = sums.withColumn("_upto", F.col("_below") + upto)
        state = durable(sums.filter(F.col("_upto") > F.col("_budget")).groupBy("_source", "_budget").agg(
            F.min_by(F.struct("_bucket", (F.col("_upto") - F.col("_words")).alias("_below"), "_words", "_rows"), "_bucket").alias("_b"))
            .select("_source", "_budget", F.col("_b._bucket").alias("_prefix"), F.col("_b._below").alias("_below"),
                    F.col("_b._words").alias("_words"), F.col("_b._rows").alias("_rows")), "thresholds")
    left, each = F.col("_budget") - F.col("_below"), F.col("_words") / F.col("_rows")
    whole = F.floor(left / each)
    nearer = each - (left - whole * each) < left - whole * each
    return state.select("_source", F.col("_prefix").alias("_edge"), F.col("_rows").alias("_edge_rows"),
                        (whole + F.when(nearer, 1).otherwise(0)).cast("long").alias("_edge_taken"))


def _source_key(source_col: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{source_col}`").cast("string")), F.lit("~"))   # null after any value


def _hash(id_col: str, text_col: str) -> Column:
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (id_col, text_col)]
    digest = F.md5(F.concat(parts[0], F.lit(":"), parts[1]).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def _with_copies(rows: DataFrame, plan: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` (``_source``, ``hash``, ...) with ``copies``. Only where several rows
    are at a source's edge are those numbered, in ``order``."""
    planned = rows.join(plan, "_source")
    at_edge = F.col("hash").eqNullSafe(F.col("_edge"))
    several = at_edge & (F.col("_edge_rows") > 1)

    def copies(more: Column) -> Column:
        return (F.col("_whole") + F.when(more, 1).otherwise(0)).cast("long")

    single = (F.col("hash") < F.col("_edge")) | (at_edge & (F.col("_edge_taken") > 0))
    if plan.filter((F.col("_edge_rows") > 1) & F.col("_edge_taken").between(1, F.col("_edge_rows") - 1)).isEmpty():
        return planned.withColumn("copies", copies(single))          # all at an edge, or none
    repeats = planned.filter(several).withColumns({f"_order{i}": c for i, c in enumerate(order)})
    numbered = sequence_index(repeats, ["_source"], [f"_order{i}" for i in range(len(order))], seq_col="_copy")
    return (planned.filter(~F.coalesce(several, F.lit(False))).withColumn("copies", copies(single))
            .unionByName(numbered.withColumn("copies", copies(F.col("_copy") <= F.col("_edge_taken")))
                         .drop("_copy", *[f"_order{i}" for i in range(len(order))])))


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    size = F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD)), F.lit(0)).cast("long")
    return durable(docs.select(F.col(f"`{id_col}`"), _source_key(source_col).alias("_source"), size.alias("size"),
                               _hash(id_col, text_col).alias("hash")), "sizes")


def plan_mix(rows: DataFrame, *, cycle: int = CYCLE, max_copies: int = MAX_COPIES) -> DataFrame:
    """One row per source of a stored (``_source``, ``size``, ``hash``) frame:
    ``source_size``, ``target``, whole copies and the threshold of one more."""
    targets = durable(source_targets(rows, cycle=cycle, max_copies=max_copies)
                      .withColumn("_whole", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long"))
                      .withColumn("_budget", F.col("target") - F.col("_whole") * F.col("source_size")), "targets")
    edges = thresholds(rows, targets.filter(F.col("source_size") > 0).select("_source", "_budget"))
    return durable(targets.join(edges, "_source", "left"), "mix")


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        cycle: int = CYCLE, max_copies: int = MAX_COPIES) -> DataFrame:
    """One row per document: id, ``size``, ``source_size``, ``target`` (both of
    its source), ``copies`` and ``taken`` = size * copies."""
    rows = _sizes(docs, id_col, text_col, source_col)
    plan = plan_mix(rows, cycle=cycle, max_copies=max_copies)
    return _with_copies(rows, plan, [F.col("hash")]).select(
        id_col, "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    cycle: int = CYCLE, max_copies: int = MAX_COPIES) -> DataFrame:
    """``docs`` with each row as often as the mix takes it (0 to ``max_copies``
    times); same columns. The plan has one row per source, so Spark joins it
    without moving the texts as long as it is under the broadcast threshold."""
    plan = plan_mix(_sizes(docs, id_col, text_col, source_col), cycle=cycle, max_copies=max_copies)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(_source_key(source_col).alias("_source"), _hash(id_col, text_col).alias("hash"),
                       F.xxhash64(*columns).alias("_mark"), F.struct(*columns).alias("_row"))
    taken = _with_copies(rows, plan, [F.col("_mark")]).filter(F.col("copies") > 0)
    return (taken.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy"))
            .select(*[F.col("_row").getField(c).alias(c) for c in docs.columns]))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to source weights 1, 2, 3, repeating."""
    common.prepare(spark)
    return mix(common.documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS ss, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM d GROUP BY source),
r AS (
  SELECT *, sum(ss) OVER () AS t, sum(w) OVER () AS ws,
         coalesce(sum(3 * ss) OVER (ORDER BY 3.0 * ss / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         coalesce(sum(w) OVER (ORDER BY 3.0 * ss / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone
  FROM s),
f AS (SELECT *, 3 * ss <= CAST(t - held AS DOUBLE) / (ws - gone) * w AS is_full FROM r),
l AS (
  SELECT CAST(max(t) - coalesce(sum(CASE WHEN is_full THEN 3 * ss END), 0) AS DOUBLE)
         / nullif(sum(CASE WHEN is_full THEN 0 ELSE w END), 0) AS level FROM f),
g AS (
  SELECT source, ss, CASE WHEN is_full THEN CAST(3 * ss AS DOUBLE) ELSE level * w END AS target FROM f, l),
c AS (
  SELECT d.doc_id, d.size, g.ss, g.target, coalesce(floor(g.target / nullif(g.ss, 0)), 0) AS whole,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.h) AS tied
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, ss AS source_size, target,
       CAST(size * (whole + CASE
         WHEN upto <= target - whole * ss THEN 1
         WHEN upto - tied <= target - whole * ss
              AND upto - (target - whole * ss) < (target - whole * ss) - (upto - tied) THEN 1
         ELSE 0 END) AS BIGINT) AS taken
FROM c
"""
