"""Document fingerprints (operator 5): SpotSigs.

A spot signature is an anchor (a common word) with the chain of the next
``CHAIN`` content words after it, ``DISTANCE`` words apart. A document's fingerprint
is the set of its signatures, as 32-bit hashes in order, 8 hex digits each.
Likeness is the Jaccard share of two sets, pruned: sets of lengths a <= b cannot
exceed a / b, and a comparison stops where what is left cannot reach the threshold.

Near copies over the whole corpus (``near_copies``): equal sets become one
representative; representatives are dealt into partitions of set lengths, each
``1 / least`` times as long as the one before, so that partners lie in the same
or the next one. Inside a partition an inverted index of each set's rarest
signatures, as many as any partner must share one of, gives the candidates,
which are compared exactly, with pruning. Rarity is only an order of the
signatures (the ``FREQUENT`` most frequent come last), so every pair is found
whatever it is. ``with_next`` compares by the same ``likeness``.

The ordered walk (each document and the next) is one exchange of the texts:
ids are cut into ranges by approximate quantiles, every range also gets the first
document of the following one, and a task walks its sorted range as a stream.
An id that holds a range or more, and the rows without an id, are cut further
by the start of the text, and rows that are equal there by a random salt (the next
document of a row is then an equal one wherever it lies). Only different long texts
of one id with the same first 64 characters stay together. The salt follows the
row order of the input, so documents should be a stored table.

Defined cases: null text is empty; texts without an anchor (or without
content words after one) fall back to their content words, then to all their
words; empty fingerprints are alike (1.0), an empty and another are not (0.0);
rows with one id follow each other by text; null ids come last; a single
document follows itself; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sequence import sequence_index
from ..session import durable
from . import common

CHAIN = 3
DISTANCE = 1
RANGE_ROWS = 4096       # documents of one task's walk, about
MAX_RANGES = 20_000     # beyond (82 million documents), walks get longer instead: they are sorted streams
START = 64              # characters of a text that place a row among those of its hot id
LEAST = 0.8             # likeness of near copies
FREQUENT = 1 << 17      # signatures whose order is by their count
_SLACK = 1e-9           # pruning never drops a pair at the threshold by rounding
# Common words of English, French, German and Spanish.
ANCHORS = frozenset("""
the of and to in a is that it for was on are as with he be at by this or from had not but what all were when we there can an
le la les de des du un une et en que qui est dans pour pas sur avec par il au ce se
der die das und von zu den mit ist im für auf dem nicht ein eine des sich
el los las del y se un una por con para su al lo como
""".split())
_LETTERS = bytes((c + 32 if 65 <= c <= 90 else c) if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in range(256))
_ANCHORS = frozenset(a.encode() for a in ANCHORS)


def signatures(text: str | None, *, chain: int = CHAIN, distance: int = DISTANCE) -> np.ndarray:
    """The distinct spot signatures of a whole text, hashed, ascending."""
    words = common.word_bytes(text).translate(_LETTERS).split()
    content = [w for w in words if w not in _ANCHORS]
    spots, at = [], 0
    for w in words:
        if w in _ANCHORS:
            links = content[at:at + chain * distance:distance]
            if links:
                spots.append(crc32(b" ".join([w, *links])))
        else:
            at += 1
    if not spots:
        spots = list(map(crc32, content or words))
    return np.unique(np.array(spots, "uint32"))


def to_string(sigs: np.ndarray) -> str:
    return sigs.astype(">u4").tobytes().hex()


def from_string(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype("uint32")


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard share of two ascending sets; 0 if their lengths alone, or what
    is left after half of the shorter one, keep it below ``least``."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return float(len(b) == 0)
    if len(a) < least * len(b) - _SLACK:
        return 0.0
    half = len(a) // 2
    shared = 0
    for part, left in ((a[:half], len(a) - half), (a[half:], 0)):
        at = np.searchsorted(b, part)
        shared += int((b[np.minimum(at, len(b) - 1)] == part).sum())
        if shared + left < least * (len(a) + len(b)) / (1 + least) - _SLACK:
            return 0.0
    return shared / (len(a) + len(b) - shared)


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and ``fingerprint``."""
    udf = common.per_text("fingerprint string", lambda: lambda texts: {"fingerprint": [to_string(signatures(t)) for t in texts]})
    return common.with_fields(docs, [id_col], text_col, udf, ["fingerprint"])


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the start of ``following``."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


def _cuts(rows: DataFrame, hot: dict) -> dict:
    """Where each hot id (id -> number of walks) is cut: sorted (start of the
    text, salt) pairs, from a sample of about 8 rows a walk. Cuts only balance
    the walks; any cuts give the same rows."""
    if not hot:
        return {}
    wanted = 8 * sum(hot.values())
    sample = rows.filter(F.rand(11) < wanted / max(wanted, rows.count())).select("_id", "_start", "_salt").collect()
    seen = {h: [] for h in hot}
    for ident, start, salt in sample:
        seen[ident].append((start, salt))
    return {h: sorted({sorted(s)[i * len(s) // hot[h]] for i in range(1, hot[h])}) if s else [] for h, s in seen.items()}


def with_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: float = 0.0,
              range_rows: int = RANGE_ROWS) -> DataFrame:
    """Every document, in descending order of its (integer) id, against its
    edited text and the next document."""
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    total, known = rows.agg(F.count(F.lit(1)), F.count("_id")).first()
    ranges = min(MAX_RANGES, max(1, -(-known // range_rows)))
    quantiles = rows.agg(F.percentile_approx("_id", [i / ranges for i in range(1, ranges)], 5 * ranges)).first()[0] \
        if ranges > 1 else []
    bounds, times = np.unique(np.array(quantiles, "int64"), return_counts=True)
    # ids that hold a range or more, and over how many walks each is dealt; None: the rows without an id
    hot = {int(b): int(t) for b, t in zip(bounds, times) if t > 1}
    is_hot = F.coalesce(F.col("_id").isin(list(hot)), F.lit(False))
    if total - known > range_rows:
        hot[None] = min(MAX_RANGES, -(-(total - known) // range_rows))
        is_hot = is_hot | F.col("_id").isNull()
    # the order inside a hot id is by text; the salt only deals out equal rows
    marked = (rows.withColumn("_start", F.when(is_hot, F.substring("_text", 1, START)))
              .withColumn("_salt", F.when(is_hot & (F.length("_text") <= START), F.rand(7)).otherwise(1.0)))
    cuts = _cuts(marked.filter(is_hot), hot)

    # walks in order, by range (ids descend, null ids last): those of its hot id, then that of its other ids
    sizes = np.zeros((len(bounds) + 2, 2), "int64")
    sizes[:, 1] = 1
    for ident, own in cuts.items():
        sizes[len(bounds) + 1 if ident is None else len(bounds) - np.searchsorted(bounds, ident), 0] = len(own) + 1
    first = np.cumsum(sizes).reshape(sizes.shape) - sizes

    @F.pandas_udf("int")
    def walk_of(ident: pd.Series, absent: pd.Series, start: pd.Series, salt: pd.Series) -> pd.Series:
        numbers, absent, cold = ident.to_numpy("int64"), absent.to_numpy(bool), start.isna().to_numpy()
        at = np.where(absent, len(bounds) + 1, len(bounds) - np.searchsorted(bounds, numbers, side="left"))
        walk = first[at, cold.astype(int)]
        for i in np.flatnonzero(~cold):
            walk[i] += bisect_right(cuts[None if absent[i] else int(numbers[i])], (start.iat[i], salt.iat[i]))
        return pd.Series(walk)

    marked = marked.withColumn("_walk", walk_of(F.coalesce("_id", F.lit(0)), F.col("_id").isNull(), "_start", "_salt"))
    # what each walk starts with and the walk before it, the last one's being
    # the first: at most 2.5 * MAX_RANGES + 2 rows, compared in the JVM, where a
    # long beside a null stays a long
    heads = sorted(map(tuple, marked.groupBy("_walk").agg(F.max("_id"), F.min("_start")).collect()), key=lambda h: h[0])
    table = docs.sparkSession.createDataFrame([(w, head, start, heads[i - 1][0]) for i, (w, head, start) in enumerate(heads)],
                                              "_walk int, _head long, _head_start string, _before int")
    also = F.when(F.col("_id").eqNullSafe(F.col("_head")) & F.col("_start").eqNullSafe(F.col("_head_start")),
                  F.bitwise_not("_before"))         # ~walk: only seen as the next document

    # a walk is a partition, so the largest task does not grow with the table
    dealt = (marked.join(F.broadcast(table), "_walk")
             .withColumn("_to", F.explode(F.array_compact(F.array("_walk", also))))
             .select("_id", "_text", (F.col("_to") < 0).alias("_seen"),
                     F.when(F.col("_to") < 0, F.bitwise_not("_to")).otherwise(F.col("_to")).alias("_walk"))
             .repartitionById(max(1, int(sizes.sum())), "_walk")
             .sortWithinPartitions("_walk", "_seen", F.col("_id").desc_nulls_last(), "_text"))
    fields = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [T.LongType(), T.LongType(), T.StringType(), T.StringType(), T.StringType(), T.DoubleType(), T.DoubleType()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compare(one, two):
            text = edited(one[1], two[1])
            sigs = signatures(text)
            return (one[0], len(one[1]), hashlib.sha256(text.encode("utf-8", "replace")).hexdigest(), to_string(one[2]),
                    to_string(sigs), likeness(one[2], sigs, least), likeness(one[2], two[2], least))

        open_walk, held, done = None, None, True
        for batch in batches:
            out = []
            for ident, text, seen, walk in zip(*(c.to_pylist() for c in batch.columns)):
                row = (ident, text, signatures(text))
                if walk != open_walk:
                    open_walk, held, done = walk, None, False
                if held is not None and not done:
                    out.append(compare(held, row))
                done = done or seen         # the next range's first document ends the walk
                held = row
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate((
                    pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))], names=fields)

    schema = T.StructType([T.StructField(n, k) for n, k in zip(fields, kinds)])
    return dealt.select("_id", "_text", "_seen", "_walk").mapInArrow(run, schema)


def length_starts(longest: int, least: float) -> np.ndarray:
    """First set length of each partition, up to ``longest``: partners of a
    set are in its own partition or a neighbouring one."""
    starts = [1]
    while starts[-1] <= longest:
        starts.append(int(starts[-1] / least + _SLACK) + 1)
    return np.array(starts)


def candidates(sets: DataFrame, *, least: float = LEAST, frequent: int = FREQUENT) -> DataFrame:
    """Pairs (``set_a``, ``set_b``) of a stored (``set_id``, ``fingerprint``)
    frame of distinct, not empty sets, with all pairs of likeness ``least`` or more."""
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(from_string(f).astype("int64"))], names=["sig"])

    # at most ``frequent`` rows, the most frequent last
    common_ones = (sets.select("fingerprint").mapInArrow(explode, "sig long").groupBy("sig").agg(F.count(F.lit(1)).alias("n"))
                   .filter(F.col("n") > 1).orderBy(F.desc("n"), "sig").limit(frequent).collect())
    known = np.array([r["sig"] for r in common_ones], "int64")
    at_known = np.argsort(known)
    known, place = known[at_known], len(known) - at_known        # 1: the least frequent of them
    longest = sets.agg(F.max(F.length("fingerprint"))).first()[0] or 0
    starts = length_starts(longest // 8, least)
    names = ["band", "sig", "home", "set_id", "n", "pos"]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ident, f in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sigs = from_string(f).astype("int64")
                rank = np.zeros(len(sigs), "int64")
                if len(known):
                    at = np.minimum(np.searchsorted(known, sigs), len(known) - 1)
                    rank = np.where(known[at] == sigs, place[at], 0)
                # two sets with likeness ``least`` share ceil(least * n) signatures at least
                rare = sigs[np.lexsort((sigs, rank))][:len(sigs) - int(np.ceil(least * len(sigs) - _SLACK)) + 1]
                band = int(np.searchsorted(starts, len(sigs), side="right"))
                k = len(rare)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([band, band + 1], k)), pa.array(np.tile(rare, 2)), pa.array(np.repeat([True, False], k)),
                     pa.array(np.full(2 * k, ident, "int64")), pa.array(np.full(2 * k, len(sigs), "int64")),
                     pa.array(np.tile(np.arange(k), 2))], names=names)

    rows = durable(sets.select("set_id", "fingerprint").mapInArrow(
        index, "band long, sig long, home boolean, set_id long, n long, pos long"), "rare-signatures")
    a = rows.filter("home").select("band", "sig", *[F.col(c).alias(f"a_{c}") for c in ("set_id", "n", "pos")])
    b = rows.select("band", "sig", *[F.col(c).alias(f"b_{c}") for c in ("set_id", "n", "pos")])
    # a is the longer one; after the first shared signature only what follows can be shared
    shorter = (F.col("b_n") < F.col("a_n")) | ((F.col("b_n") == F.col("a_n")) & (F.col("b_set_id") < F.col("a_set_id")))
    bound = F.least(F.col("a_n") - F.col("a_pos"), F.col("b_n") - F.col("b_pos"))
    return (a.join(b, ["band", "sig"])
            .filter(shorter & (F.col("b_n") >= least * F.col("a_n") - _SLACK)
                    & (bound >= least / (1 + least) * (F.col("a_n") + F.col("b_n")) - _SLACK))
            .select(F.least("a_set_id", "b_set_id").alias("set_a"), F.greatest("a_set_id", "b_set_id").alias("set_b")).distinct())


def near_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST,
                frequent: int = FREQUENT) -> tuple[DataFrame, DataFrame]:
    """All near copies of a corpus, adjacent or not, for ``least`` above 0:
    pairs of representatives (``set_a`` < ``set_b``, ``near`` >= ``least``), and the
    members (id, ``set_id``), one row per document. Documents of one set are
    alike (1.0) and have no pair."""
    prints = durable(fingerprints(docs, id_col=id_col, text_col=text_col), "spot-signatures")
    sets = durable(sequence_index(prints.select("fingerprint").distinct(), [], ["fingerprint"], seq_col="set_id")
                   .select("set_id", "fingerprint"), "sets")
    found = candidates(sets.filter(F.col("fingerprint") != ""), least=least, frequent=frequent)
    one = sets.select(F.col("set_id").alias("set_a"), F.col("fingerprint").alias("_a"))
    two = sets.select(F.col("set_id").alias("set_b"), F.col("fingerprint").alias("_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [likeness(from_string(x), from_string(y), least)
                    for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near, pa.float64())],
                                             names=["set_a", "set_b", "near"])

    pairs = (found.join(one, "set_a").join(two, "set_b").select("set_a", "set_b", "_a", "_b")
             .mapInArrow(compare, "set_a long, set_b long, near double").filter(F.col("near") >= least))
    return pairs, prints.join(sets, "fingerprint").select(id_col, "set_id")


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, their edited texts and their likeness."""
    common.prepare(spark)
    return with_next(common.documents(spark, sf_dir))
