"""Language ID (operator 1): rank-order n-gram profiles.

Words are runs of letters, lower-cased, with a blank on either side; their
n-grams of 1 to 3 characters are counted. A language's profile is the ranks of
its most frequent n-grams, a document's the ranks of its own; the language with
the least sum of out-of-place distances wins (an n-gram that the profile lacks
counts ``PROFILE`` places; equal sums: the language first by code point).

An n-gram of three code points fits one 64-bit number, so counting is a sort
of a numpy array, without a hash and without collisions. Long texts are counted
in blocks that hand their last two characters on, so where a block ends does
not matter.

Every language gets a profile, learned from at most about ``FIT_DOCS`` of its
documents, chosen by a hash threshold. All profiles are one sorted table of
(n-gram, language, place), about 7 KB a language, that every task holds; a
document's distances to all languages are one pass over the entries of its own
n-grams. Prediction reads every whole text, without a shuffle.

Defined cases: null text, or one without a letter: ``und``, score 0; without a
learned language likewise; null lang is never learned from, null ids neither and
they are not held out; repeated rows get equal results; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import durable
from . import common

PROFILE = 400
FIT_DOCS = 2000
UNKNOWN = "und"
_BLOCK = 1 << 20
_BITS = 21


def _letters() -> np.ndarray:
    """For each code point itself if it is a letter, else 0 (a blank)."""
    table = common.worker_cache("letters")
    if "t" not in table:
        t = np.arange(0x110000, dtype="int64")
        t[[not chr(i).isalpha() for i in range(0x110000)]] = 0
        table["t"] = t
    return table["t"]


def _block_grams(tail: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams that end in ``block`` (code points, 0 for a blank) after
    ``tail``, as numbers, sorted, repeats included; and the next block's tail."""
    cp = np.concatenate([tail, block])
    cp = cp[np.append(True, (cp[1:] != 0) | (cp[:-1] != 0))]      # one blank between words
    new = len(tail)
    one = cp[new:][cp[new:] != 0]
    # a blank counts as the code point 1, so a leading one still takes its place
    at = np.maximum(cp, 1)
    two = at[:-1] << _BITS | at[1:]
    three = (two[:-1] << _BITS | at[2:])[max(new - 2, 0):][cp[1:-1][max(new - 2, 0):] != 0]
    return np.sort(np.concatenate([one, two[max(new - 1, 0):], three])), cp[-2:]


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a whole text and their counts."""
    text, tail, parts = (text or "").lower(), np.zeros(1, "int64"), []
    for at in range(0, len(text), _BLOCK):
        block = _letters()[np.frombuffer(text[at:at + _BLOCK].encode("utf-32-le", "replace"), "<u4")]
        if at + _BLOCK >= len(text):
            block = np.append(block, 0)
        grams, tail = _block_grams(tail, block)
        parts.append(_tally(grams, np.ones(len(grams), "int64")))
    parts = [x for x in parts if len(x[0])]
    if not parts:
        return np.zeros(0, "int64"), np.zeros(0, "int64")
    if len(parts) == 1:
        return parts[0]
    g, c = np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts])
    order = np.argsort(g, kind="stable")
    return _tally(g[order], c[order])


def _tally(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])) if len(grams) else np.zeros(0, int)
    return grams[first], np.add.reduceat(counts, first) if len(first) else counts


def ranked(grams: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, most frequent first; ties by n-gram."""
    if len(grams) > 4 * size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.argsort(-counts, kind="stable")[:size]]


class Profiles:
    """All languages' profiles: (n-gram, language, place) by n-gram."""

    def __init__(self, ranks: dict[str, list[int]], size: int = PROFILE):
        self.names, self.size = sorted(ranks), size
        grams = np.concatenate([np.zeros(0, "int64"), *[np.array(ranks[n], "int64") for n in self.names]])
        language = np.repeat(np.arange(len(self.names)), [len(ranks[n]) for n in self.names])
        place = np.concatenate([np.zeros(0, "int64"), *[np.arange(len(ranks[n])) for n in self.names]])
        order = np.argsort(grams, kind="stable")
        self.grams, self.language, self.place = grams[order], language[order].astype("int32"), place[order].astype("int32")

    def distances(self, own: np.ndarray) -> np.ndarray:
        """Out-of-place distance of ranked n-grams to each language."""
        first, last = np.searchsorted(self.grams, own, "left"), np.searchsorted(self.grams, own, "right")
        times = last - first
        ends = np.cumsum(times)
        entry = np.arange(ends[-1]) + np.repeat(first - ends + times, times)
        apart = np.abs(self.place[entry] - np.repeat(np.arange(len(own)), times))
        saved = np.bincount(self.language[entry], weights=self.size - apart, minlength=len(self.names))
        return self.size * len(own) - saved.astype("int64")

    def predict(self, text: str | None) -> tuple[str, float]:
        own = ranked(*gram_counts(text), self.size)
        if not len(own) or not self.names:
            return UNKNOWN, 0.0
        distance = self.distances(own)
        best = int(np.argmin(distance))          # of equal ones the first by name
        return self.names[best], 1 - int(distance[best]) / (self.size * len(own))


def learn(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          size: int = PROFILE, fit_docs: int = FIT_DOCS) -> Profiles:
    """Profiles of the languages of the given documents."""
    rows = (docs.select(F.col(lang_col).cast("string").alias("_lang"), F.col(text_col).alias("_text"),
                        F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(1 << 30)).alias("_spread"))
            .filter(F.col("_lang").isNotNull() & F.col("_text").isNotNull()))
    # one row per language
    shares = durable(rows.groupBy("_lang").agg(F.least(F.lit(1.0), F.lit(float(fit_docs)) / F.count(F.lit(1))).alias("_share")),
                     "languages")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by.setdefault(lang, []).append(gram_counts(text))
            for lang, found in by.items():
                g, c = np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])
                order = np.argsort(g, kind="stable")
                g, c = _tally(g[order], c[order])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g)), pa.array(g), pa.array(c, pa.int64())],
                                                 names=["lang", "gram", "n"])

    chosen = rows.join(shares, "_lang").filter(F.col("_spread") < F.col("_share") * (1 << 30))
    counts = (chosen.select("_lang", "_text").mapInArrow(run, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    # each task keeps its ``size`` first of a language before the shuffle; at most ``size`` rows of each come here
    top = counts.withColumn("place", place).filter(F.col("place") <= size).collect()
    ranks: dict[str, list[int]] = {}
    for r in sorted(top, key=lambda r: (r["lang"], r["place"])):
        ranks.setdefault(r["lang"], []).append(r["gram"])
    return Profiles(ranks, size)


def predict(docs: DataFrame, profiles: Profiles, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``lang_pred``, ``score`` (1 - distance / greatest possible)."""
    def make():
        def run(texts):
            found = [profiles.predict(t) for t in texts]
            return {"lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}
        return run
    return common.with_fields(docs, [id_col], text_col, common.per_text("lang_pred string, score double", make),
                              ["lang_pred", "score"])


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned where crc32(doc_id) mod 4 is not 2."""
    common.prepare(spark)
    docs = common.documents(spark, sf_dir)
    rest = common.remainder("doc_id", 4)
    return predict(docs, learn(docs.filter(rest != 2))).select(
        "doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
