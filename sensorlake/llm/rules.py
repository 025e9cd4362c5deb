"""Quality rules (operator 8): hashed n-gram log-likelihood ratio.

Counts of hashed words and word pairs make two multinomials: of a trusted
target (documents labelled good) and of the raw corpus (all documents). A
document's score is the mean log ratio of its n-grams, so length does not count;
every document is kept or not by the same fixed threshold. Plain base rules come
first: too few words, too many repeated ones.

Both counts cover every whole text of their documents; each task adds up a vector of
``BUCKETS`` numbers. The raw corpus is counted where it lies. Of the trusted
documents, those whose id a bitmap (two bits an id; 8 MB to 128 MB, by the number of trusted
ids) lets through are joined with the trusted ids: only their texts are exchanged, and
an id that the bitmap lets through by chance ends at the join. These are about 1 %
of the others up to 64 million trusted ids, 3 % at 100 million, 71 % at a billion.

Defined cases: null text has no words and fails the base rules; repeated rows
count as often as they occur and get equal verdicts; null ids are never trusted;
without trusted documents the ratio is 0 and only the base rules decide; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

BUCKETS = 10_000
SMOOTHING = 1.0
LEAST_RATIO = -0.07       # mean log ratio that a document must reach
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
FILTER_BITS = 26          # the bitmap's size as a power of two: 8 MB
MOST_FILTER_BITS = 30     # and 128 MB, where there are 64 million trusted ids or more
SALTS = 8                 # tasks that an id's rows are dealt over in the join
_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"


def word_list(text: str | None) -> list[bytes]:
    return common.word_bytes(text).split()


def hashed(words: list[bytes], buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of the words and of the pairs of neighbours."""
    h = np.fromiter(map(crc32, words), "uint64", len(words))
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
    return np.concatenate([h % np.uint64(buckets), (pairs >> np.uint64(20)) % np.uint64(buckets)]).astype("int64")


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    times = Counter(windows)
    if len(times) == len(windows):
        return 0
    hit = np.fromiter((times[w] > 1 for w in windows), bool, len(windows))
    inside = np.zeros(len(words), bool)
    inside[:-2] |= hit
    inside[1:-1] |= hit
    inside[2:] |= hit
    return int(inside.sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(_BLANKS)]
    return len(lines) - len(set(lines))


def _positions(ident, power: int | None = None) -> Column:
    """Where an id stands in the bitmap of trusted ids, of 2^power bits."""
    h = F.xxhash64(ident)
    return F.array(*[F.pmod(F.shiftrightunsigned(h, 32 * i), F.lit(1 << (power or FILTER_BITS))) for i in range(2)])


def filter_power(n: int) -> int:
    """Size of the bitmap for ``n`` ids: 16 bits an id or more, so that 1.4 % of
    the others pass at most, between the two bounds."""
    return min(MOST_FILTER_BITS, max(FILTER_BITS, (16 * n).bit_length()))


def bitmap(ids: DataFrame, power: int | None = None) -> np.ndarray:
    """One bit for each position of the ids of a frame of one column, 2^power
    bits in all, in blocks that are put together on Spark."""
    power, block = power or FILTER_BITS, 1 << 15

    def fill(key, rows):
        bits = np.zeros(block, bool)
        bits[rows["at"].to_numpy()] = True
        return pd.DataFrame({"block": [key[0]], "bits": [np.packbits(bits).tobytes()]})

    at = ids.select(F.explode(_positions(F.col(ids.columns[0]), power)).alias("p")).distinct()
    rows = (at.select((F.col("p") / block).cast("long").alias("block"), (F.col("p") % block).alias("at"))
            .groupBy("block").applyInPandas(fill, "block long, bits binary").collect())
    out = np.zeros((1 << power) // 8, "uint8")
    for n, bits in rows:
        out[n * (block // 8):(n + 1) * (block // 8)] = np.frombuffer(bits, "uint8")
    return out


def count_ngrams(texts: DataFrame, buckets: int) -> np.ndarray:
    """Hashed n-gram counts of a frame with one column of texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, "int64")
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += np.bincount(hashed(word_list(text), buckets), minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    out = np.zeros(buckets)
    for b, n in texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():   # ``buckets`` rows
        out[b] = n
    return out


def bucket_counts(docs: DataFrame, trusted: DataFrame, *, id_col: str, text_col: str,
                  buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the raw corpus and of the trusted documents (a frame of ids)."""
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"))
    ids = trusted.select(F.col(id_col).try_cast(texts.schema["_doc"].dataType).alias("_id"))
    ids = ids.filter(F.col("_id").isNotNull()).distinct()
    power = filter_power(ids.count())
    bits = bitmap(ids, power)

    @F.pandas_udf("boolean")
    def may_be(first: pd.Series, second: pd.Series) -> pd.Series:
        a, b = (x.to_numpy("int64") for x in (first, second))
        return pd.Series((bits[a >> 3] >> (7 - (a & 7)).astype("uint8")) & (bits[b >> 3] >> (7 - (b & 7)).astype("uint8")) & 1 == 1)

    at = _positions(F.col("_doc"), power)
    likely = texts.filter(F.col("_doc").isNotNull()).filter(may_be(at[0], at[1]))
    # the partition of the scan as salt: rows of one id go to as many tasks
    likely = likely.withColumn("_salt", F.spark_partition_id() % SALTS)
    salted = ids.withColumn("_of", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    good = likely.join(salted.hint("merge"), (F.col("_doc") == F.col("_id")) & (F.col("_salt") == F.col("_of")))
    return count_ngrams(texts.select("_text"), buckets), count_ngrams(good.select("_text"), buckets)


def log_ratios(raw: np.ndarray, good: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    if not good.sum():
        return np.zeros(len(raw))
    a, b = good + smoothing, raw + smoothing
    return np.log(a / a.sum()) - np.log(b / b.sum())


def judge(docs: DataFrame, ratios: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text",
          least_ratio: float = LEAST_RATIO) -> DataFrame:
    """One row per document: id, the base counts, ``base_failed``, ``ratio``, ``kept``."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio"]

    def make():
        def run(texts):
            out = {k: [] for k in names}
            for text in texts:
                text = text or ""
                words = word_list(text)
                out["n_words"].append(len(words))
                out["word_chars"].append(len(text) - sum(map(text.count, _BLANKS)))
                out["n_symbols"].append(sum(map(text.count, _SYMBOLS)))
                out["n_dup_lines"].append(duplicate_lines(text))
                out["n_repeat_words"].append(repeated_words(words))
                out["ratio"].append(float(ratios[hashed(words, len(ratios))].mean()) if words else 0.0)
            return out
        return run
    schema = ", ".join(f"{n} {'double' if n == 'ratio' else 'long'}" for n in names)
    found = common.with_fields(docs, [id_col], text_col, common.per_text(schema, make), names)
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    return found.withColumns({"base_failed": failed, "kept": ~failed & (F.col("ratio") >= least_ratio)})


def fit(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", id_col: str = "doc_id",
        text_col: str = "text") -> np.ndarray:
    trusted = labels.filter(F.col(label_col) > 0).select(id_col)
    return log_ratios(*bucket_counts(docs, trusted, id_col=id_col, text_col=text_col))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of all documents."""
    common.prepare(spark)
    docs = common.documents(spark, sf_dir)
    ratios = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(docs, ratios)
