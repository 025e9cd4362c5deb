"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import apply_runtime_conf

# An Arrow batch ends at this many bytes or rows: bounds a Python worker's
# memory whatever the texts' lengths (one longer text is a batch of its own).
BATCH_BYTES = 4 << 20
BATCH_ROWS = 1 << 16


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on (UTC, ANSI, small Arrow batches)."""
    apply_runtime_conf(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (null id: null)."""
    return F.crc32(F.col(id_col).cast("string")) % modulus


def per_text(schema: str, make: Callable[[], Callable[[list], dict]]):
    """A scalar-iterator Pandas UDF over a text column that returns a struct.

    ``make()`` runs once per task and gives a function from a list of texts
    (str or None) to a dict of equally long columns. Only the text travels to
    Python; the other columns of the frame stay in the JVM.
    """
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = make()
        for texts in batches:
            yield pd.DataFrame(score(texts.tolist()))
    return F.pandas_udf(run, schema)


def with_fields(docs: DataFrame, keep: list[str], text_col: str, udf, fields: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` and the fields of ``udf(text_col)``; fields
    replace columns of the same name, so clashing names cannot be ambiguous."""
    kept = [F.col(f"`{c}`") for c in keep if c not in fields]
    return (docs.select(*kept, udf(F.col(f"`{text_col}`")).alias("_fields"))
            .select(*kept, *[F.col(f"_fields.{f}").alias(f) for f in fields]))


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker process (workers are
    reused between tasks), whether or not this package was shipped by value.
    Only for memoised results: losing it costs time, never rows."""
    module = sys.modules.setdefault("_sensorlake_worker_cache", types.ModuleType("_sensorlake_worker_cache"))
    return module.__dict__.setdefault(name, {})


def word_bytes(text: str | None) -> bytes:
    """UTF-8 of a text (null: empty); lone surrogates become '?'."""
    return (text or "").encode("utf-8", "replace")


def bounded_sample(rows: DataFrame, id_col: str, value_col: str, limit: int) -> DataFrame:
    """(id, value) of ``limit`` ids at most: those whose id hashes lowest, with the
    least of an id's values; the same in every run. Only bounds what a
    classifier is fitted on."""
    return (rows.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(value_col).alias(value_col))
            .orderBy(F.xxhash64(id_col), id_col).limit(limit))


def labelled_texts(docs: DataFrame, labels: DataFrame, label_col: str, *, id_col: str, text_col: str,
                   limit: int) -> DataFrame:
    """(id, ``_text``, ``_label``) of at most ``limit`` labelled documents. The
    sample of labels has that bound, so it is broadcast; an id that repeats is
    taken once, with the text that hashes lowest and the least label; a null
    label is not learned from."""
    sample = bounded_sample(labels.filter(F.col(label_col).isNotNull())
                            .select(id_col, F.col(label_col).cast("int").alias("_label")), id_col, "_label", limit)
    texts = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    picked = texts.join(F.broadcast(sample), id_col).groupBy(id_col).agg(
        F.min_by(F.struct("_text", "_label"), F.struct(F.xxhash64("_text"), "_text")).alias("_row"))
    return picked.select(id_col, "_row._text", "_row._label")
