"""The corpus pipeline: quality classifier, toxicity, SimHash near-dedup, source
mixing, packing. Every stage takes (spark, docs, sf_dir) and works on all that
its predecessor kept; ``run`` writes each stage to the shared work folder as
Parquet and reads it back as the next stage's documents.

The two classifiers learn from all given labels (of documents that the stage
still has); the thresholds, shingle length and bit distance are those of the
operators' own queries.

Defined cases, for every stage: a null text counts as an empty one; a row with a
null id is scored, linked, mixed and packed like any other but is never learned
from; rows that repeat are rows of their own (near-dedup keeps one of them);
columns of any name go through unchanged up to the last stage; an empty table gives
no rows. Ties: equal texts score alike, near-dedup keeps the smallest id, mixing
takes rows of equal hash by their other columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorlake.llm import common, mixing, packing, quality, simhash, toxicity
from sensorlake.session import durable


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold go."""
    common.prepare(spark)
    return quality.reject(docs, _labels(spark, sf_dir))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at the threshold or above go."""
    common.prepare(spark)
    return toxicity.reject(docs, _labels(spark, sf_dir))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays."""
    common.prepare(spark)
    return simhash.keep_one_of_each(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, or up to 3 times."""
    common.prepare(spark)
    return mixing.mixed_documents(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in a sequence of 4096 ids."""
    import public_tokenizers
    common.prepare(spark)
    return packing.pack(docs, vocabulary=str(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("toxicity", toxicity_filter),
    ("simhash_near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("packing", sequence_packing),
]

# Learned scores, XXH64 and the tokenizer are beyond SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
