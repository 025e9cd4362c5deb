"""Reading validation: split input into valid rows and rejects with reasons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import RULE_NAMES, is_valid, reason_columns, reasons


def with_reasons(df: DataFrame, blank: str = "exact_space") -> DataFrame:
    """Adds ``reasons`` ('' when the row is clean). Stateless; works on streams."""
    return df.withColumn("reasons", reasons(blank))


def validate_reading(df: DataFrame, blank: str = "exact_space") -> tuple[DataFrame, DataFrame]:
    """(valid, invalid). ``invalid`` keeps every input column plus ``reasons``;
    ``valid`` is the rest, without it. The two are an exact partition of the
    input. Both are lazy filters over the same input: persist or write the
    input first when both are consumed by separate actions on a large batch.
    """
    valid = df.filter(is_valid(blank))
    invalid = with_reasons(df, blank).filter(F.col("reasons") != "")
    return valid, invalid


def reason_counts(df: DataFrame, blank: str = "exact_space") -> DataFrame:
    """Rows per reason list over the rejects (partial + final aggregation)."""
    _, invalid = validate_reading(df, blank)
    return invalid.groupBy("reasons").agg(F.count(F.lit(1)).cast("long").alias("n_rows"))


def dq_summary(df: DataFrame, blank: str = "exact_space") -> DataFrame:
    """One row of data-quality counts in a single pass: total, valid, invalid
    and one count per rule (a row can break several rules)."""
    rules = reason_columns(blank)
    aggs = [
        F.count(F.lit(1)).cast("long").alias("total_rows"),
        F.count_if(is_valid(blank)).cast("long").alias("valid_rows"),
        F.count_if(~is_valid(blank)).cast("long").alias("invalid_rows"),
    ]
    aggs += [F.count_if(r.isNotNull()).cast("long").alias(n) for r, n in zip(rules, RULE_NAMES)]
    return df.agg(*aggs)

