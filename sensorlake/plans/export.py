"""Output conventions shared by registered queries (and their SQL oracles):
event time leaves as TIMESTAMP_NTZ (wall clock in UTC), counts as BIGINT,
averages and other long decimals rounded to 6 places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

ROUND_DIGITS = 6


def export(df: DataFrame, round_cols: tuple[str, ...] = ()) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        if f.name in round_cols:
            c = F.round(c, ROUND_DIGITS)
        cols.append(c.alias(f.name))
    return df.select(*cols)
