"""Plain window forms of the distributed operators: one task per key, so only
for test-sized data. They restate the definitions directly and serve as the
reference the skew-safe operators are checked against."""
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlake import config as C
from sensorlake.operators.features import ORDER, epoch_seconds


def features_window(valid: DataFrame, keys=("sensor_id",), humidity_trend: bool = False) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*ORDER)
    cols = [(F.col("temperature") - F.lag("temperature", 1).over(w)).alias("temperature_change"),
            F.lead("temperature", C.TARGET_LEAD_ROWS).over(w).alias("target_temperature")]
    if humidity_trend:
        cols.append((F.col("humidity") - F.lag("humidity", 1).over(w)).alias("humidity_trend"))
    wr = (Window.partitionBy(*keys).orderBy(epoch_seconds(F.col("timestamp")))
          .rangeBetween(-C.ROLLING_WINDOW_SECONDS, Window.currentRow))
    return valid.select("*", *cols).withColumn("rolling_avg_temperature", F.avg("temperature").over(wr))


def row_number_window(df: DataFrame, keys, order, seq_col: str = "seq") -> DataFrame:
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(*order)
    return df.withColumn(seq_col, F.row_number().over(w).cast("long"))
