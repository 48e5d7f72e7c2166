"""Time bins of an event stream: the plain hourly bins under a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def windowed(events: DataFrame, time: str, key: str, value: str, width: str = "1 hour", late: str = "6 hours") -> DataFrame:
    """key, bin_start, n, mean, low, high of each bin; rows later than the watermark are dropped once their bin is closed."""
    timed = events.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late)
    out = timed.groupBy(F.window("_t", width), key).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.min(value).alias("low"), F.max(value).alias("high"))
    return out.select(key, F.col("window.start").alias("bin_start"), "n", "mean", "low", "high")
