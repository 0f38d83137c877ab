"""Incremental ingest of landed observation files with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.dedup import keep_first


def ingest(spark: SparkSession, source: str, schema: StructType, out: str, checkpoint: str, normalize, *, format: str = "parquet", files_per_batch: int = 1000) -> None:
    """Takes in all files that have landed since the last call, each exactly once, and ends.

    Every micro-batch is normalised and written to a folder of its own number, which a repeated
    batch replaces; the checkpoint remembers the files taken.
    """

    def write(batch: DataFrame, number: int) -> None:
        normalize(batch).withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    stream = spark.readStream.schema(schema).format(format).option("maxFilesPerTrigger", files_per_batch).load(source)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def ingest_once(spark: SparkSession, source: str, schema: StructType, out: str, checkpoint: str, normalize, *, keys: list[str], time: str, late: str, format: str = "parquet", files_per_batch: int = 1000) -> None:
    """As ``ingest``, less the rows that were delivered before: of those with the same ``keys`` one passes.

    ``normalize`` is applied to the stream and keeps ``keys`` and the event time ``time``. The stream's state holds the keys until the event time has gone ``late`` further, so that it
    doesn't grow with the history; what comes again after that is caught by ``first_delivery`` at read.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    stream = spark.readStream.schema(schema).format(format).option("maxFilesPerTrigger", files_per_batch).load(source)
    once = normalize(stream).withWatermark(time, late).dropDuplicatesWithinWatermark(keys)
    once.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def first_delivery(long: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows that were delivered again the first delivery counts, by batch and source order."""
    return keep_first(long, keys, [F.col("batch"), F.col("src_ord")]).drop("batch")


def windowed_activity(stream: DataFrame, time: str, keys: list[str], window: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Counts and sums of a stream for each window and key; rows later than ``late`` are left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"))
