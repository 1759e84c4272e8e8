"""Incremental ingest: fields of view are processed as their files arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def watch(spark: SparkSession, folder: str, schema: str, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run ``handle`` on the rows of every batch of new Parquet files under ``folder``, until none is left."""
    rows = spark.readStream.schema(schema).parquet(folder)
    return rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, by: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(window start, by, n) over event time, rows later than ``late`` left out; for streams and tables alike."""
    timed = events.withColumn("_t", F.col(time).cast("timestamp"))
    if events.isStreaming:
        timed = timed.withWatermark("_t", late)
    return timed.groupBy(F.window("_t", width).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")
