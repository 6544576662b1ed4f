"""Incremental ingestion: new parser files become blocks, micro-batch by micro-batch, with the batch functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.sinks.stores import replace_documents


def follow_blocks(spark: SparkSession, folder: str, schema: T.StructType, store: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df, trigger: dict | None = None):
    """A streaming query that applies transform to each micro-batch of block files and replaces their documents in the store. Redelivered rows and batches leave the store as it is."""

    def write(batch: DataFrame, _: int) -> None:
        replace_documents(spark, store, transform(batch.dropDuplicates(["block_id"])))

    stream = spark.readStream.schema(schema).parquet(folder)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def windowed_events(events: DataFrame, window: str = "1 hour", late: str = "30 minutes") -> DataFrame:
    """window_start, event_type, n, total of events per tumbling window; on a stream, rows later than ``late`` are left out, and an event_id counts once."""
    if events.isStreaming:
        events = events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])
    else:
        events = events.dropDuplicates(["event_id"])
    got = events.groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return got.select(F.col("window.start").alias("window_start"), "event_type", "n", "total")
