"""Keyword interest counted on a stream of events, in event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_COUNTS = "keyword STRING, ts TIMESTAMP, n BIGINT"


def bucket_stream(events: DataFrame, bucket: str = "1 day", delay: str = "1 day") -> DataFrame:
    """``keyword, ts, n``: uses of each keyword per bucket of ``events (keyword, ts)``, each bucket once.

    A bucket comes out when the watermark (the newest time less ``delay``) has passed its end; events
    that are older than that are dropped by Spark and show as dropped by watermark in the
    progress.  Counts combine before the shuffle, so a hot keyword sends one row per task and bucket.
    """
    at = F.window("ts", bucket)
    counted = events.withWatermark("ts", delay).groupBy("keyword", at.alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("keyword", F.col("w.start").alias("ts"), "n")


def start_counts(counts: DataFrame, path: str, checkpoint: str, interval: str | None = None):
    """Append closed buckets to a Parquet table through the file sink, each exactly once."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    writer = counts.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(**trigger).start()


def stored_counts(spark: SparkSession, path: str) -> DataFrame:
    """The buckets closed so far, as the sink's log commits them."""
    return spark.read.schema(_COUNTS).parquet(path)
