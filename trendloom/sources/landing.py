"""Landing directories as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import FEED_LANDING, SNAPSHOT_LANDING
from . import feed

#: Landed bytes per micro-batch, unless told otherwise.  Only throughput depends on it.
MAX_BYTES_PER_TRIGGER = "4g"


def _limited(spark: SparkSession, schema: str, max_files: int | None, max_bytes: str | None):
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        return reader.option("maxFilesPerTrigger", max_files)
    return reader if max_bytes is None else reader.option("maxBytesPerTrigger", max_bytes)


def _landed_at():
    return F.col("_metadata.file_modification_time").alias("landed_at")


def stream_snapshots(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = MAX_BYTES_PER_TRIGGER,
) -> DataFrame:
    """Stream of landed snapshots, one JSON line each, oldest file first, with ``landed_at``.

    A micro-batch ends at the file limit if one is given, else at the byte
    limit.  Without any limit (both ``None``) all that has landed is one micro-batch.
    """
    rows = _limited(spark, SNAPSHOT_LANDING, max_files_per_trigger, max_bytes_per_trigger).json(path)
    return rows.select("*", _landed_at())


def stream_feeds(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = MAX_BYTES_PER_TRIGGER,
) -> DataFrame:
    """Stream of landed feed documents (Parquet: ``geo, fetched_at, xml``) as snapshots, with ``landed_at``.

    Documents are parsed where they are, without a shuffle; unreadable ones are left out.
    """
    rows = _limited(spark, FEED_LANDING, max_files_per_trigger, max_bytes_per_trigger).parquet(path)
    return feed.feed_snapshot_rows(rows.select("*", _landed_at()))
