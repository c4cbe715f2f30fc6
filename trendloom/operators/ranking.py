"""Ranked snapshots from raw keyword events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..schemas import SNAPSHOT_KEY


def ranked_snapshots(events: DataFrame, period: str = "month", k: int = 20, source: str = "rss") -> DataFrame:
    """Top-``k`` keywords by count per geo and period of ``events(geo, ts, keyword)``.

    Counts are combined before the shuffle, and the rank filter reaches below
    the window shuffle as a group limit, so no geo ships more than ``k`` rows
    per task into its window.
    """
    counts = (
        events.groupBy("geo", F.date_trunc(period, "ts").alias("fetched_at"), "keyword")
        .agg(F.count(F.lit(1)).alias("volume_min"), F.min("ts").cast("timestamp").alias("started_at"))
    )
    order = Window.partitionBy("geo", "fetched_at").orderBy(F.desc("volume_min"), "keyword")
    return (
        counts.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select(
            F.lit(source).alias("source"),
            "geo",
            "fetched_at",
            "keyword",
            "rank",
            F.concat(F.col("volume_min").cast("string"), F.lit("+")).alias("volume_text"),
            "volume_min",
            "started_at",
        )
    )


def snapshot_headers(trends: DataFrame) -> DataFrame:
    """Headers of the snapshots that have at least one trend."""
    return trends.groupBy(*SNAPSHOT_KEY).agg(F.count(F.lit(1)).cast("int").alias("trend_count"))
