"""Explore and comparison answers, assembled from the payloads in their own row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import payloads as P
from ..schemas import COMPARISON_SCHEMA_VERSION, EXPLORE_SCHEMA_VERSION


def _column(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _with_payload(answers: DataFrame) -> DataFrame:
    body = [c for c in answers.columns if c != "answer_id"]
    return answers.withColumn("payload_json", F.to_json(F.struct(*body)))


def explore_answers(payloads: DataFrame) -> DataFrame:
    """Series, related queries and regions of one keyword per answer.

    ``is_empty`` means that no point of the series is above 0.
    """
    parsed = payloads.select(
        "answer_id", "keyword", "geo", "timeframe", "gprop", "fetched_at",
        P.series_points(F.col("series_json")).alias("interest_over_time"),
        P.related_rows(_column(payloads, "related_json")).alias("related"),
        P.region_rows(_column(payloads, "regions_json")).alias("interest_by_region"),
    )

    def bucket(name: str) -> Column:
        return F.filter("related", lambda r: r["bucket"] == name)

    return _with_payload(
        parsed.select(
            "answer_id",
            F.lit(EXPLORE_SCHEMA_VERSION).alias("schema_version"),
            F.lit("explore").alias("source"),
            "keyword", "geo", "timeframe", "gprop", "fetched_at",
            F.size("interest_over_time").alias("count"),
            (~F.exists("interest_over_time", lambda p: p["value"] != 0)).alias("is_empty"),
            "interest_over_time",
            bucket("top").alias("top"),
            bucket("rising").alias("rising"),
            "interest_by_region",
        )
    )


def comparison_answers(payloads: DataFrame) -> DataFrame:
    """Shared-scale series, averages and regions of 2 to 5 keywords per answer."""
    keywords = F.col("keywords")
    return _with_payload(
        payloads.select(
            "answer_id",
            F.lit(COMPARISON_SCHEMA_VERSION).alias("schema_version"),
            F.lit("explore_comparison").alias("source"),
            "keywords", "geo", "timeframe", "gprop", "fetched_at",
            P.comparison_averages(F.col("series_json"), keywords).alias("averages"),
            P.comparison_points(F.col("series_json"), keywords).alias("interest_over_time"),
            P.comparison_regions(_column(payloads, "regions_json"), keywords).alias("interest_by_region"),
        ).withColumn("count", (F.size("interest_over_time") / F.size("keywords")).cast("int"))
    )
