"""Explore payloads (JSON) to long tables.

Input: one row per answer with ``answer_id, geo, timeframe, gprop`` plus
``keyword`` (single) or ``keywords`` (comparison) and the payload columns
``series_json``, ``related_json``, ``regions_json``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import payloads as P


def read_interest(answers: DataFrame) -> DataFrame:
    """Interest series of single-keyword answers, ``pos`` = delivered order."""
    return answers.select(
        "answer_id", "keyword", "geo", "timeframe", "gprop",
        F.posexplode(P.series_points(F.col("series_json"))).alias("pos", "p"),
    ).select("answer_id", "keyword", "geo", "timeframe", "gprop", (F.col("pos") + 1).alias("pos"), "p.*")


def read_related(answers: DataFrame) -> DataFrame:
    """Related queries in long form with ``bucket`` and ``pos``."""
    return answers.select("answer_id", "keyword", F.inline(P.related_rows(F.col("related_json"))))


def read_regions(answers: DataFrame) -> DataFrame:
    """Regional interest, regions without data dropped."""
    return answers.select("answer_id", "keyword", F.inline(P.region_rows(F.col("regions_json"))))


def read_comparison(answers: DataFrame) -> DataFrame:
    """Shared-scale series, one row per time and keyword."""
    return answers.select(
        "answer_id", F.inline(P.comparison_points(F.col("series_json"), F.col("keywords")))
    )


def read_averages(answers: DataFrame) -> DataFrame:
    """Delivered averages, one row per keyword."""
    return answers.select(
        "answer_id", F.inline(P.comparison_averages(F.col("series_json"), F.col("keywords")))
    )


def read_comparison_regions(answers: DataFrame) -> DataFrame:
    """Regions of comparisons, one row per region and keyword, plus the winner."""
    rows = answers.select(
        "answer_id", "keywords", F.inline(P.comparison_regions(F.col("regions_json"), F.col("keywords")))
    )
    return rows.select(
        "answer_id", "geo_code", "geo_name", "top_keyword",
        F.inline(F.arrays_zip(F.col("keywords").alias("keyword"), F.col("keyword_values").alias("value"))),
    )


def rejected_payloads(answers: DataFrame) -> DataFrame:
    """Quarantine: answers with a delivered payload that is not a JSON object."""
    columns = [c for c in ("series_json", "related_json", "regions_json") if c in answers.columns]
    bad = F.filter(
        F.array(*[F.when(P.is_bad_payload(F.col(c)), F.lit(c)) for c in columns]), lambda c: c.isNotNull()
    )
    return answers.withColumn("bad_payloads", bad).where(F.size("bad_payloads") > 0)
