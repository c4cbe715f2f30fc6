"""Snapshot envelopes: header plus the trends of one snapshot in rank order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from ..schemas import SNAPSHOT_KEY, TREND_FIELDS, TREND_SCHEMA_VERSION


def assemble(
    trends: DataFrame,
    fields: Sequence[str] = tuple(TREND_FIELDS),
    key: Sequence[str] = tuple(SNAPSHOT_KEY),
    headers: DataFrame | None = None,
) -> DataFrame:
    """``key..., count, trends[]``: each snapshot whole, in rank order, trends without rank last.

    ``headers`` names all snapshots by ``key``, so that those without any trend
    get an envelope with count 0.  A snapshot is one payload by nature; its
    size is that of the document it came from.
    """
    # rank leads the sorted struct; the nested row keeps the order of ``fields``
    entry = F.struct(F.coalesce("rank", F.lit(2**31 - 1)).alias("_rank"), F.struct(*fields).alias("trend"))
    ordered = F.array_sort(
        F.collect_list(entry),
        lambda a, b: F.when(a["_rank"] < b["_rank"], -1).when(a["_rank"] > b["_rank"], 1).otherwise(0),
    )
    packed = trends.groupBy(*key).agg(F.transform(ordered, lambda e: e["trend"]).alias("trends"))
    if headers is not None:
        named = headers.select(*[F.col(k).alias(f"_of_{k}") for k in key]).distinct()
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in key])
        packed = named.join(packed, same, "full_outer").select(
            *[F.coalesce(k, f"_of_{k}").alias(k) for k in key],
            F.coalesce("trends", F.array().cast(packed.schema["trends"].dataType)).alias("trends"),
        )
    return packed.select(*key, F.size("trends").alias("count"), "trends")


def snapshot_envelopes(trends: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """Normalized envelopes with their schema version and payload text."""
    return (
        assemble(trends, headers=headers)
        .withColumn("schema_version", F.lit(TREND_SCHEMA_VERSION))
        .withColumn(
            "payload_json",
            F.to_json(F.struct("schema_version", "source", "geo", "fetched_at", "count", "trends")),
        )
    )


def plain_envelopes(raw: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """``geo, fetched_at, count, trends[]`` around raw rows of either path."""
    fields = [f"`{c}`" for c in raw.columns if c not in ("geo", "fetched_at", "hours", "category", "source")]
    return assemble(raw, fields=fields, key=["geo", "fetched_at"], headers=headers)
