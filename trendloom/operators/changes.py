"""Changes between snapshots: new, dropped, volume_up, volume_down, rank_change.

Rules: keywords are compared exactly (case-sensitive), empty keywords are
ignored, the first position of a keyword in a snapshot counts, ranks keep the
gaps of the skipped positions, a volume change outranks a rank change and an
unchanged keyword gives no row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import CHANGE_COLUMNS, CHANGE_EVENTS, SNAPSHOT_KEY
from .sequence import neighbours


def same_key(left: DataFrame, right: DataFrame, key: Sequence[str], how: str = "inner") -> DataFrame:
    """A join on ``key`` in which NULL is a key like any other; the left side's key stays."""
    renamed = right.withColumnsRenamed({k: f"_of_{k}" for k in key})
    same = reduce(and_, [left[k].eqNullSafe(renamed[f"_of_{k}"]) for k in key])
    return left.join(renamed, same, how).drop(*[f"_of_{k}" for k in key])


def _event() -> Column:
    return (
        F.when(F.col("prev_rank").isNull(), "new")
        .when(F.col("rank").isNull(), "dropped")
        .when(F.col("volume_min") > F.col("prev_volume_min"), "volume_up")
        .when(F.col("volume_min") < F.col("prev_volume_min"), "volume_down")
        .when(F.col("rank") != F.col("prev_rank"), "rank_change")
    )


def _compare(sides: DataFrame, key: Sequence[str]) -> DataFrame:
    """Diff rows that carry ``is_prev``; one shuffle on (key, keyword).

    ``min``/``min_by`` pick the first position of a keyword on either side and
    combine before the shuffle, so repeats never travel.  Grouping includes the
    keyword: a hot geo or snapshot spreads over its keywords.
    """
    now, before = ~F.col("is_prev"), F.col("is_prev")

    def first(side: Column) -> tuple[Column, Column]:
        rank = F.when(side, F.col("rank"))
        return F.min(rank), F.min_by("volume_min", rank)

    rank, volume = first(now)
    prev_rank, prev_volume = first(before)
    return (
        sides.groupBy(*key, "keyword")
        .agg(
            rank.alias("rank"),
            prev_rank.alias("prev_rank"),
            volume.alias("volume_min"),
            prev_volume.alias("prev_volume_min"),
        )
        .withColumn("event", _event())
        .where(F.col("event").isNotNull())
    )


def _usable(trends: DataFrame, key: Sequence[str]) -> DataFrame:
    """Ranked, named trends; a missing volume counts as 0."""
    return trends.where((F.col("keyword") != "") & F.col("rank").isNotNull()).select(
        *key, "keyword", "rank", F.coalesce("volume_min", F.lit(0).cast("bigint")).alias("volume_min")
    )


def diff_snapshots(old: DataFrame, new: DataFrame, key: Sequence[str] = ("geo",)) -> DataFrame:
    """Changes from ``old`` to ``new``, compared within each ``key``.

    Either side may be empty for a key: then everything is new or dropped.
    """
    sides = _usable(old, key).withColumn("is_prev", F.lit(True)).unionByName(
        _usable(new, key).withColumn("is_prev", F.lit(False))
    )
    return _compare(sides, key).select(
        *key, "event", "keyword", "rank", "prev_rank", "volume_min", "prev_volume_min"
    )


def diff_history(trends: DataFrame, snapshots: DataFrame, bucket: str = "day") -> DataFrame:
    """Changes between all consecutive snapshots of every (source, geo).

    ``snapshots`` are the headers: an empty snapshot has no trends but still
    drops everything.  The first snapshot is the baseline and reports nothing.

    Each trend is sent to its own snapshot (as the current side, unless that is
    the baseline) and to the next one (as the previous side); both sides then
    meet in one aggregation instead of a deduplication and a self-join.
    """
    links = neighbours(snapshots.select(*SNAPSHOT_KEY), ["source", "geo"], "fetched_at", bucket)
    placed = same_key(_usable(trends, SNAPSHOT_KEY), links, SNAPSHOT_KEY)
    targets = F.array(
        F.struct(F.when(F.col("prev_at").isNotNull(), F.col("fetched_at")).alias("at"), F.lit(False).alias("is_prev")),
        F.struct(F.col("next_at").alias("at"), F.lit(True).alias("is_prev")),
    )
    sides = (
        placed.select("source", "geo", "keyword", "rank", "volume_min", F.inline(targets))
        .where(F.col("at").isNotNull())
        .withColumnRenamed("at", "fetched_at")
    )
    return _compare(sides, SNAPSHOT_KEY).select(CHANGE_COLUMNS)


def filter_changes(
    changes: DataFrame,
    min_volume: int | None = None,
    events: Sequence[str] | None = None,
    keywords: Sequence[str] | None = None,
) -> DataFrame:
    """Changes of interest.

    ``min_volume`` looks at the current volume, or the previous one of a dropped
    keyword.  ``keywords`` keeps keywords that contain one of the terms in any
    case; an empty list keeps all, while an empty ``events`` list keeps none.
    """
    if events is not None:
        changes = changes.where(F.col("event").isin(list(events))) if events else changes.where(F.lit(False))
    if min_volume is not None:
        volume = F.coalesce("volume_min", "prev_volume_min", F.lit(0))
        changes = changes.where(volume >= min_volume)
    if keywords:
        lowered = F.lower("keyword")
        hit = F.lit(False)
        for term in keywords:
            hit = hit | F.contains(lowered, F.lit(term.lower()))
        changes = changes.where(hit)
    return changes


def order_changes(changes: DataFrame) -> DataFrame:
    """Reading order: by snapshot, then current ranks, dropped ones last."""
    return changes.orderBy("source", "geo", "fetched_at", F.asc_nulls_last("rank"), "prev_rank")


def change_summary(snapshots: DataFrame, changes: DataFrame, bucket: str = "day") -> DataFrame:
    """Per snapshot: baseline flag, previous, current and change counts.

    ``snapshots`` must carry ``trend_count``; counts include every position of
    a snapshot, also blank and repeated keywords.
    """
    links = neighbours(
        snapshots.select(*SNAPSHOT_KEY, "trend_count"), ["source", "geo"], "fetched_at", bucket, carry=["trend_count"]
    )
    counted = changes.groupBy(*SNAPSHOT_KEY).agg(
        F.count(F.lit(1)).alias("change_count"),
        *[F.count_if(F.col("event") == e).alias(f"{e}_count") for e in CHANGE_EVENTS],
    )
    zero = F.lit(0).cast("bigint")
    return same_key(links, counted, SNAPSHOT_KEY, "left").select(
        *SNAPSHOT_KEY,
        F.col("prev_at").isNull().alias("baseline"),
        F.col("prev_trend_count").alias("previous_count"),
        F.col("trend_count").alias("current_count"),
        F.coalesce("change_count", zero).alias("change_count"),
        *[F.coalesce(f"{e}_count", zero).alias(f"{e}_count") for e in CHANGE_EVENTS],
    )
