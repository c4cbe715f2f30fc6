"""Raw trend rows to the one normalized schema, and projections of it."""

from __future__ import annotations

from collections.abc import Sequence

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import clean, split_list
from ..functions.times import export_timestamp
from ..functions.volume import volume_min
from ..schemas import IMAGE, NEWS, TREND_FIELDS

MAX_COMPARE_GEOS = 20


def _news(articles: Column) -> Column:
    return F.transform(
        articles,
        lambda a: F.struct(
            a["headline"].alias("headline"),
            a["url"].alias("url"),
            a["source"].alias("source"),
            clean(a["image"]).alias("image"),
        ),
    )


def feed_trend_fields(raw: Mapping[str, Column], rank: Column) -> list[Column]:
    """The normalized fields of one raw feed trend."""
    image = F.when(F.length(raw["image"]["url"]) > 0, raw["image"]) if "image" in raw else F.lit(None).cast(IMAGE)
    news = F.array().cast(NEWS)
    if "news_articles" in raw:
        news = F.coalesce(_news(raw["news_articles"]), news)
    fields = {
        "keyword": F.coalesce(raw["trend"], F.lit("")),
        "rank": rank,
        "volume_text": F.coalesce(raw["traffic"], F.lit("")),
        "volume_min": F.coalesce(raw["traffic_min"], F.lit(0).cast("bigint")),
        "started_at": raw["published"],
        "started_at_raw": raw["published_raw"],
        "ended_at": F.lit(None).cast("timestamp"),
        "is_active": F.lit(True),
        "related_queries": F.array().cast("array<string>"),
        "news": news,
        "image": image,
        "explore_url": F.coalesce(raw["explore_link"], F.lit("")),
    }
    return [column.alias(name) for name, column in fields.items()]


def normalize_feed(raw: DataFrame) -> DataFrame:
    """Raw feed rows to normalized trends.

    Divergence on purpose: a date text that cannot be read stays in
    ``started_at_raw`` and leaves ``started_at`` NULL.  A feed only lists
    current trends, so ``ended_at`` is NULL and the related queries are empty.
    """
    fields = feed_trend_fields({c: F.col(c) for c in raw.columns}, F.col("rank"))
    return raw.select(F.lit("rss").alias("source"), "geo", "fetched_at", *fields)


def normalize_export(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Raw export rows to normalized trends; ``is_active`` means no end time.

    ``keep`` names further columns to carry along, such as ``hours`` and ``category``.
    """
    volume_text = F.coalesce(clean(F.col("`Search volume`")), F.lit(""))
    ended = export_timestamp(F.col("Ended"))
    return raw.select(
        F.lit("csv").alias("source"),
        "geo",
        "fetched_at",
        F.coalesce(clean(F.col("Trends")), F.lit("")).alias("keyword"),
        "rank",
        volume_text.alias("volume_text"),
        volume_min(volume_text).alias("volume_min"),
        export_timestamp(F.col("Started")).alias("started_at"),
        clean(F.col("Started")).alias("started_at_raw"),
        ended.alias("ended_at"),
        ended.isNull().alias("is_active"),
        split_list(F.col("`Trend breakdown`")).alias("related_queries"),
        F.array().cast(NEWS).alias("news"),
        F.lit(None).cast(IMAGE).alias("image"),
        F.coalesce(clean(F.col("`Explore link`")), F.lit("")).alias("explore_url"),
        *keep,
    )


def union_trends(*trends: DataFrame) -> DataFrame:
    """Trends of several paths in one table."""
    columns = ["source", "geo", "fetched_at", *TREND_FIELDS]
    first, *rest = [t.select(columns) for t in trends]
    for other in rest:
        first = first.unionByName(other)
    return first


def compact(trends: DataFrame, geos: Sequence[str] | None = None, within: Column | None = None) -> DataFrame:
    """Keyword, rank, volume and activity only; optionally for 1 to 20 geos.

    ``within`` is what the geos name, by default the geo itself; with the region of a geo, all of a region's geos are kept.
    """
    if geos is not None:
        if not 1 <= len(geos) <= MAX_COMPARE_GEOS:
            raise ValueError(f"pass 1 to {MAX_COMPARE_GEOS} geos, got {len(geos)}")
        trends = trends.where((F.col("geo") if within is None else within).isin(list(geos)))
    return trends.select("source", "geo", "fetched_at", "keyword", "rank", "volume_min", "is_active")


def flatten_feed(raw: DataFrame) -> DataFrame:
    """Raw feed rows without nesting: image fields, article count, top article."""
    columns = ["geo", "fetched_at", "rank", "trend", "traffic", "traffic_min", "published", "explore_link"]
    out = [F.col(c) for c in columns]
    if "image" in raw.columns:
        out += [F.col("image.url").alias("image_url"), F.col("image.source").alias("image_source")]
    if "news_articles" in raw.columns:
        top = F.try_element_at("news_articles", F.lit(1))
        out += [F.size("news_articles").alias("article_count")]
        out += [top[f].alias(f"top_article_{f}") for f in ("headline", "url", "source")]
    return raw.select(out)


def flatten_trends(trends: DataFrame) -> DataFrame:
    """One row per trend with the seven columns of the archive table view."""
    return trends.select("fetched_at", "geo", "source", "keyword", "rank", "volume_min", "volume_text")
