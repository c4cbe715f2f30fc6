"""Trend feed documents (XML) to trend rows.

Input is a table of landed documents ``(geo, fetched_at, xml)`` that may hold
any number of geos, so loading many geos is the same job as loading one.  A
document is one row, hence the position of a trend inside it needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.times import feed_timestamp
from ..functions.volume import volume_min
from ..operators.normalize import feed_trend_fields
from ..schemas import NEWS, TREND_SCHEMA_VERSION, TREND_STRUCT

# Fixed value: prefix of the look-up link of a trend (the term is not encoded).
EXPLORE_LINK = "https://trends.google.com/trends/explore?q="

_CORRUPT = "_corrupt_record"
_DOCUMENT = (
    "channel STRUCT<item: ARRAY<STRUCT<title: STRING, approx_traffic: STRING, pubDate: STRING,"
    " picture: STRING, picture_source: STRING, news_item: ARRAY<STRUCT<news_item_title: STRING,"
    " news_item_url: STRING, news_item_source: STRING, news_item_picture: STRING>>>>>,"
    f" {_CORRUPT} STRING"
)
_OPTIONS = {
    "ignoreNamespace": "true",  # drops the element prefix
    "ignoreSurroundingSpaces": "false",  # texts are kept as delivered
    "columnNameOfCorruptRecord": _CORRUPT,
}


def _parsed(landing: DataFrame) -> DataFrame:
    return landing.withColumn("doc", F.from_xml("xml", _DOCUMENT, _OPTIONS))


def _keep(condition: Column, *fields: Column) -> Column:
    """``fields`` as a generated row where ``condition`` holds.

    A ``where`` on the parsed document would be pushed below the parse and
    parse every document twice; a generator on the parsed column does not.
    """
    return F.inline(F.when(condition, F.array(F.struct(*fields))))


def _is_bad(doc: Column) -> Column:
    return doc.isNull() | doc[_CORRUPT].isNotNull()


def raw_trend_fields(
    item: Column,
    geo: Column,
    include_images: bool = True,
    include_articles: bool = True,
    max_articles: int = 5,
) -> list[Column]:
    """The fields of one raw trend, from a feed item.

    A missing title or volume reads ``N/A``, a present but empty one stays
    empty.  The look-up link of an empty title carries ``None`` as its term.
    """
    traffic = F.coalesce(item["approx_traffic"], F.lit("N/A"))
    term = F.when(item["title"] == "", F.lit("None")).otherwise(F.coalesce(item["title"], F.lit("N/A")))
    published = feed_timestamp(item["pubDate"])
    fields = [
        F.coalesce(item["title"], F.lit("N/A")).alias("trend"),
        traffic.alias("traffic"),
        volume_min(traffic).alias("traffic_min"),
        published.alias("published"),
        F.nullif(item["pubDate"], F.lit("")).alias("published_raw"),
        F.concat(F.lit(EXPLORE_LINK), term, F.lit("&geo="), geo, F.lit("&hl=en-US")).alias("explore_link"),
    ]
    if include_images:
        fields.append(
            F.struct(
                F.nullif(item["picture"], F.lit("")).alias("url"),
                F.nullif(item["picture_source"], F.lit("")).alias("source"),
            ).alias("image")
        )
    if include_articles:
        articles = F.transform(
            F.slice(item["news_item"], 1, max_articles),
            lambda n: F.struct(
                F.nullif(n["news_item_title"], F.lit("")).alias("headline"),
                F.nullif(n["news_item_url"], F.lit("")).alias("url"),
                F.nullif(n["news_item_source"], F.lit("")).alias("source"),
                F.nullif(n["news_item_picture"], F.lit("")).alias("image"),
            ),
        )
        fields.append(F.coalesce(articles, F.array().cast(NEWS)).alias("news_articles"))
    return fields


def read_feeds(
    landing: DataFrame,
    include_images: bool = True,
    include_articles: bool = True,
    max_articles: int = 5,
) -> DataFrame:
    """Raw trend rows in document order: ``geo, fetched_at, rank, trend, ...``.

    Documents that are not well-formed are left out here and listed by
    :func:`rejected_feeds`; they never fail the job.
    """
    if max_articles < 0:
        raise ValueError("max_articles must not be negative")
    fields = raw_trend_fields(F.col("item"), F.col("geo"), include_images, include_articles, max_articles)
    return (
        _parsed(landing)
        # outer + a filter on the generated position: an inner explode would get
        # a filter on the array inferred below the parse.  A rejected document
        # and one without items both give no array.
        .select("geo", "fetched_at", F.posexplode_outer("doc.channel.item").alias("pos", "item"))
        .where(F.col("pos").isNotNull())
        .select("geo", "fetched_at", (F.col("pos") + 1).alias("rank"), *fields)
    )


def feed_envelopes(landing: DataFrame) -> DataFrame:
    """Normalized envelopes, one per readable document, without any shuffle.

    The trends of a document are normalized where they are, inside its row.
    """
    raw_names = ["trend", "traffic", "traffic_min", "published", "published_raw", "explore_link", "image",
                 "news_articles"]
    raws = F.transform(F.col("doc.channel.item"), lambda item: F.struct(*raw_trend_fields(item, F.col("geo"))))
    trends = F.transform(
        raws, lambda r, i: F.struct(*feed_trend_fields({n: r[n] for n in raw_names}, (i + 1).cast("int")))
    )
    version, source = F.lit(TREND_SCHEMA_VERSION), F.lit("rss")
    return (
        _parsed(landing)
        .select(
            source.alias("source"),
            "geo",
            "fetched_at",
            _keep(~_is_bad(F.col("doc")), F.coalesce(trends, F.array().cast(f"array<{TREND_STRUCT}>")).alias("trends")),
        )
        .select("source", "geo", "fetched_at", version.alias("schema_version"), F.size("trends").alias("count"), "trends")
        .withColumn(
            "payload_json",
            F.to_json(F.struct("schema_version", "source", "geo", "fetched_at", "count", "trends")),
        )
    )


def feed_snapshot_rows(landing: DataFrame) -> DataFrame:
    """Snapshots as a watch takes them: ``source, geo, fetched_at, trends, landed_at``, one per readable document."""
    trends = F.transform(
        F.col("doc.channel.item"),
        lambda item, i: F.struct(
            F.coalesce(item["title"], F.lit("N/A")).alias("keyword"),
            (i + 1).cast("int").alias("rank"),
            volume_min(F.coalesce(item["approx_traffic"], F.lit("N/A"))).cast("bigint").alias("volume_min"),
        ),
    )
    none = F.array().cast("array<struct<keyword:string,rank:int,volume_min:bigint>>")
    return _parsed(landing).select(
        F.lit("rss").alias("source"),
        "geo",
        "fetched_at",
        _keep(~_is_bad(F.col("doc")), F.coalesce(trends, none).alias("trends")),
        "landed_at",
    )


def feed_snapshots(landing: DataFrame) -> DataFrame:
    """One header per readable document, also for a feed without items."""
    items = F.greatest(F.coalesce(F.size("doc.channel.item"), F.lit(0)), F.lit(0))
    return _parsed(landing).select(
        F.lit("rss").alias("source"),
        "geo",
        "fetched_at",
        _keep(~_is_bad(F.col("doc")), items.alias("trend_count")),
    )


def rejected_feeds(landing: DataFrame) -> DataFrame:
    """Quarantine: documents that could not be parsed, with their text."""
    return _parsed(landing).select(
        "geo",
        "fetched_at",
        "xml",
        _keep(_is_bad(F.col("doc")), F.lit("not well-formed").alias("reason")),
    )
