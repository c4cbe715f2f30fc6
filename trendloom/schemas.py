"""Table schemas and format versions.  Nothing in this package infers a schema."""

from __future__ import annotations

# Format versions of the four row shapes and of the table layout.
TREND_SCHEMA_VERSION = "1.0"
EXPLORE_SCHEMA_VERSION = "1.2"
COMPARISON_SCHEMA_VERSION = "1.1"
CHANGE_SCHEMA_VERSION = "1.0"
LAYOUT_VERSION = 1

# Change events, trending sources, explore sources.
CHANGE_EVENTS = ("new", "dropped", "volume_up", "volume_down", "rank_change")
TRENDING_SOURCES = ("rss", "csv")
EXPLORE_SOURCES = ("explore", "explore_comparison")

#: Natural key of a snapshot; there are no surrogate ids.
SNAPSHOT_KEY = ["source", "geo", "fetched_at"]

IMAGE = "STRUCT<url: STRING, source: STRING>"
NEWS = "ARRAY<STRUCT<headline: STRING, url: STRING, source: STRING, image: STRING>>"

#: One normalized trend inside a snapshot.
TREND_STRUCT = (
    "STRUCT<keyword: STRING, rank: INT, volume_text: STRING, volume_min: BIGINT,"
    " started_at: TIMESTAMP, started_at_raw: STRING, ended_at: TIMESTAMP, is_active: BOOLEAN,"
    f" related_queries: ARRAY<STRING>, news: {NEWS}, image: {IMAGE}, explore_url: STRING>"
)
TREND_FIELDS = [
    "keyword", "rank", "volume_text", "volume_min", "started_at", "started_at_raw", "ended_at",
    "is_active", "related_queries", "news", "image", "explore_url",
]

#: Header names of a trend export file, in file order.
EXPORT_COLUMNS = ["Trends", "Search volume", "Started", "Ended", "Trend breakdown", "Explore link"]
EXPORT_SCHEMA = ", ".join(f"`{name}` STRING" for name in EXPORT_COLUMNS)

#: Landed feed documents.
FEED_LANDING = "geo STRING, fetched_at TIMESTAMP, xml STRING"

#: Snapshots landed as JSON lines for the stream.
SNAPSHOT_LANDING = (
    "source STRING, geo STRING, fetched_at TIMESTAMP,"
    " trends ARRAY<STRUCT<keyword: STRING, rank: INT, volume_min: BIGINT>>"
)

#: Changes between two snapshots.
CHANGES = (
    "source STRING, geo STRING, fetched_at TIMESTAMP, event STRING, keyword STRING,"
    " rank INT, prev_rank INT, volume_min BIGINT, prev_volume_min BIGINT"
)
CHANGE_COLUMNS = [
    "source", "geo", "fetched_at", "event", "keyword", "rank", "prev_rank", "volume_min", "prev_volume_min",
]
