"""Export files rendered from the orders and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import normalize, quality, reports
from ..schemas import EXPORT_COLUMNS
from ..session import shared_folder
from ..sources import export, feed
from ..sources.dims import SORT_OPTIONS
from .base import TREND_SNAP_SQL, flat, geo_of_customers, table
from .feeds import BROKEN_MONTH, EDITIONS_SQL, landing

CATEGORY_OF = {
    "AFRICA": "sports", "AMERICA": "business", "ASIA": "technology", "EUROPE": "travel", "MIDDLE EAST": "science",
}
_landed: dict[tuple[str, str], str] = {}


def _filed(spark: SparkSession, d: str) -> DataFrame:
    """Every order with the name of the file it belongs to: that of a region and month is 'exported' when the month ends."""
    orders = table(spark, d, "orders").join(geo_of_customers(spark, d), F.col("o_custkey") == F.col("c_custkey"))
    month_end = F.add_months(F.date_trunc("month", "o_orderdate"), 1)
    category = F.element_at(F.create_map(*[F.lit(v) for kv in CATEGORY_OF.items() for v in kv]), F.col("geo"))
    stem = F.concat(
        F.lit("trends_"), "geo", F.lit("_24h_"), category, F.lit("_"), F.date_format(month_end, "yyyyMMdd-HHmmss"), F.lit(".csv")
    )
    return orders.select(
        stem.alias("file"), "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )


def rendered(orders: DataFrame) -> DataFrame:
    """Filed orders as export rows.

    Started carries +3, -4 or no offset by order status, with a narrow no-break space
    in the last form; open orders have no end.
    """
    status = F.col("o_orderstatus")
    zone = F.when(status == "F", "UTC+3").when(status == "O", "UTC-4").otherwise("UTC")
    blank = F.when(status == "P", "\u202f").otherwise(" ")

    def clock(ts):
        return F.concat(
            F.date_format(ts, "MMMM d, yyyy 'at' h:mm:ss"), blank, F.date_format(ts, "a"), F.lit(" "), zone
        )

    ended = F.when(status != "O", clock(F.col("o_orderdate") + F.expr("INTERVAL 30 HOURS")))
    cells = [
        F.concat(F.lit('Order "'), F.col("o_orderpriority"), F.lit('", no. '), F.col("o_orderkey").cast("string")),
        F.concat(F.floor(F.col("o_totalprice") / 1000).cast("string"), F.lit("K+")),
        clock(F.col("o_orderdate")),
        ended,
        F.concat(F.lower("o_orderpriority"), F.lit(", , status "), status, F.lit(",customer "), F.col("o_custkey").cast("string")),
        F.concat(F.lit("./explore?q="), F.col("o_orderkey").cast("string")),
    ]
    return orders.select(
        "file", "o_orderkey", *[c.alias(n) for c, n in zip(cells, EXPORT_COLUMNS, strict=True)]
    )


def export_folder(spark: SparkSession, d: str) -> str:
    """The export files, written once per application and input."""
    at = (spark.sparkContext.applicationId, d)
    if at not in _landed:
        path = shared_folder(spark, "exports")
        filed = (
            _filed(spark, d)
            # one writer per file keeps its row order; the number keeps small inputs parallel, and several
            # shares per core let the cores even out what the files' hashes deal to each share
            .repartition(4 * spark.sparkContext.defaultParallelism, "file")
            .sortWithinPartitions("file", "o_orderkey")
        )
        (
            rendered(filed)  # orders move as they are and become text where they are written
            .drop("o_orderkey")
            .write.partitionBy("file")
            .options(header=True, escape='"')
            .csv(path)
        )
        _landed[at] = path
    return _landed[at]


def raw_exports(spark: SparkSession, d: str) -> DataFrame:
    return export.read_exports(spark, export_folder(spark, d))


def _mixed_folder(spark: SparkSession, d: str) -> str:
    """Export files of several layouts: columns of ASIA turned round with one more, EUROPE without the end."""
    path, rows = shared_folder(spark, "mixed-exports"), rendered(_filed(spark, d))
    layouts = {
        "ASIA": ["Note", *reversed(EXPORT_COLUMNS)], "EUROPE": [c for c in EXPORT_COLUMNS if c != "Ended"], None: EXPORT_COLUMNS,
    }
    of = F.regexp_extract("file", "^trends_([^_]+)_", 1)
    for geo, columns in layouts.items():
        some = rows.where(~of.isin("ASIA", "EUROPE") if geo is None else of == geo).withColumn("Note", F.lit("x, y"))
        (
            some.repartition(spark.sparkContext.defaultParallelism, "file").sortWithinPartitions("file", "o_orderkey")
            .select("file", *[F.col(f"`{c}`") for c in columns])
            .write.mode("append").partitionBy("file").options(header=True, escape='"').csv(path)
        )
    return path


def export_headers(spark: SparkSession, d: str) -> DataFrame:
    """Header row of every file, and what it lacks."""
    found = export.export_headers(spark, _mixed_folder(spark, d))
    return flat(found.select("geo", "fetched_at", *[F.array_join(c, "|").alias(c) for c in ("header", "missing", "extra")]))


def export_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Files whose header lacks a column."""
    return flat(export.export_quarantine(spark, _mixed_folder(spark, d)).select("geo", "hours", "category", "fetched_at", "reason"))


def export_by_name(spark: SparkSession, d: str) -> DataFrame:
    """Rows of files of several layouts, columns found by their names."""
    raw = export.read_exports_by_name(spark, _mixed_folder(spark, d))
    return flat(
        raw.select(
            "geo", "hours", "category", "fetched_at", "rank",
            F.col("Trends").alias("trend"), F.col("`Search volume`").alias("volume"), F.col("Started").alias("started"),
            F.col("Ended").alias("ended"), F.col("`Trend breakdown`").alias("breakdown"),
            F.col("`Explore link`").alias("link"),
        )
    )


def export_ingest(spark: SparkSession, d: str) -> DataFrame:
    return flat(
        raw_exports(spark, d).select(
            "geo", "hours", "category", "fetched_at", "rank",
            F.col("Trends").alias("trend"), F.col("`Search volume`").alias("volume"), F.col("Started").alias("started"),
            F.col("Ended").alias("ended"), F.col("`Trend breakdown`").alias("breakdown"),
            F.col("`Explore link`").alias("link"),
        )
    )


def export_normalized(spark: SparkSession, d: str) -> DataFrame:
    trends = normalize.normalize_export(raw_exports(spark, d))
    return flat(
        trends.select(
            "source", "geo", "fetched_at", "keyword", "rank", "volume_text", "volume_min", "started_at", "ended_at",
            "is_active", F.array_join("related_queries", "|").alias("related"), F.size("news").alias("news_count"),
            F.col("image").isNull().alias("no_image"), "explore_url",
        )
    )


def _with_category(spark: SparkSession, d: str) -> DataFrame:
    return normalize.normalize_export(raw_exports(spark, d), keep=["category"])


def export_filtered(spark: SparkSession, d: str) -> DataFrame:
    kept = reports.filter_export(_with_category(spark, d), hours=168, category="Sports", active_only=True)
    return flat(kept.select("geo", "fetched_at", "category", "keyword", "rank", "started_at"))


def export_by_volume(spark: SparkSession, d: str) -> DataFrame:
    """The order of the trends of each export when sorted by volume."""
    ordered = reports.sort_trends(normalize.normalize_export(raw_exports(spark, d)), "volume")
    return flat(ordered.select("source", "geo", "fetched_at", "rank", "keyword", "volume_min"))


def export_places(spark: SparkSession, d: str) -> DataFrame:
    """Place of each trend of an export under every sort option."""
    placed = reports.sort_places(_with_category(spark, d), keys=["source", "geo", "fetched_at", "category"])
    return flat(placed.select("geo", "fetched_at", "category", "rank", *[f"by_{o}" for o in SORT_OPTIONS]))


def export_top(spark: SparkSession, d: str) -> DataFrame:
    return flat(reports.top_export_rows(raw_exports(spark, d)))


def export_quality(spark: SparkSession, d: str) -> DataFrame:
    return flat(quality.export_quality(raw_exports(spark, d), minimum=20))


def all_trends(spark: SparkSession, d: str) -> DataFrame:
    """Feed and export trends in one table."""
    feeds = normalize.normalize_feed(feed.read_feeds(landing(spark, d)))
    both = normalize.union_trends(feeds, normalize.normalize_export(raw_exports(spark, d)))
    return flat(both.select("source", "geo", "fetched_at", "keyword", "rank", "volume_min", "started_at", "is_active"))


QUERIES = {
    "export_ingest": export_ingest,
    "export_headers": export_headers,
    "export_quarantine": export_quarantine,
    "export_by_name": export_by_name,
    "export_normalized": export_normalized,
    "export_filtered": export_filtered,
    "export_by_volume": export_by_volume,
    "export_places": export_places,
    "export_top": export_top,
    "export_quality": export_quality,
    "all_trends": all_trends,
}

_EXPORT_SQL = """
located AS (
  SELECT o.*, r_name AS geo,
         CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS TIMESTAMP) AS fetched_at,
         CASE r_name WHEN 'AFRICA' THEN 'sports' WHEN 'AMERICA' THEN 'business' WHEN 'ASIA' THEN 'technology'
                     WHEN 'EUROPE' THEN 'travel' ELSE 'science' END AS category,
         CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN -4 ELSE 0 END AS zone_hours,
         CASE o_orderstatus WHEN 'F' THEN ' UTC+3' WHEN 'O' THEN ' UTC-4' ELSE ' UTC' END AS zone,
         CASE o_orderstatus WHEN 'P' THEN chr(8239) ELSE ' ' END AS blank
  FROM orders o
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
),
exported AS (
  SELECT geo, category, fetched_at,
         CAST(row_number() OVER (PARTITION BY geo, fetched_at ORDER BY o_orderkey) AS INTEGER) AS rank,
         'Order "' || o_orderpriority || '", no. ' || o_orderkey AS trend,
         CAST(floor(o_totalprice / 1000) AS BIGINT) AS thousands,
         strftime(o_orderdate, '%B %-d, %Y at %-I:%M:%S') || blank || strftime(o_orderdate, '%p') || zone AS started,
         CASE WHEN o_orderstatus <> 'O' THEN
           strftime(o_orderdate + INTERVAL 30 HOUR, '%B %-d, %Y at %-I:%M:%S') || blank
           || strftime(o_orderdate + INTERVAL 30 HOUR, '%p') || zone END AS ended,
         o_orderdate - to_hours(zone_hours) AS started_at,
         CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 30 HOUR - to_hours(zone_hours) END AS ended_at,
         lower(o_orderpriority) AS priority, o_orderstatus, o_custkey, o_orderkey
  FROM located
)"""


def _export(body: str) -> str:
    return f"WITH {_EXPORT_SQL}\n{body}"


ORACLES = {
    "export_ingest": _export(
        """
SELECT geo, CAST(24 AS INTEGER) AS hours, category, fetched_at, rank, trend, thousands || 'K+' AS volume, started, ended,
       priority || ', , status ' || o_orderstatus || ',customer ' || o_custkey AS breakdown,
       './explore?q=' || o_orderkey AS link
FROM exported"""
    ),
    "export_by_name": _export(
        """
SELECT geo, CAST(24 AS INTEGER) AS hours, category, fetched_at, rank, trend, thousands || 'K+' AS volume, started, ended,
       priority || ', , status ' || o_orderstatus || ',customer ' || o_custkey AS breakdown,
       './explore?q=' || o_orderkey AS link
FROM exported WHERE geo <> 'EUROPE'"""
    ),
    "export_headers": _export(
        f"""
SELECT DISTINCT geo, fetched_at,
       CASE geo WHEN 'ASIA' THEN 'Note|{"|".join(reversed(EXPORT_COLUMNS))}'
                WHEN 'EUROPE' THEN '{"|".join(c for c in EXPORT_COLUMNS if c != "Ended")}'
                ELSE '{"|".join(EXPORT_COLUMNS)}' END AS header,
       CASE geo WHEN 'EUROPE' THEN 'Ended' ELSE '' END AS missing, CASE geo WHEN 'ASIA' THEN 'Note' ELSE '' END AS extra
FROM exported"""
    ),
    "export_quarantine": _export(
        """
SELECT DISTINCT geo, CAST(24 AS INTEGER) AS hours, category, fetched_at, 'no Ended' AS reason FROM exported
WHERE geo = 'EUROPE'"""
    ),
    "export_normalized": _export(
        """
SELECT 'csv' AS source, geo, fetched_at, trend AS keyword, rank, thousands || 'K+' AS volume_text,
       thousands * 1000 AS volume_min, started_at, ended_at, ended_at IS NULL AS is_active,
       priority || '|status ' || o_orderstatus || '|customer ' || o_custkey AS related,
       CAST(0 AS INTEGER) AS news_count, true AS no_image, './explore?q=' || o_orderkey AS explore_url
FROM exported"""
    ),
    "export_filtered": _export(
        """
SELECT geo, fetched_at, category, trend AS keyword, rank, started_at FROM exported
WHERE started_at >= fetched_at - INTERVAL 168 HOUR AND started_at <= fetched_at AND category = 'sports'
  AND ended_at IS NULL"""
    ),
    "export_by_volume": _export(
        "SELECT 'csv' AS source, geo, fetched_at, rank, trend AS keyword, thousands * 1000 AS volume_min FROM exported"
    ),
    "export_places": _export(
        """
SELECT geo, fetched_at, category, rank, rank AS by_relevance,
       CAST(row_number() OVER (PARTITION BY geo, fetched_at ORDER BY trend, rank) AS INTEGER) AS by_title,
       CAST(row_number() OVER (PARTITION BY geo, fetched_at ORDER BY thousands DESC, rank) AS INTEGER) AS by_volume,
       CAST(row_number() OVER (PARTITION BY geo, fetched_at ORDER BY started_at DESC, rank) AS INTEGER) AS by_recency
FROM exported"""
    ),
    "export_top": _export(
        """
SELECT geo, fetched_at, rank, trend AS keyword, thousands || 'K+' AS volume_text,
       priority || '|status ' || o_orderstatus AS terms
FROM exported WHERE rank <= 10"""
    ),
    "export_quality": _export(
        """
SELECT geo, fetched_at, count(*) AS row_count, count(*) AS started_count, CAST(0 AS BIGINT) AS bad_started,
       CAST(0 AS BIGINT) AS bad_ended, count(*) >= 20 AS passes
FROM exported GROUP BY geo, fetched_at"""
    ),
    "all_trends": f"""WITH {TREND_SNAP_SQL}, {EDITIONS_SQL}, {_EXPORT_SQL}
SELECT source, geo, fetched_at + to_minutes(edition) AS fetched_at, keyword, rank,
       CASE WHEN rank = 19 THEN 0 ELSE volume_min END AS volume_min,
       CASE WHEN rank <> 20 THEN fetched_at + to_minutes(edition) + INTERVAL 8 HOUR END AS started_at, true AS is_active
FROM trend_snap CROSS JOIN editions WHERE fetched_at <> TIMESTAMP '{BROKEN_MONTH}'
UNION ALL
SELECT 'csv', geo, fetched_at, trend, rank, thousands * 1000, started_at, ended_at IS NULL FROM exported""",
}
