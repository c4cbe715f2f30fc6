"""Feed documents built from the snapshots and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators import envelopes, normalize, quality, reports
from ..session import materialize, shared_folder
from ..sinks import files
from ..sources import feed
from .base import TREND_SNAP_SQL, flat, landed_snap, table

OUTLETS = {"src0": "CNN", "src1": "BBC", "src2": "Reuters"}
OPENERS = {"de": "Breaking: ", "fr": "Update: "}
BROKEN_MONTH = "2000-01-01"
#: Articles that a trend gets in one feed document.  Further ones come in later editions of the document, so that
#: documents of bounded size become more as articles do.
PER_EDITION = 4


def _mapped(column: Column, table_: dict[str, str], default: Column) -> Column:
    out = default
    for key, value in table_.items():
        out = F.when(column == key, F.lit(value)).otherwise(out)
    return out


def _escape(text: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def _tag(name: str, text: Column) -> Column:
    """An element, or nothing when the text is NULL."""
    return F.coalesce(F.concat(F.lit(f"<{name}>"), _escape(text), F.lit(f"</{name}>")), F.lit(""))


def _articles(spark: SparkSession, d: str) -> DataFrame:
    """Documents as news articles: outlet, the whole text in one line as headline."""
    docs = table(spark, d, "documents")
    headline = F.concat(_mapped(F.col("lang"), OPENERS, F.lit("")), F.replace("text", F.lit("\n"), F.lit(" ")))
    return docs.select(
        "doc_id",
        headline.alias("headline"),
        F.concat(F.lit("https://news.example/"), F.col("doc_id").cast("string")).alias("url"),
        _mapped(F.col("source"), OUTLETS, F.col("source")).alias("outlet"),
    )


_landed: dict[tuple[str, str], DataFrame] = {}


def landing(spark: SparkSession, d: str) -> DataFrame:
    """The landed feed documents, written once per application and input."""
    at = (spark.sparkContext.applicationId, d)
    if at not in _landed:
        _landed[at] = materialize(spark, rendered(spark, d), "feeds")
    return _landed[at]


def rendered(spark: SparkSession, d: str) -> DataFrame:
    """One feed document per area, month and edition; editions are a minute apart.

    Rank 18 has no picture, 19 no volume, 20 a date in another form.  Every
    document is an article of one trend in one edition: they are dealt out by
    their id.  The documents of one month are cut off and must end in quarantine.
    """
    trends, headers = landed_snap(spark, d)
    # Trends are numbered by month, area and rank: sums within a month, and over the few months.
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda w: F.coalesce(F.sum("trend_count").over(before(w)), F.lit(0))
    months = headers.groupBy("fetched_at").agg(F.sum("trend_count").alias("trend_count"))
    months = months.select("fetched_at", so_far(Window.orderBy("fetched_at")).alias("month_offset"))
    offsets = headers.join(F.broadcast(months), "fetched_at").select(
        "geo", "fetched_at", (F.col("month_offset") + so_far(Window.partitionBy("fetched_at").orderBy("geo"))).alias("offset")
    )
    trends = trends.join(offsets, ["geo", "fetched_at"]).withColumn("number", F.col("offset") + F.col("rank") - 1)
    total = headers.agg(F.sum("trend_count").cast("bigint")).scalar()
    edition = F.floor(F.col("doc_id") / (total * PER_EDITION)).cast("int")
    number = F.pmod(F.pmod(F.col("doc_id"), total) * 7919, total)
    dealt = _articles(spark, d).withColumns({"number": number, "edition": edition, "nth": F.col("doc_id")})
    last = F.coalesce(table(spark, d, "documents").agg(F.max("doc_id")).scalar(), F.lit(0))
    editions = F.explode(F.sequence(F.lit(0), F.floor(last / (total * PER_EDITION)).cast("int")))
    trends = trends.withColumn("month", F.col("fetched_at")).withColumn("edition", editions)
    trends = trends.withColumn("fetched_at", F.col("month") + F.make_dt_interval(mins=F.col("edition")))
    wanted = trends.select("geo", "fetched_at", "rank", "number", "edition")
    news = (
        wanted.join(dealt, ["number", "edition"])
        .select(
            "geo", "fetched_at", "rank", "nth",
            F.concat(
                F.lit("<ht:news_item>"),
                _tag("ht:news_item_title", F.col("headline")),
                _tag("ht:news_item_url", F.col("url")),
                _tag("ht:news_item_source", F.col("outlet")),
                F.lit("</ht:news_item>"),
            ).alias("item"),
        )
        .groupBy("geo", "fetched_at", "rank")  # the articles of one feed item
        .agg(F.array_sort(F.collect_list(F.struct("nth", "item"))).alias("items"))
        .select("geo", "fetched_at", "rank", F.array_join(F.transform("items", lambda i: i["item"]), "").alias("news"))
    )
    listed = trends.join(news, ["geo", "fetched_at", "rank"], "left").select(
        "geo", "month", "fetched_at", F.struct("rank", "keyword", "volume_text", "news").alias("trend")
    )

    def item(trend: Column) -> Column:
        day = F.date_format("fetched_at", "EEE, d MMM yyyy HH:mm:ss")
        date = F.when(trend["rank"] == 20, F.date_format("fetched_at", "yyyy/MM/dd")).otherwise(F.concat(day, F.lit(" -0800")))
        picture = F.when(trend["rank"] != 18, F.concat(F.lit("https://img.example/?a=1&k="), trend["keyword"]))
        return F.concat(
            F.lit("<item>"),
            _tag("title", trend["keyword"]),
            _tag("ht:approx_traffic", F.when(trend["rank"] != 19, trend["volume_text"])),
            _tag("pubDate", date),
            _tag("ht:picture", picture),
            _tag("ht:picture_source", F.lit("Example & Co")),
            F.coalesce(trend["news"], F.lit("")),
            F.lit("</item>"),
        )

    head = '<?xml version="1.0" encoding="UTF-8"?><rss xmlns:ht="https://trends.google.com/trending/rss"><channel>'
    broken = F.col("month") == F.lit(BROKEN_MONTH).cast("timestamp")
    return (
        listed.groupBy("geo", "month", "fetched_at")  # at most 20 trends per document
        # the trends meet as they are and become XML inside the document's row
        .agg(F.array_sort(F.collect_list("trend")).alias("trends"))
        .select(
            "geo",
            "fetched_at",
            F.concat(
                F.lit(head),
                F.array_join(F.transform("trends", item), ""),
                F.when(broken, "").otherwise("</channel></rss>"),
            ).alias("xml"),
        )
    )


_NEWS_TEXT = lambda c: F.array_join(
    F.transform(c, lambda a: F.concat_ws("~", a["headline"], a["url"], a["source"])), "|"
)


def feed_ingest(spark: SparkSession, d: str) -> DataFrame:
    raw = feed.read_feeds(landing(spark, d))
    return flat(
        raw.select(
            "geo", "fetched_at", "rank", "trend", "traffic", "traffic_min", "published", "published_raw", "explore_link",
            F.col("image.url").alias("image_url"), F.col("image.source").alias("image_source"),
            F.size("news_articles").alias("article_count"), _NEWS_TEXT("news_articles").alias("articles"),
        )
    )


def feed_quarantine(spark: SparkSession, d: str) -> DataFrame:
    return flat(feed.rejected_feeds(landing(spark, d)).select("geo", "fetched_at", "reason"))


def feed_snapshots(spark: SparkSession, d: str) -> DataFrame:
    return flat(feed.feed_snapshots(landing(spark, d)))


def feed_envelopes(spark: SparkSession, d: str) -> DataFrame:
    packed = feed.feed_envelopes(landing(spark, d))
    return flat(
        packed.select(
            "source", "geo", "fetched_at", "schema_version", "count",
            F.array_join(F.transform("trends", lambda t: t["keyword"]), "|").alias("keywords"),
            F.aggregate("trends", F.lit(0).cast("bigint"), lambda a, t: a + t["volume_min"]).alias("volume_sum"),
        )
    )


def feed_normalized(spark: SparkSession, d: str) -> DataFrame:
    trends = normalize.normalize_feed(feed.read_feeds(landing(spark, d)))
    return flat(
        trends.select(
            "source", "geo", "fetched_at", "keyword", "rank", "volume_text", "volume_min", "started_at", "ended_at",
            "is_active", F.size("related_queries").alias("related_count"), F.size("news").alias("news_count"),
            F.col("image.url").alias("image_url"), "explore_url",
        )
    )


def feed_flat(spark: SparkSession, d: str) -> DataFrame:
    return flat(normalize.flatten_feed(feed.read_feeds(landing(spark, d))))


def feed_slim(spark: SparkSession, d: str) -> DataFrame:
    """Without images and with two articles per trend at most."""
    raw = feed.read_feeds(landing(spark, d), include_images=False, max_articles=2)
    return flat(normalize.flatten_feed(raw))


def feed_plain_envelopes(spark: SparkSession, d: str) -> DataFrame:
    packed = envelopes.plain_envelopes(feed.read_feeds(landing(spark, d)))
    return flat(
        packed.select(
            "geo", "fetched_at", "count", F.array_join(F.transform("trends", lambda t: t["trend"]), "|").alias("trend_list")
        )
    )


def feed_quality(spark: SparkSession, d: str) -> DataFrame:
    landed = landing(spark, d)
    return flat(quality.feed_quality(feed.read_feeds(landed), feed.feed_snapshots(landed)))


def article_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Articles per region without a limit: every document of a readable feed, once and whole."""
    raw = feed.read_feeds(landing(spark, d), max_articles=2**31 - 1)
    each = raw.select("geo", F.explode("news_articles").alias("a"))
    return each.groupBy("geo").agg(
        F.count("*").alias("articles"), F.countDistinct("a.url").alias("documents"), F.sum(F.length("a.headline")).alias("characters")
    )


def traffic_distribution(spark: SparkSession, d: str) -> DataFrame:
    return reports.traffic_distribution(feed.read_feeds(landing(spark, d)))


def coverage_report(spark: SparkSession, d: str) -> DataFrame:
    report = reports.coverage(feed.read_feeds(landing(spark, d)))
    return report.withColumn("mean_articles", F.round("mean_articles", 6))


def high_traffic(spark: SparkSession, d: str) -> DataFrame:
    return flat(reports.high_traffic(feed.read_feeds(landing(spark, d)), minimum=3, n=50))


def story_report(spark: SparkSession, d: str) -> DataFrame:
    return flat(reports.story_report(feed.read_feeds(landing(spark, d))))


def csv_sink(spark: SparkSession, d: str) -> DataFrame:
    """Flat feed rows written as CSV and read back."""
    path = shared_folder(spark, "csv-sink")
    rows = normalize.flatten_feed(feed.read_feeds(landing(spark, d)))
    files.write_csv(rows, path, compression="gzip")
    back = spark.read.schema(rows.schema).options(header=True, escape='"', multiLine=True).csv(path)
    return flat(back.select("geo", "fetched_at", "rank", "trend", "traffic_min", "published", "top_article_headline"))


def json_sink(spark: SparkSession, d: str) -> DataFrame:
    path = shared_folder(spark, "json-sink")
    rows = normalize.normalize_feed(feed.read_feeds(landing(spark, d)))
    files.write_json(rows, path, compression="gzip")
    back = spark.read.schema(rows.schema).json(path)
    return flat(back.select("geo", "fetched_at", "keyword", "rank", "volume_min", "started_at", F.size("news").alias("news_count")))


def parquet_sink(spark: SparkSession, d: str) -> DataFrame:
    path = shared_folder(spark, "parquet-sink")
    files.write_parquet(normalize.normalize_feed(feed.read_feeds(landing(spark, d))), path, partition_by=["geo"])
    back = spark.read.parquet(path)
    return flat(back.select("geo", "fetched_at", "keyword", "rank", "volume_min", "started_at", F.size("news").alias("news_count")))


QUERIES = {
    "feed_ingest": feed_ingest,
    "feed_quarantine": feed_quarantine,
    "feed_snapshots": feed_snapshots,
    "feed_envelopes": feed_envelopes,
    "feed_normalized": feed_normalized,
    "feed_flat": feed_flat,
    "feed_slim": feed_slim,
    "feed_plain_envelopes": feed_plain_envelopes,
    "feed_quality": feed_quality,
    "article_coverage": article_coverage,
    "traffic_distribution": traffic_distribution,
    "coverage_report": coverage_report,
    "high_traffic": high_traffic,
    "story_report": story_report,
    "csv_sink": csv_sink,
    "json_sink": json_sink,
    "parquet_sink": parquet_sink,
}

EDITIONS_SQL = f"""editions AS (
  SELECT unnest(range(0, coalesce((SELECT max(doc_id) FROM documents), 0)
                         // ((SELECT count(*) FROM trend_snap) * {PER_EDITION}) + 1)) AS edition
)"""

_FEED_SQL = (
    TREND_SNAP_SQL
    + f""",
articles AS (
  SELECT doc_id, CASE lang WHEN 'de' THEN 'Breaking: ' WHEN 'fr' THEN 'Update: ' ELSE '' END
                 || replace(text, chr(10), ' ') AS headline,
         'https://news.example/' || doc_id AS url,
         CASE source WHEN 'src0' THEN 'CNN' WHEN 'src1' THEN 'BBC' WHEN 'src2' THEN 'Reuters' ELSE source END AS outlet
  FROM documents
),
dealt AS (
  SELECT *, row_number() OVER (ORDER BY fetched_at, geo, rank) - 1 AS number, count(*) OVER () AS total FROM trend_snap
),
{EDITIONS_SQL},
edited AS (
  SELECT * REPLACE (fetched_at + to_minutes(edition) AS fetched_at), fetched_at AS month FROM dealt CROSS JOIN editions
),
numbered AS (SELECT * FROM edited WHERE month <> TIMESTAMP '{BROKEN_MONTH}'),
news AS (
  SELECT geo, fetched_at, rank, doc_id AS nth, nullif(headline, '') AS headline, url, outlet
  FROM numbered JOIN articles ON doc_id % total * 7919 % total = number AND doc_id // (total * {PER_EDITION}) = edition
),
ordered_news AS (
  SELECT *, row_number() OVER (PARTITION BY geo, fetched_at, rank ORDER BY nth) AS place FROM news
),
per_trend AS (
  SELECT geo, fetched_at, rank, CAST(count(*) AS INTEGER) AS articles_5,
         CAST(count(*) FILTER (place <= 2) AS INTEGER) AS articles_2,
         string_agg(concat_ws('~', headline, url, outlet), '|' ORDER BY place) AS article_text,
         max(headline) FILTER (place = 1) AS top_headline, max(url) FILTER (place = 1) AS top_url,
         max(outlet) FILTER (place = 1) AS top_outlet,
         CAST(count(DISTINCT outlet) AS INTEGER) AS source_count,
         coalesce(array_to_string(list_sort(list(DISTINCT outlet) FILTER (outlet IN ('CNN', 'BBC', 'Reuters'))), ','), '')
           AS confirmed_by,
         coalesce(bool_or(contains(lower(headline), 'breaking')) FILTER (place <= 3), false) AS is_breaking,
         coalesce(bool_or(contains(lower(headline), 'update')) FILTER (place <= 3), false) AS is_update
  FROM ordered_news WHERE place <= 5 GROUP BY geo, fetched_at, rank
),
raw_feed AS (
  SELECT n.geo, n.fetched_at, n.rank, keyword AS trend,
         CASE WHEN n.rank = 19 THEN 'N/A' ELSE volume_text END AS traffic,
         CASE WHEN n.rank = 19 THEN 0 ELSE volume_min END AS traffic_min,
         CASE WHEN n.rank <> 20 THEN n.fetched_at + INTERVAL 8 HOUR END AS published,
         CASE WHEN n.rank = 20 THEN strftime(n.fetched_at, '%Y/%m/%d')
              ELSE strftime(n.fetched_at, '%a, %-d %b %Y %H:%M:%S') || ' -0800' END AS published_raw,
         'https://trends.google.com/trends/explore?q=' || keyword || '&geo=' || n.geo || '&hl=en-US' AS explore_link,
         CASE WHEN n.rank <> 18 THEN 'https://img.example/?a=1&k=' || keyword END AS image_url,
         'Example & Co' AS image_source,
         coalesce(articles_5, 0) AS article_count, coalesce(articles_2, 0) AS article_count_2,
         coalesce(article_text, '') AS articles, top_headline, top_url, top_outlet,
         source_count, confirmed_by, is_breaking, is_update
  FROM numbered n LEFT JOIN per_trend p ON p.geo = n.geo AND p.fetched_at = n.fetched_at AND p.rank = n.rank
)"""
)


def _feed(body: str) -> str:
    return f"WITH {_FEED_SQL}\n{body}"


_TOP = "top_headline AS top_article_headline, top_url AS top_article_url, top_outlet AS top_article_source"
_FLAT = "geo, fetched_at, rank, trend, traffic, traffic_min, published, explore_link"

ORACLES = {
    "feed_ingest": _feed(
        f"SELECT {_FLAT}, published_raw, image_url, image_source, article_count, articles FROM raw_feed"
    ),
    "feed_quarantine": _feed(
        f"SELECT DISTINCT geo, fetched_at, 'not well-formed' AS reason FROM edited WHERE month = TIMESTAMP '{BROKEN_MONTH}'"
    ),
    "feed_snapshots": _feed(
        "SELECT source, geo, fetched_at, CAST(count(*) AS INTEGER) AS trend_count FROM numbered GROUP BY ALL"
    ),
    "feed_envelopes": _feed(
        """
SELECT 'rss' AS source, geo, fetched_at, '1.0' AS schema_version, CAST(count(*) AS INTEGER) AS count,
       string_agg(trend, '|' ORDER BY rank) AS keywords, CAST(sum(traffic_min) AS BIGINT) AS volume_sum
FROM raw_feed GROUP BY geo, fetched_at"""
    ),
    "feed_normalized": _feed(
        """
SELECT 'rss' AS source, geo, fetched_at, trend AS keyword, rank, traffic AS volume_text, traffic_min AS volume_min,
       published AS started_at, CAST(NULL AS TIMESTAMP) AS ended_at, true AS is_active,
       CAST(0 AS INTEGER) AS related_count, article_count AS news_count, image_url, explore_link AS explore_url
FROM raw_feed"""
    ),
    "feed_flat": _feed(f"SELECT {_FLAT}, image_url, image_source, article_count, {_TOP} FROM raw_feed"),
    "feed_slim": _feed(f"SELECT {_FLAT}, article_count_2 AS article_count, {_TOP} FROM raw_feed"),
    "feed_plain_envelopes": _feed(
        """
SELECT geo, fetched_at, CAST(count(*) AS INTEGER) AS count, string_agg(trend, '|' ORDER BY rank) AS trend_list
FROM raw_feed GROUP BY geo, fetched_at"""
    ),
    "feed_quality": _feed(
        """
SELECT geo, fetched_at, count(*) AS row_count, count(*) FILTER (traffic_min > 0) AS volumes_ok,
       count(published) AS dates_ok,
       count(*) FILTER (traffic_min > 0) * 10 >= count(*) * 9 AND count(published) = count(*) AS passes
FROM raw_feed GROUP BY geo, fetched_at"""
    ),
    "article_coverage": _feed(
        """
SELECT geo, count(*) AS articles, count(DISTINCT url) AS documents, CAST(sum(length(headline)) AS BIGINT) AS characters
FROM news GROUP BY geo"""
    ),
    "traffic_distribution": _feed("SELECT traffic, count(*) AS trend_count FROM raw_feed GROUP BY traffic"),
    "coverage_report": _feed(
        """
SELECT round(avg(article_count), 6) AS mean_articles, max(article_count) AS max_articles,
       count(*) FILTER (article_count >= 3) AS well_covered
FROM raw_feed"""
    ),
    "high_traffic": _feed(
        """
SELECT geo, fetched_at, trend, traffic, traffic_min, top_headline AS top_article_headline
FROM raw_feed WHERE traffic_min >= 3 ORDER BY traffic_min DESC, geo, fetched_at, trend LIMIT 50"""
    ),
    "story_report": _feed(
        """
SELECT geo, fetched_at, rank, trend,
       CASE WHEN contains(traffic, '+') THEN
         CASE WHEN traffic_min >= 500 THEN 'high' WHEN traffic_min >= 200 THEN 'moderate' ELSE 'low' END
       END AS traffic_band,
       source_count, confirmed_by,
       CASE WHEN article_count > 0 THEN confirmed_by <> '' END AS is_verified,
       CASE WHEN article_count > 0 THEN
         CASE WHEN is_breaking THEN 'breaking' WHEN is_update THEN 'developing' ELSE 'feature' END
       END AS story_angle,
       image_url IS NOT NULL AS has_image
FROM raw_feed"""
    ),
    "csv_sink": _feed(
        "SELECT geo, fetched_at, rank, trend, traffic_min, published, top_headline AS top_article_headline FROM raw_feed"
    ),
    "json_sink": _feed(
        """
SELECT geo, fetched_at, trend AS keyword, rank, traffic_min AS volume_min, published AS started_at,
       article_count AS news_count
FROM raw_feed"""
    ),
}
ORACLES["parquet_sink"] = ORACLES["json_sink"]
