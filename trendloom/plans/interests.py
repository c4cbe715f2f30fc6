"""Interest, comparison, region and related-query jobs on the events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators import answers, interest, quality, related
from ..sources import explore
from .base import TREND_SNAP_SQL, flat, keyword_events, table

KEYWORDS = ["click", "error", "purchase", "signup", "view"]
SEEDS = ["red plate", "small widget", "hot ring"]


def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("event_type").alias("keyword"), "ts", F.col("user_id").alias("user"))


def _counts(spark: SparkSession, d: str) -> DataFrame:
    return interest.bucket_counts(_events(spark, d), "day")


def _users(spark: SparkSession, d: str) -> DataFrame:
    return (
        table(spark, d, "customer")
        .join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("user"),
            F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("geo_code"),
            F.col("n_name").alias("geo_name"),
        )
    )


def _region_counts(spark: SparkSession, d: str) -> DataFrame:
    return interest.region_counts(_events(spark, d), _users(spark, d))


def interest_over_time(spark: SparkSession, d: str) -> DataFrame:
    return flat(interest.interest_over_time(_counts(spark, d)))


def comparison_series(spark: SparkSession, d: str) -> DataFrame:
    return flat(interest.compare_keywords(_counts(spark, d), KEYWORDS))


def comparison_winners(spark: SparkSession, d: str) -> DataFrame:
    return interest.winners(interest.averages(interest.compare_keywords(_counts(spark, d), KEYWORDS)))


def comparison_table(spark: SparkSession, d: str) -> DataFrame:
    return flat(interest.comparison_table(interest.compare_keywords(_counts(spark, d), KEYWORDS), KEYWORDS))


def series_table(spark: SparkSession, d: str) -> DataFrame:
    return flat(interest.series_table(interest.interest_over_time(_counts(spark, d)), "purchase"))


def series_peaks(spark: SparkSession, d: str) -> DataFrame:
    return flat(interest.peaks(interest.interest_over_time(_counts(spark, d))))


def series_latest(spark: SparkSession, d: str) -> DataFrame:
    return flat(interest.latest_points(interest.interest_over_time(_counts(spark, d)), 5))


def region_interest(spark: SparkSession, d: str) -> DataFrame:
    return interest.strongest_first(interest.interest_by_region(_region_counts(spark, d)))


def _order_comparisons(spark: SparkSession, d: str) -> DataFrame:
    """Every order compares the part names it holds."""
    named = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    held = named.groupBy(F.col("l_orderkey").alias("comparison_id")).agg(F.array_sort(F.collect_set("p_name")).alias("keywords"))
    return held  # seven lines to an order at most


def many_comparison_winners(spark: SparkSession, d: str) -> DataFrame:
    """Keywords of each order compared by their months."""
    uses = keyword_events(spark, d).select("keyword", F.col("ts").cast("timestamp").alias("ts"))
    members = interest.comparison_members(_order_comparisons(spark, d))
    return interest.many_winners(interest.compare_many(interest.bucket_counts(uses, "month"), members))


def many_comparison_regions(spark: SparkSession, d: str) -> DataFrame:
    """Keywords of each order compared by region."""
    counts = keyword_events(spark, d).groupBy("keyword", F.col("geo").alias("geo_code"), F.col("geo").alias("geo_name"))
    members = interest.comparison_members(_order_comparisons(spark, d))
    return interest.many_region_winners(counts.agg(F.count(F.lit(1)).alias("n")), members)


def rejected_comparisons(spark: SparkSession, d: str) -> DataFrame:
    return interest.rejected_comparisons(_order_comparisons(spark, d))


def region_winners(spark: SparkSession, d: str) -> DataFrame:
    found = interest.compare_regions(_region_counts(spark, d), KEYWORDS)
    cells = [F.coalesce(F.try_element_at("values", F.lit(k)), F.lit(0)).alias(f"value_{k}") for k in KEYWORDS]
    return found.select("geo_code", "geo_name", "top_keyword", "top_value", *cells)


def _related(spark: SparkSession, d: str) -> DataFrame:
    uses = (
        table(spark, d, "lineitem")
        .join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(F.col("l_orderkey").alias("basket"), F.col("p_name").alias("keyword"), F.col("l_shipdate").alias("ts"))
    )
    newest = table(spark, d, "lineitem").agg(F.max("l_shipdate")).scalar()
    return related.related_queries(
        uses, SEEDS, newest - F.expr("INTERVAL 12 MONTHS"), newest - F.expr("INTERVAL 24 MONTHS")
    )


def related_queries(spark: SparkSession, d: str) -> DataFrame:
    return _related(spark, d)


# --- payloads ------------------------------------------------------------------

_PREFIX = ")]}',\n"


def _pack(payload, *outer: str):
    inner = payload
    for name in outer:
        inner = F.struct(inner.alias(name))
    return F.concat(F.lit(_PREFIX), F.to_json(inner))


def _sorted_list(order: str, entry):
    """Entries in the order of a column; groups hold days or regions, not events."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), entry.alias("e"))))
    return F.transform(pairs, lambda p: p["e"])


def series_payloads(spark: SparkSession, d: str) -> DataFrame:
    """One single-keyword series payload per keyword."""
    series = interest.interest_over_time(_counts(spark, d))
    point = F.struct(
        F.unix_seconds("ts").cast("string").alias("time"),
        F.array("value").alias("value"),
        F.array(F.lit(True)).alias("hasData"),
        F.col("is_partial").alias("isPartial"),
    )
    return series.groupBy("keyword").agg(_sorted_list("ts", point).alias("p")).select(
        F.concat(F.lit("a-"), "keyword").alias("answer_id"),
        "keyword",
        _pack(F.col("p"), "timelineData", "default").alias("series_json"),
    )


def region_payloads(spark: SparkSession, d: str) -> DataFrame:
    regions = interest.interest_by_region(_region_counts(spark, d))
    order = F.row_number().over(Window.partitionBy("keyword").orderBy(F.desc("value"), "geo_code"))
    # the weakest regions are marked as having no data
    entry = F.struct(
        F.col("geo_code").alias("geoCode"), F.col("geo_name").alias("geoName"),
        F.array("value").alias("value"), F.array(F.col("value") >= 50).alias("hasData"),
    )
    return (
        regions.withColumn("o", order)
        .groupBy("keyword")
        .agg(_sorted_list("o", entry).alias("p"))
        .select("keyword", _pack(F.col("p"), "geoMapData", "default").alias("regions_json"))
    )


def related_payloads(spark: SparkSession, d: str) -> DataFrame:
    return _packed_lists(_related(spark, d))


def _packed_lists(found: DataFrame) -> DataFrame:
    """One related-queries payload per seed: list 0 is top, list 1 rising."""
    entry = F.struct(
        "query", "value", F.col("formatted_value").alias("formattedValue"),
        F.replace("link", F.lit("https://trends.google.com"), F.lit("")).alias("link"),
    )
    rows = found.withColumn("entry", entry)

    def one(bucket: str):
        pairs = F.array_sort(
            F.collect_list(F.when(F.col("bucket") == bucket, F.struct("pos", "entry")))
        )
        return F.struct(F.transform(pairs, lambda p: p["entry"]).alias("rankedKeyword"))

    # the two lists hold 25 entries each at most
    return rows.groupBy("keyword").agg(F.array(one("top"), one("rising")).alias("p")).select(
        F.concat(F.lit("r-"), "keyword").alias("answer_id"),
        "keyword",
        _pack(F.col("p"), "rankedList", "default").alias("related_json"),
    )


def event_related_payloads(spark: SparkSession, d: str) -> DataFrame:
    """What users of each event type also did: the last week against the one before."""
    uses = table(spark, d, "events").select(F.col("user_id").alias("basket"), F.col("event_type").alias("keyword"), "ts")
    newest = table(spark, d, "events").agg(F.max("ts")).scalar()
    seeds = uses.select("keyword").distinct()
    found = related.related_queries(uses, seeds, newest - F.expr("INTERVAL 7 DAYS"), newest - F.expr("INTERVAL 14 DAYS"))
    return _packed_lists(found).select("keyword", "related_json")


def explore_payloads(spark: SparkSession, d: str) -> DataFrame:
    """Complete single-keyword answers: series, regions and related queries."""
    return (
        series_payloads(spark, d)
        .join(region_payloads(spark, d), "keyword")
        .join(event_related_payloads(spark, d), "keyword", "left")
        .withColumn("geo", F.lit("US"))
        .withColumn("timeframe", F.lit("today 1-m"))
        .withColumn("gprop", F.lit(""))
        .withColumn("fetched_at", F.lit("2024-02-01 00:00:00").cast("timestamp"))
    )


def comparison_payloads(spark: SparkSession, d: str) -> DataFrame:
    """One comparison of all five keywords with averages and regions."""
    series = interest.compare_keywords(_counts(spark, d), KEYWORDS)
    position = F.array_position(F.lit(KEYWORDS), F.col("keyword"))

    def in_order(value: str):
        pairs = F.array_sort(F.collect_list(F.struct(position.alias("o"), F.col(value).alias("v"))))
        return F.transform(pairs, lambda p: p["v"])

    points = series.groupBy("ts").agg(in_order("value").alias("value"), F.bool_or("is_partial").alias("isPartial"))
    point = F.struct(F.unix_seconds("ts").cast("string").alias("time"), "value", "isPartial")
    average = interest.averages(series).groupBy().agg(in_order("average").alias("averages"))
    timeline = points.groupBy().agg(_sorted_list("ts", point).alias("timelineData"))

    scaled = interest.compare_regions(_region_counts(spark, d), KEYWORDS)
    cells = F.array(*[F.coalesce(F.try_element_at("values", F.lit(k)), F.lit(0)) for k in KEYWORDS])
    entry = F.struct(
        F.col("geo_code").alias("geoCode"), F.col("geo_name").alias("geoName"), cells.alias("value"),
        F.transform(cells, lambda v: v > 0).alias("hasData"),
    )
    regions = scaled.groupBy().agg(_sorted_list("geo_code", entry).alias("p"))
    both = timeline.withColumn("averages", average.scalar()).withColumn("p", regions.scalar())
    return both.select(
        F.lit("c-1").alias("answer_id"),
        F.lit(KEYWORDS).alias("keywords"),
        F.lit("US").alias("geo"),
        F.lit("today 1-m").alias("timeframe"),
        F.lit("").alias("gprop"),
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("fetched_at"),
        F.concat(
            F.lit(_PREFIX), F.to_json(F.struct(F.struct("timelineData", "averages").alias("default")))
        ).alias("series_json"),
        _pack(F.col("p"), "geoMapData", "default").alias("regions_json"),
    )


def payload_interest(spark: SparkSession, d: str) -> DataFrame:
    found = explore.read_interest(explore_payloads(spark, d))
    return flat(found.select("answer_id", "keyword", "pos", "ts", "value", "is_partial"))


def payload_related(spark: SparkSession, d: str) -> DataFrame:
    return explore.read_related(related_payloads(spark, d))


def payload_regions(spark: SparkSession, d: str) -> DataFrame:
    return explore.read_regions(explore_payloads(spark, d))


def payload_comparison(spark: SparkSession, d: str) -> DataFrame:
    return flat(explore.read_comparison(comparison_payloads(spark, d)))


def payload_averages(spark: SparkSession, d: str) -> DataFrame:
    return explore.read_averages(comparison_payloads(spark, d))


def payload_comparison_regions(spark: SparkSession, d: str) -> DataFrame:
    return explore.read_comparison_regions(comparison_payloads(spark, d))


def explore_answers(spark: SparkSession, d: str) -> DataFrame:
    found = answers.explore_answers(explore_payloads(spark, d))
    return flat(
        found.select(
            "answer_id", "schema_version", "source", "keyword", "geo", "timeframe", "gprop", "fetched_at", "count",
            "is_empty",
            F.aggregate("interest_over_time", F.lit(0), lambda a, p: a + p["value"]).alias("value_sum"),
            F.size("top").alias("top_count"),
            F.size("rising").alias("rising_count"),
            F.array_join(F.transform("top", lambda r: r["query"]), ",").alias("top_queries"),
            F.size("interest_by_region").alias("region_count"),
            F.get_json_object("payload_json", "$.keyword").alias("payload_keyword"),
        )
    )


def comparison_answers(spark: SparkSession, d: str) -> DataFrame:
    found = answers.comparison_answers(comparison_payloads(spark, d))
    text = F.transform("averages", lambda a: F.concat(a["keyword"], F.lit("="), a["average"].cast("string")))
    return flat(
        found.select(
            "answer_id", "schema_version", "source", F.array_join("keywords", ",").alias("keywords"), "fetched_at",
            "count", F.array_join(text, ",").alias("averages"), F.size("interest_by_region").alias("region_count"),
        )
    )


def _delivered(payloads: DataFrame) -> DataFrame:
    """All answers, and next to each a silent one that gave no rows at all."""
    asked = payloads.select("answer_id", "keyword")
    return asked.union(asked.select(F.concat("answer_id", F.lit("-silent")), "keyword"))


def interest_quality(spark: SparkSession, d: str) -> DataFrame:
    payloads = explore_payloads(spark, d)
    return quality.interest_quality(explore.read_interest(payloads), minimum=30, answers=_delivered(payloads))


def related_quality(spark: SparkSession, d: str) -> DataFrame:
    payloads = related_payloads(spark, d)
    return quality.related_quality(explore.read_related(payloads), _delivered(payloads))


def region_quality(spark: SparkSession, d: str) -> DataFrame:
    payloads = explore_payloads(spark, d)
    return quality.region_quality(explore.read_regions(payloads), _delivered(payloads))


QUERIES = {
    "interest_over_time": interest_over_time,
    "comparison_series": comparison_series,
    "comparison_winners": comparison_winners,
    "comparison_table": comparison_table,
    "series_table": series_table,
    "series_peaks": series_peaks,
    "series_latest": series_latest,
    "region_interest": region_interest,
    "region_winners": region_winners,
    "many_comparison_winners": many_comparison_winners,
    "many_comparison_regions": many_comparison_regions,
    "rejected_comparisons": rejected_comparisons,
    "related_queries": related_queries,
    "payload_interest": payload_interest,
    "payload_related": payload_related,
    "payload_regions": payload_regions,
    "payload_comparison": payload_comparison,
    "payload_averages": payload_averages,
    "payload_comparison_regions": payload_comparison_regions,
    "explore_answers": explore_answers,
    "comparison_answers": comparison_answers,
    "interest_quality": interest_quality,
    "related_quality": related_quality,
    "region_quality": region_quality,
}

_INTEREST_SQL = """
day_counts AS (
  SELECT event_type AS keyword, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts, count(*) AS n FROM events GROUP BY ALL
),
days AS (
  SELECT CAST(unnest(generate_series(min(ts), max(ts), INTERVAL 1 DAY)) AS TIMESTAMP) AS ts FROM day_counts
),
counts AS (
  SELECT k.keyword, days.ts, coalesce(c.n, 0) AS n, days.ts + INTERVAL 1 DAY > (SELECT max(ts) FROM events) AS is_partial
  FROM (SELECT DISTINCT keyword FROM day_counts) k CROSS JOIN days
  LEFT JOIN day_counts c ON c.keyword = k.keyword AND c.ts = days.ts
),
own_scale AS (
  SELECT keyword, ts, is_partial,
         CAST(round(n * CAST(100 AS DOUBLE) / max(n) OVER (PARTITION BY keyword)) AS INTEGER) AS value
  FROM counts
),
shared_scale AS (
  SELECT keyword, ts, is_partial, CAST(round(n * CAST(100 AS DOUBLE) / max(n) OVER ()) AS INTEGER) AS value FROM counts
),
average AS (
  SELECT keyword, CAST(round(avg(value)) AS INTEGER) AS average FROM shared_scale GROUP BY keyword
),
region_n AS (
  SELECT event_type AS keyword, 'N' || n_nationkey AS geo_code, n_name AS geo_name, count(*) AS n
  FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL
),
own_regions AS (
  SELECT keyword, geo_code, geo_name,
         CAST(round(n * CAST(100 AS DOUBLE) / max(n) OVER (PARTITION BY keyword)) AS INTEGER) AS value
  FROM region_n
),
shared_regions AS (
  SELECT keyword, geo_code, geo_name, CAST(round(n * CAST(100 AS DOUBLE) / max(n) OVER ()) AS INTEGER) AS value
  FROM region_n
),
region_wins AS (
  SELECT geo_code, geo_name, first(keyword ORDER BY value DESC, keyword) AS top_keyword, max(value) AS top_value,
         coalesce(max(value) FILTER (keyword = 'click'), 0) AS value_click,
         coalesce(max(value) FILTER (keyword = 'error'), 0) AS value_error,
         coalesce(max(value) FILTER (keyword = 'purchase'), 0) AS value_purchase,
         coalesce(max(value) FILTER (keyword = 'signup'), 0) AS value_signup,
         coalesce(max(value) FILTER (keyword = 'view'), 0) AS value_view
  FROM shared_regions GROUP BY geo_code, geo_name
)"""

_RELATED_SQL = """
newest AS (SELECT max(l_shipdate) AS ts FROM lineitem),
used AS (
  SELECT l_orderkey AS basket, p_name AS keyword,
         bool_or(l_shipdate >= newest.ts - INTERVAL 12 MONTH) AS is_recent,
         bool_or(l_shipdate >= newest.ts - INTERVAL 24 MONTH AND l_shipdate < newest.ts - INTERVAL 12 MONTH) AS was_before
  FROM lineitem JOIN part ON l_partkey = p_partkey CROSS JOIN newest GROUP BY l_orderkey, p_name
),
companions AS (
  SELECT s.keyword AS keyword, u.keyword AS query, count(*) AS n, count(*) FILTER (u.is_recent) AS now_n,
         count(*) FILTER (u.was_before) AS prior_n
  FROM used s JOIN used u USING (basket)
  WHERE s.keyword IN ('red plate', 'small widget', 'hot ring') AND u.keyword <> s.keyword
  GROUP BY s.keyword, u.keyword
),
both_lists AS (
  SELECT keyword, 'top' AS bucket, query, n AS weight, 0 AS breakout,
         CAST(round(n * CAST(100 AS DOUBLE) / max(n) OVER (PARTITION BY keyword)) AS INTEGER) AS value
  FROM companions
  UNION ALL
  SELECT keyword, 'rising', query, now_n, CASE WHEN prior_n = 0 THEN 1 ELSE 0 END,
         CASE WHEN prior_n = 0 THEN 0 ELSE CAST(round((now_n - prior_n) * CAST(100 AS DOUBLE) / prior_n) AS INTEGER) END
  FROM companions WHERE now_n > prior_n
),
related AS (
  SELECT keyword, bucket, query, value,
         CAST(row_number() OVER (PARTITION BY keyword, bucket
              ORDER BY breakout DESC, value DESC, weight DESC, query) AS INTEGER) AS pos,
         CASE WHEN breakout = 1 THEN 'Breakout' WHEN bucket = 'rising' THEN '+' || format('{:,}', value) || '%'
              ELSE CAST(value AS VARCHAR) END AS formatted_value,
         'https://trends.google.com/trends/explore?q=' || query AS link
  FROM both_lists QUALIFY pos <= 25
)"""


_MANY_SQL = TREND_SNAP_SQL + """,
month_counts AS (
  SELECT keyword, CAST(date_trunc('month', ts) AS TIMESTAMP) AS ts, count(*) AS n FROM keyword_events GROUP BY ALL
),
months AS (SELECT CAST(unnest(generate_series(min(ts), max(ts), INTERVAL 1 MONTH)) AS TIMESTAMP) AS ts FROM month_counts),
month_grid AS (
  SELECT k.keyword, months.ts, coalesce(c.n, 0) AS n
  FROM (SELECT DISTINCT keyword FROM month_counts) k CROSS JOIN months
  LEFT JOIN month_counts c ON c.keyword = k.keyword AND c.ts = months.ts
),
geo_counts AS (SELECT keyword, geo, count(*) AS n FROM keyword_events GROUP BY ALL),
named AS (SELECT DISTINCT l_orderkey AS comparison_id, p_name AS keyword FROM lineitem JOIN part ON l_partkey = p_partkey),
sizes AS (SELECT comparison_id, CAST(count(*) AS INTEGER) AS term_count FROM named GROUP BY comparison_id),
members AS (SELECT named.* FROM named JOIN sizes USING (comparison_id) WHERE term_count BETWEEN 2 AND 5)"""


def _m(body: str) -> str:
    return f"WITH {_MANY_SQL}\n{body}"


def _i(body: str) -> str:
    return f"WITH {_INTEREST_SQL}\n{body}"


def _r(body: str) -> str:
    return f"WITH {_RELATED_SQL}\n{body}"


_PIVOT = ", ".join(f"max(value) FILTER (keyword = '{k}') AS \"{k}\"" for k in KEYWORDS)

ORACLES = {
    "many_comparison_winners": _m(
        """
SELECT comparison_id, keyword, average,
       CAST(row_number() OVER (PARTITION BY comparison_id ORDER BY average DESC, keyword) AS INTEGER) AS place
FROM (
  SELECT comparison_id, keyword, CAST(round(avg(CAST(round(n * CAST(100 AS DOUBLE) / peak) AS INTEGER))) AS INTEGER) AS average
  FROM members JOIN month_grid USING (keyword)
  JOIN (SELECT comparison_id, max(n) AS peak FROM members JOIN month_grid USING (keyword) GROUP BY 1) USING (comparison_id)
  GROUP BY comparison_id, keyword)"""
    ),
    "many_comparison_regions": _m(
        """
SELECT comparison_id, geo AS geo_code, geo AS geo_name, first(keyword ORDER BY value DESC, keyword) AS top_keyword,
       max(value) AS top_value
FROM (
  SELECT comparison_id, keyword, geo,
         CAST(round(n * CAST(100 AS DOUBLE) / max(n) OVER (PARTITION BY comparison_id)) AS INTEGER) AS value
  FROM members JOIN geo_counts USING (keyword))
GROUP BY comparison_id, geo"""
    ),
    "rejected_comparisons": _m("SELECT comparison_id, term_count FROM sizes WHERE term_count NOT BETWEEN 2 AND 5"),
    "interest_over_time": _i("SELECT keyword, ts, value, is_partial FROM own_scale"),
    "comparison_series": _i("SELECT keyword, ts, value, is_partial FROM shared_scale"),
    "comparison_winners": _i(
        """
SELECT keyword, average, CAST(row_number() OVER (ORDER BY average DESC, keyword) AS INTEGER) AS place FROM average"""
    ),
    "comparison_table": _i(f"SELECT ts AS date, {_PIVOT}, is_partial FROM shared_scale GROUP BY ts, is_partial"),
    "series_table": _i("SELECT ts AS date, value, is_partial FROM own_scale WHERE keyword = 'purchase'"),
    "series_peaks": _i(
        """
SELECT keyword, max(value) AS peak_value, first(ts ORDER BY value DESC, ts) AS peak_at, count(*) AS point_count,
       max(value) = 0 AS is_empty
FROM own_scale GROUP BY keyword"""
    ),
    "series_latest": _i(
        """
SELECT keyword, ts, value, is_partial, back FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY keyword ORDER BY ts DESC) AS INTEGER) AS back FROM own_scale)
WHERE back <= 5"""
    ),
    "region_interest": _i("SELECT keyword, geo_code, geo_name, value FROM own_regions"),
    "region_winners": _i("SELECT * FROM region_wins"),
    "related_queries": _r("SELECT keyword, bucket, pos, query, value, formatted_value, link FROM related"),
    "payload_interest": _i(
        """
SELECT 'a-' || keyword AS answer_id, keyword,
       CAST(row_number() OVER (PARTITION BY keyword ORDER BY ts) AS INTEGER) AS pos, ts, value, is_partial
FROM own_scale"""
    ),
    "payload_related": _r(
        "SELECT 'r-' || keyword AS answer_id, keyword, bucket, pos, query, value, formatted_value, link FROM related"
    ),
    "payload_regions": _i(
        """
SELECT 'a-' || keyword AS answer_id, keyword,
       CAST(row_number() OVER (PARTITION BY keyword ORDER BY value DESC, geo_code) AS INTEGER) AS pos,
       geo_code, geo_name, value
FROM own_regions WHERE value >= 50"""
    ),
    "payload_comparison": _i(
        """
SELECT 'c-1' AS answer_id, ts, CAST(dense_rank() OVER (ORDER BY keyword) - 1 AS INTEGER) AS kw_pos, keyword, value,
       is_partial
FROM shared_scale"""
    ),
    "payload_averages": _i(
        """
SELECT 'c-1' AS answer_id, CAST(row_number() OVER (ORDER BY keyword) - 1 AS INTEGER) AS kw_pos, keyword, average
FROM average"""
    ),
    "payload_comparison_regions": _i(
        """
SELECT 'c-1' AS answer_id, w.geo_code, w.geo_name, w.top_keyword, k.keyword, coalesce(s.value, 0) AS value
FROM region_wins w CROSS JOIN (SELECT keyword FROM average) k
LEFT JOIN shared_regions s ON s.geo_code = w.geo_code AND s.keyword = k.keyword
WHERE w.top_value > 0"""
    ),
    "explore_answers": _i(
        """,
used AS (
  SELECT user_id, event_type AS keyword, bool_or(ts >= newest - INTERVAL 7 DAY) AS is_recent,
         bool_or(ts >= newest - INTERVAL 14 DAY AND ts < newest - INTERVAL 7 DAY) AS was_before
  FROM events CROSS JOIN (SELECT max(ts) AS newest FROM events) GROUP BY ALL
),
companions AS (
  SELECT s.keyword, u.keyword AS query, count(*) AS n, count(*) FILTER (u.is_recent) AS now_n,
         count(*) FILTER (u.was_before) AS prior_n
  FROM used s JOIN used u USING (user_id) WHERE u.keyword <> s.keyword GROUP BY s.keyword, u.keyword
),
listed AS (
  SELECT keyword, CAST(least(count(*), 25) AS INTEGER) AS top_count,
         CAST(least(count(*) FILTER (now_n > prior_n), 25) AS INTEGER) AS rising_count,
         array_to_string(list(query ORDER BY n DESC, query)[1:25], ',') AS top_queries
  FROM companions GROUP BY keyword
)
SELECT 'a-' || o.keyword AS answer_id, '1.2' AS schema_version, 'explore' AS source, o.keyword AS keyword, 'US' AS geo,
       'today 1-m' AS timeframe, '' AS gprop, TIMESTAMP '2024-02-01' AS fetched_at, CAST(count(*) AS INTEGER) AS count,
       max(o.value) = 0 AS is_empty, CAST(sum(o.value) AS INTEGER) AS value_sum,
       coalesce(any_value(top_count), 0) AS top_count, coalesce(any_value(rising_count), 0) AS rising_count,
       coalesce(any_value(top_queries), '') AS top_queries,
       (SELECT CAST(count(*) AS INTEGER) FROM own_regions r WHERE r.keyword = o.keyword AND r.value >= 50) AS region_count,
       o.keyword AS payload_keyword
FROM own_scale o LEFT JOIN listed USING (keyword) GROUP BY o.keyword"""
    ),
    "comparison_answers": _i(
        """
SELECT 'c-1' AS answer_id, '1.1' AS schema_version, 'explore_comparison' AS source,
       (SELECT string_agg(keyword, ',' ORDER BY keyword) FROM average) AS keywords,
       TIMESTAMP '2024-02-01' AS fetched_at, CAST(count(DISTINCT ts) AS INTEGER) AS count,
       (SELECT string_agg(keyword || '=' || average, ',' ORDER BY keyword) FROM average) AS averages,
       (SELECT CAST(count(*) AS INTEGER) FROM region_wins WHERE top_value > 0) AS region_count
FROM shared_scale"""
    ),
    "interest_quality": _i(
        """
SELECT 'a-' || keyword AS answer_id, keyword, count(*) AS point_count, count(*) AS values_ok, count(*) AS dates_ok,
       min(ts) < max(ts) AS is_chronological, count(*) >= 30 AS passes
FROM own_scale GROUP BY keyword
UNION ALL SELECT DISTINCT 'a-' || keyword || '-silent', keyword, 0, 0, 0, false, false FROM own_scale"""
    ),
    "region_quality": _i(
        """
SELECT 'a-' || keyword AS answer_id, keyword, count(*) AS region_count, count(*) FILTER (value BETWEEN 0 AND 100) AS regions_ok,
       true AS passes
FROM own_regions WHERE value >= 50 GROUP BY keyword
UNION ALL SELECT DISTINCT 'a-' || keyword || '-silent', keyword, 0, 0, false FROM own_regions"""
    ),
    "related_quality": _r(
        """
SELECT 'r-' || keyword AS answer_id, keyword, count(*) FILTER (bucket = 'top') AS top_count,
       count(*) FILTER (bucket = 'rising') AS rising_count, count(*) FILTER (bucket = 'top') > 0 AS passes
FROM related GROUP BY keyword
UNION ALL SELECT DISTINCT 'r-' || keyword || '-silent', keyword, 0, 0, false FROM related"""
    ),
}
