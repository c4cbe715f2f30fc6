"""Request checks and reuse of stored answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import quality, reuse
from ..sources.dims import CATEGORIES, PERIOD_HOURS, category_dim
from .base import flat, table


def geo_requests(spark: SparkSession, d: str) -> DataFrame:
    """Customers asking for their nation in lower case; two segments ask wrongly."""
    segment = F.col("c_mktsegment")
    code = (
        F.when(segment == "MACHINERY", F.concat("n_name", F.lit("_X")))
        .when(segment == "FURNITURE", F.concat(F.lit("q"), "n_name"))
        .otherwise(F.lower("n_name"))
    )
    return (
        table(spark, d, "customer")
        .join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("request_id"), code.alias("geo"))
    )


def nation_dim(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select(
        F.col("n_nationkey").alias("pos"),
        F.col("n_name").alias("code"),
        F.concat(F.lit("Nation no. "), F.col("n_nationkey").cast("string")).alias("name"),
    )


def geo_check(spark: SparkSession, d: str) -> DataFrame:
    checked = quality.check_codes(geo_requests(spark, d), nation_dim(spark, d))
    return checked.withColumn("suggestions", F.array_join("suggestions", ","))


#: What customers of a segment ask for; the first three are no category.
ASKED_CATEGORY = {
    "AUTOMOBILE": "Automobile", "BUILDING": "BUSY", "FURNITURE": "Tables", "HOUSEHOLD": "Hobbies", "MACHINERY": "TECHNOLOGY",
}


def category_check(spark: SparkSession, d: str) -> DataFrame:
    """Category and hours of each customer's request; nations 4, 9, ... ask for 12 hours, nation 24 for none."""
    nation = F.col("c_nationkey")
    category = F.element_at(F.create_map(*[F.lit(v) for kv in ASKED_CATEGORY.items() for v in kv]), F.col("c_mktsegment"))
    hours = F.element_at(F.array(*[F.lit(h) for h in (*PERIOD_HOURS, 12)]), (nation % 5 + 1).cast("int"))
    requests = table(spark, d, "customer").select(
        F.col("c_custkey").alias("request_id"), category.alias("category"), F.when(nation != 24, hours).alias("hours")
    )
    checked = quality.check_categories(requests, category_dim(spark))
    return checked.withColumns(
        {"suggestions": F.array_join("suggestions", ","), "hours_ok": quality.hours_ok(F.col("hours"))}
    )


def comparison_check(spark: SparkSession, d: str) -> DataFrame:
    """Every event as a comparison request whose shape depends on its value."""
    value, kind = F.col("value"), F.col("event_type")
    user = F.concat(F.lit(" user "), F.col("user_id").cast("string"), F.lit(" "))
    extra = [F.lit(t) for t in ("a", "b", "c", "d")]
    keywords = (
        F.when(value < 5, F.array(kind))
        .when(value < 8, F.array(kind, F.upper(kind)))
        .when(value < 10, F.array(kind, user, F.lit("  ")))
        .when(value < 12, F.array(kind, user, F.lit("a,b")))
        .when(value < 14, F.array(kind, user, *extra))
        .otherwise(F.array(kind, user))
    )
    gprop = (
        F.when(kind == "view", "web").when(kind == "click", "youtube").when(kind == "error", "maps").otherwise("")
    )
    requests = table(spark, d, "events").select(
        "event_id", keywords.alias("keywords"), gprop.alias("gprop"),
        F.when(value > 30, F.lit(0.0)).otherwise(F.lit(60.0)).alias("ttl_seconds"),
    )
    checked = quality.check_comparisons(requests)
    return checked.select(
        "event_id", F.array_join("terms", "|").alias("terms"), "gprop", "reason", "is_valid"
    )


def _marked(spark: SparkSession, d: str) -> DataFrame:
    """Events as answers (small k) and requests (large k) on shared keys.

    Even k are comparisons with a second keyword; views name it first.
    """
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    own, second = F.initcap("event_type"), F.lit("Other")
    pair = F.when(F.col("event_type") == "view", F.array(second, own)).otherwise(F.array(own, second))
    compares = k % 2 == 0
    last_digit = F.substring(F.col("user_id").cast("string"), -1, 1)
    return table(spark, d, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(compares, "comparison").otherwise("explore").alias("kind"),
        F.when(compares, pair).otherwise(F.array(own)).alias("keywords"),
        F.concat(F.lit("G"), last_digit).alias("geo"),
        F.when(F.col("value") < 20, "now 7-d").otherwise("today 12-m").alias("timeframe"),
        F.lit(0).alias("category"),
        F.lit("").alias("gprop"),
        F.col("ts").cast("timestamp").alias("ts"),
        "value",
        k.alias("k"),
    )


def stored_answers(spark: SparkSession, d: str) -> DataFrame:
    return _marked(spark, d).where(F.col("k") < 50).select(
        F.col("event_id").alias("answer_id"), "kind", reuse.keyword_key(F.col("keywords")).alias("keywords_lc"),
        "geo", "timeframe", "category", "gprop",
        (F.col("value") > 10).alias("has_related"), (F.col("k") < 25).alias("has_geo"),
        F.col("ts").alias("stored_at"),
    )


def explore_requests(spark: SparkSession, d: str) -> DataFrame:
    return _marked(spark, d).where(F.col("k") >= 50).select(
        F.col("event_id").alias("request_id"), "kind", "keywords", "geo", "timeframe", "category", "gprop",
        (F.col("value") > 15).alias("want_related"), (F.col("k") < 75).alias("want_geo"),
        F.col("ts").alias("asked_at"),
        F.when(F.col("value") > 40, F.lit(172_800.0)).alias("ttl_seconds"),
    )


def answer_reuse(spark: SparkSession, d: str) -> DataFrame:
    matched = reuse.match_answers(explore_requests(spark, d), stored_answers(spark, d))
    return flat(
        matched.select(
            "request_id", "asked_at", "is_hit", "answer_id", "stored_at", "is_exact", "drops_related", "drops_geo"
        )
    )


def reuse_stats(spark: SparkSession, d: str) -> DataFrame:
    answers = stored_answers(spark, d)
    return reuse.reuse_stats(reuse.match_answers(explore_requests(spark, d), answers), answers)


def answer_retention(spark: SparkSession, d: str) -> DataFrame:
    """Answers kept when the store is compacted 15 days after the last event."""
    now = table(spark, d, "events").agg(F.max("ts").cast("timestamp")).scalar() + F.expr("INTERVAL 15 DAYS")
    kept = reuse.compact_answers(stored_answers(spark, d), now)
    return flat(kept.withColumn("keywords_lc", F.array_join("keywords_lc", ",")))


QUERIES = {
    "geo_check": geo_check,
    "category_check": category_check,
    "comparison_check": comparison_check,
    "answer_reuse": answer_reuse,
    "reuse_stats": reuse_stats,
    "answer_retention": answer_retention,
}

_REUSE_SQL = """
marked AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CASE k % 2 WHEN 0 THEN 'comparison' ELSE 'explore' END AS kind,
         CASE WHEN k % 2 = 1 THEN event_type WHEN event_type = 'view' THEN 'other,view' ELSE event_type || ',other' END AS keyword,
         'G' || right(CAST(user_id AS VARCHAR), 1) AS geo,
         CASE WHEN value < 20 THEN 'now 7-d' ELSE 'today 12-m' END AS timeframe, ts, value, k
  FROM (SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS k FROM events)
),
answers AS (
  SELECT event_id AS answer_id, kind, keyword, geo, timeframe, value > 10 AS has_related, k < 25 AS has_geo, ts AS stored_at
  FROM marked WHERE k < 50
),
requests AS (
  SELECT event_id AS request_id, kind, keyword, geo, timeframe, value > 15 AS want_related, k < 75 AS want_geo, ts AS asked_at,
         CASE WHEN value > 40 THEN 172800 WHEN value < 20 THEN 3600 ELSE 86400 END AS ttl
  FROM marked WHERE k >= 50
),
candidates AS (
  SELECT r.request_id, a.answer_id, a.stored_at, a.has_related = r.want_related AND a.has_geo = r.want_geo AS is_exact,
         a.has_related AND NOT r.want_related AS drops_related, a.has_geo AND NOT r.want_geo AS drops_geo,
         row_number() OVER (PARTITION BY r.request_id ORDER BY
           CASE WHEN a.has_related = r.want_related AND a.has_geo = r.want_geo THEN 0
                WHEN a.has_related AND a.has_geo THEN 1 WHEN a.has_related THEN 2 ELSE 3 END,
           a.stored_at DESC, a.answer_id DESC) AS choice
  FROM requests r JOIN answers a USING (kind, keyword, geo, timeframe)
  WHERE a.stored_at <= r.asked_at AND a.stored_at >= r.asked_at - to_seconds(r.ttl)
    AND (a.has_related OR NOT r.want_related) AND (a.has_geo OR NOT r.want_geo)
    AND (r.kind = 'explore' OR (a.has_related = r.want_related AND a.has_geo = r.want_geo))
),
matched AS (
  SELECT r.request_id, r.asked_at, c.answer_id IS NOT NULL AS is_hit, c.answer_id, c.stored_at, c.is_exact,
         c.drops_related, c.drops_geo
  FROM requests r LEFT JOIN candidates c ON c.request_id = r.request_id AND c.choice = 1
)"""

ORACLES = {
    "geo_check": """
WITH requests AS (
  SELECT c_custkey AS request_id,
         CASE c_mktsegment WHEN 'MACHINERY' THEN n_name || '_X' WHEN 'FURNITURE' THEN 'q' || n_name
                           ELSE lower(n_name) END AS geo
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
near AS (
  SELECT left(n_name, 1) AS prefix, array_to_string(list(n_name ORDER BY n_nationkey)[1:5], ',') AS codes
  FROM nation GROUP BY left(n_name, 1)
)
SELECT request_id, geo, upper(geo) AS code, 'Nation no. ' || n_nationkey AS name, n_name IS NOT NULL AS is_valid,
       CASE WHEN n_name IS NULL THEN coalesce(codes, '') ELSE '' END AS suggestions
FROM requests LEFT JOIN nation ON upper(geo) = n_name LEFT JOIN near ON left(upper(geo), 1) = prefix""",
    "category_check": f"""
WITH categories AS (
  SELECT unnest([{", ".join(f"'{c}'" for c in CATEGORIES)}]) AS code, unnest(range({len(CATEGORIES)})) AS pos
),
near AS (
  SELECT left(code, 3) AS prefix, array_to_string(list(code ORDER BY pos)[1:5], ',') AS codes FROM categories GROUP BY 1
),
requests AS (
  SELECT c_custkey AS request_id,
         CASE c_mktsegment {" ".join(f"WHEN '{s}' THEN '{c}'" for s, c in ASKED_CATEGORY.items())} END AS category,
         CASE WHEN c_nationkey <> 24 THEN
           CAST([{", ".join(map(str, PERIOD_HOURS))}, 12][c_nationkey % 5 + 1] AS INTEGER) END AS hours
  FROM customer
)
SELECT request_id, category, hours, lower(category) AS code, c.code AS name, c.code IS NOT NULL AS is_valid,
       CASE WHEN c.code IS NULL THEN coalesce(codes, '') ELSE '' END AS suggestions,
       coalesce(hours IN ({", ".join(map(str, PERIOD_HOURS))}), false) AS hours_ok
FROM requests LEFT JOIN categories c ON lower(category) = c.code LEFT JOIN near ON left(lower(category), 3) = prefix""",
    "comparison_check": """
SELECT event_id,
       CASE WHEN value < 5 THEN event_type
            WHEN value < 8 THEN event_type || '|' || upper(event_type)
            WHEN value < 10 THEN event_type || '|user ' || user_id || '|'
            WHEN value < 12 THEN event_type || '|user ' || user_id || '|a,b'
            WHEN value < 14 THEN event_type || '|user ' || user_id || '|a|b|c|d'
            ELSE event_type || '|user ' || user_id END AS terms,
       CASE event_type WHEN 'click' THEN 'youtube' WHEN 'error' THEN 'maps' ELSE '' END AS gprop,
       CASE WHEN value < 5 THEN 'needs 2 to 5 keywords' WHEN value < 8 THEN 'duplicate keyword'
            WHEN value < 10 THEN 'empty keyword' WHEN value < 12 THEN 'comma in keyword'
            WHEN value < 14 THEN 'needs 2 to 5 keywords' WHEN event_type = 'error' THEN 'unknown property'
            WHEN value > 30 THEN 'ttl must be positive' END AS reason,
       value >= 14 AND value <= 30 AND event_type <> 'error' AS is_valid
FROM events""",
    "answer_reuse": f"WITH {_REUSE_SQL} SELECT * FROM matched",
    "reuse_stats": f"""WITH {_REUSE_SQL}
SELECT count(*) FILTER (is_hit) AS hits, count(*) FILTER (NOT is_hit) AS misses, (SELECT count(*) FROM answers) AS size,
       round(count(*) FILTER (is_hit) * CAST(100 AS DOUBLE) / count(*), 1) AS hit_rate
FROM matched""",
    "answer_retention": f"""WITH {_REUSE_SQL}
SELECT answer_id, kind, keyword AS keywords_lc, geo, timeframe, CAST(0 AS INTEGER) AS category, '' AS gprop,
       has_related, has_geo, stored_at
FROM answers
WHERE stored_at >= (SELECT max(ts) FROM events) - INTERVAL 15 DAY
QUALIFY row_number() OVER (PARTITION BY kind, keyword, geo, timeframe, has_related, has_geo
                           ORDER BY stored_at DESC, answer_id DESC) = 1""",
}
