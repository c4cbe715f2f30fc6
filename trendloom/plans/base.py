"""Base views: the given tables seen as keyword events, snapshots and payloads.

The SQL texts next to the views say the same for an independent engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.ranking import ranked_snapshots, snapshot_headers
from ..schemas import IMAGE, NEWS
from ..session import materialize

#: Customer keys per area of a region.  The first area bears the region's own name, further ones are numbered.
PER_AREA = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flat(df: DataFrame) -> DataFrame:
    """Result columns with wall-clock times, as other engines show them."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def geo_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``c_custkey, geo``: the region of each customer."""
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", F.col("r_name").alias("geo"))
    )


def area_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``c_custkey, geo``: the region of each customer, in areas of a fixed number of customer keys."""
    area = F.floor(F.col("c_custkey") / PER_AREA)
    suffix = F.when(area > 0, F.concat(F.lit(" "), area.cast("string"))).otherwise("")
    return geo_of_customers(spark, sf_dir).select("c_custkey", F.concat("geo", suffix).alias("geo"))


def region_of(geo: Column) -> Column:
    """The region of an area: its name without the number."""
    return F.regexp_replace(geo, " [0-9]+$", "")


def keyword_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as the use of a keyword (part name) in a geo (area of a region).

    Orders meet their customers before the line items, so the largest table is
    shuffled for the order and the part only.
    """
    orders = (
        table(spark, sf_dir, "orders")
        .join(area_of_customers(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "geo")
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select("geo", F.col("l_shipdate").alias("ts"), F.col("p_name").alias("keyword"))
    )


def trend_snap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly top-20 snapshots per area; areas, and with them snapshots, grow with the customers."""
    return ranked_snapshots(keyword_events(spark, sf_dir), "month", 20)


def trend_rows(spark: SparkSession, sf_dir: str, snap: DataFrame | None = None) -> DataFrame:
    """``trend_snap`` (or the one given, ranked before) in the full normalized schema."""
    return (trend_snap(spark, sf_dir) if snap is None else snap).select(
        "source", "geo", "fetched_at", "keyword", "rank", "volume_text", "volume_min", "started_at",
        F.lit(None).cast("string").alias("started_at_raw"),
        F.lit(None).cast("timestamp").alias("ended_at"),
        F.lit(True).alias("is_active"),
        F.array().cast("array<string>").alias("related_queries"),
        F.array().cast(NEWS).alias("news"),
        F.lit(None).cast(IMAGE).alias("image"),
        F.lit("").alias("explore_url"),
    )


def landed_snap(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Trends and headers of ``trend_snap``, written once by this call.

    Jobs that look at the snapshots from several sides read the short ranked
    lists instead of ranking the whole history again for each side.
    """
    trends = materialize(spark, trend_snap(spark, sf_dir), "snapshots")
    return trends, snapshot_headers(trends)


TREND_SNAP_SQL = f"""
keyword_events AS (
  SELECT r_name || CASE WHEN c_custkey >= {PER_AREA} THEN ' ' || CAST(c_custkey // {PER_AREA} AS VARCHAR) ELSE '' END AS geo,
         l_shipdate AS ts, p_name AS keyword
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
),
keyword_counts AS (
  SELECT geo, CAST(date_trunc('month', ts) AS TIMESTAMP) AS fetched_at, keyword,
         count(*) AS volume_min, min(ts) AS started_at
  FROM keyword_events GROUP BY ALL
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY geo, fetched_at ORDER BY volume_min DESC, keyword) AS INTEGER) AS rank
  FROM keyword_counts
),
trend_snap AS (
  SELECT 'rss' AS source, geo, fetched_at, keyword, rank,
         CAST(volume_min AS VARCHAR) || '+' AS volume_text, volume_min, started_at
  FROM ranked WHERE rank <= 20
),
headers AS (
  SELECT source, geo, fetched_at, CAST(count(*) AS INTEGER) AS trend_count
  FROM trend_snap GROUP BY ALL
)"""

CHANGES_SQL = (
    TREND_SNAP_SQL
    + """,
links AS (
  SELECT *, lag(fetched_at) OVER (PARTITION BY source, geo ORDER BY fetched_at) AS prev_at FROM headers
),
paired AS (
  SELECT l.source, l.geo, l.fetched_at, t.keyword, t.rank, t.volume_min, false AS is_prev
  FROM links l JOIN trend_snap t USING (source, geo, fetched_at) WHERE prev_at IS NOT NULL
  UNION ALL
  SELECT l.source, l.geo, l.fetched_at, t.keyword, t.rank, t.volume_min, true
  FROM links l JOIN trend_snap t ON t.source = l.source AND t.geo = l.geo AND t.fetched_at = l.prev_at
),
sides AS (
  SELECT source, geo, fetched_at, keyword,
         max(rank) FILTER (NOT is_prev) AS rank, max(rank) FILTER (is_prev) AS prev_rank,
         max(volume_min) FILTER (NOT is_prev) AS volume_min, max(volume_min) FILTER (is_prev) AS prev_volume_min
  FROM paired GROUP BY ALL
),
changes AS (
  SELECT source, geo, fetched_at,
         CASE WHEN prev_rank IS NULL THEN 'new' WHEN rank IS NULL THEN 'dropped'
              WHEN volume_min > prev_volume_min THEN 'volume_up'
              WHEN volume_min < prev_volume_min THEN 'volume_down'
              WHEN rank <> prev_rank THEN 'rank_change' END AS event,
         keyword, rank, prev_rank, volume_min, prev_volume_min
  FROM sides
  WHERE prev_rank IS NULL OR rank IS NULL OR volume_min <> prev_volume_min OR rank <> prev_rank
)"""
)
