"""Snapshots, changes and the archive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import archive, changes, envelopes, normalize
from ..operators.ranking import ranked_snapshots
from ..schemas import CHANGE_EVENTS
from ..session import materialize, shared_folder
from .base import CHANGES_SQL, TREND_SNAP_SQL, flat, keyword_events, landed_snap, region_of, trend_rows, trend_snap
from .requests import stored_answers

_SNAP_COLUMNS = "source, geo, fetched_at, keyword, rank, volume_min"
_CHANGE_COLUMNS = "source, geo, fetched_at, event, keyword, rank, prev_rank, volume_min, prev_volume_min"


# --- snapshots and changes ------------------------------------------------------


def ranked(spark: SparkSession, d: str) -> DataFrame:
    return flat(trend_snap(spark, d))


def change_history(spark: SparkSession, d: str) -> DataFrame:
    return flat(changes.diff_history(*landed_snap(spark, d)))


OLD_MONTH, NEW_MONTH = "1997-06-01", "1997-12-01"


def diff_pair(spark: SparkSession, d: str) -> DataFrame:
    """Two months compared; the scan reads line items of these months only."""
    month = lambda day: F.col("ts").between(
        F.lit(day).cast("timestamp_ntz"),
        F.lit(day).cast("timestamp_ntz") + F.expr("INTERVAL 1 MONTH") - F.expr("INTERVAL 1 MICROSECOND"),
    )
    events = keyword_events(spark, d).where(month(OLD_MONTH) | month(NEW_MONTH))
    trends = materialize(spark, ranked_snapshots(events, "month", 20), "month-pair")
    at = lambda day: trends.where(F.col("fetched_at") == F.lit(day).cast("timestamp"))
    return flat(changes.diff_snapshots(at(OLD_MONTH), at(NEW_MONTH)))


FILTER_VOLUME, FILTER_EVENTS, FILTER_TERMS = 3, ["new", "volume_up"], ["RED", "plate"]


def filtered_changes(spark: SparkSession, d: str) -> DataFrame:
    found = changes.diff_history(*landed_snap(spark, d))
    return flat(changes.filter_changes(found, FILTER_VOLUME, FILTER_EVENTS, FILTER_TERMS))


def change_summary(spark: SparkSession, d: str) -> DataFrame:
    trends, headers = landed_snap(spark, d)
    return flat(changes.change_summary(headers, changes.diff_history(trends, headers)))


COMPACT_GEOS = ["ASIA", "EUROPE"]


def compact_trends(spark: SparkSession, d: str) -> DataFrame:
    """All areas of two regions."""
    return flat(normalize.compact(trend_rows(spark, d), COMPACT_GEOS, within=region_of(F.col("geo"))))


def snapshot_envelopes(spark: SparkSession, d: str) -> DataFrame:
    packed = envelopes.snapshot_envelopes(trend_rows(spark, d))
    return flat(
        packed.select(
            "source", "geo", "fetched_at", "schema_version", "count",
            F.array_join(F.transform("trends", lambda t: F.concat(t["rank"].cast("string"), F.lit(":"), t["keyword"])), "|")
            .alias("trend_list"),
            (F.get_json_object("payload_json", "$.count").cast("int")).alias("payload_count"),
        )
    )


# --- archive --------------------------------------------------------------------

_built: dict[tuple[str, str], str] = {}


def _explore_envelopes(snap: DataFrame) -> DataFrame:
    """Explore answers to archive: each month's leading keyword per geo was looked up."""
    lead = snap.where(F.col("rank") == 1)
    body = lead.select(F.lit("explore").alias("source"), "geo", "fetched_at", "keyword")
    return body.withColumn("schema_version", F.lit("1.2")).withColumn(
        "payload_json", F.to_json(F.struct("geo", "keyword"))
    )


def _fill(spark: SparkSession, root: str, d: str) -> DataFrame:
    """Archive all snapshots; the history is ranked once, and its short lists are returned."""
    snap = landed_snap(spark, d)[0]
    archive.create(spark, root)
    archive.append(spark, root, envelopes.snapshot_envelopes(trend_rows(spark, d, snap)))
    archive.append(spark, root, _explore_envelopes(snap))
    return snap


def built_archive(spark: SparkSession, d: str) -> str:
    """An archive of all snapshots, written once per application and input."""
    at = (spark.sparkContext.applicationId, d)
    if at not in _built:
        root = shared_folder(spark, "archive")
        _fill(spark, root, d)
        _built[at] = root
    return _built[at]


def archive_append(spark: SparkSession, d: str) -> DataFrame:
    """The stored rows after everything was appended twice."""
    root = shared_folder(spark, "archive-twice")
    snap = _fill(spark, root, d)
    archive.append(spark, root, envelopes.snapshot_envelopes(trend_rows(spark, d, snap)))
    rows = archive.trends(spark, root)
    return flat(rows.select("source", "geo", "fetched_at", "keyword", "keyword_key", "rank", "volume_min"))


def archive_keyword_rows(spark: SparkSession, d: str) -> DataFrame:
    snap = landed_snap(spark, d)[0]
    trending = archive.keyword_rows(envelopes.snapshot_envelopes(trend_rows(spark, d, snap)))
    return flat(trending.unionByName(archive.keyword_rows(_explore_envelopes(snap))))


def archive_empty_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """A day after each region's last snapshot comes one without trends: what the archive says has changed then."""
    snap, headers = landed_snap(spark, d)
    last = headers.groupBy("source", "geo").agg((F.max("fetched_at") + F.expr("INTERVAL 1 DAY")).alias("fetched_at"))
    every = headers.select("source", "geo", "fetched_at").unionByName(last)
    root = shared_folder(spark, "archive-empty")
    archive.create(spark, root)
    archive.append(spark, root, envelopes.snapshot_envelopes(trend_rows(spark, d, snap), every))
    found = changes.diff_history(archive.trends(spark, root), archive.snapshots(spark, root))
    return flat(found.join(last, ["source", "geo", "fetched_at"], "left_semi"))


def archive_flat(spark: SparkSession, d: str) -> DataFrame:
    rows = archive.trends(spark, built_archive(spark, d)).where(F.col("source") == "rss")
    return flat(normalize.flatten_trends(rows))


def archive_newest(spark: SparkSession, d: str) -> DataFrame:
    root = built_archive(spark, d)
    found = archive.read_snapshots(
        archive.snapshots(spark, root), archive.trends(spark, root), source=["rss", "explore"],
        start="1996-03-01", end="1999-09-01", limit=25,
    )
    return flat(found.select("source", "geo", "fetched_at", "schema_version", "trend_count"))


def archive_with_keyword(spark: SparkSession, d: str) -> DataFrame:
    root = built_archive(spark, d)
    found = archive.read_snapshots(
        archive.snapshots(spark, root), archive.trends(spark, root), source="rss", keyword="RED Plate"
    )
    return flat(found.select("source", "geo", "fetched_at", "trend_count"))


def keyword_history(spark: SparkSession, d: str) -> DataFrame:
    root = built_archive(spark, d)
    return flat(archive.keyword_history(archive.trends(spark, root), " Hot RING ", start="1996-01-01"))


def keyword_movement(spark: SparkSession, d: str) -> DataFrame:
    root = built_archive(spark, d)
    rows = archive.trends(spark, root).where(F.col("source") == "rss")
    return flat(archive.keyword_movement(rows))


def compact_history(spark: SparkSession, d: str) -> DataFrame:
    root = built_archive(spark, d)
    entries, _ = archive.compact_history(
        archive.snapshots(spark, root), archive.trends(spark, root), geo="ASIA", keyword="red plate", limit=10
    )
    return flat(entries)


def keyword_timeline(spark: SparkSession, d: str) -> DataFrame:
    """The second part of a compact history: where the keyword stood in every trending snapshot."""
    root = built_archive(spark, d)
    _, line = archive.compact_history(
        archive.snapshots(spark, root), archive.trends(spark, root), geo="ASIA", keyword="red plate", limit=10
    )
    return flat(line)


def archive_stats(spark: SparkSession, d: str) -> DataFrame:
    root = built_archive(spark, d)
    stats = archive.archive_stats(archive.snapshots(spark, root), archive.trends(spark, root), stored_answers(spark, d))
    return flat(
        stats.withColumn("geos", F.array_join("geos", ",")).withColumn("sources", F.array_join("sources", ","))
    )


def archive_layouts(spark: SparkSession, d: str) -> DataFrame:
    """Snapshots per source that pass the layout guard."""
    headers = archive.guard_layout(archive.snapshots(spark, built_archive(spark, d)))
    return headers.groupBy("source", "layout_version").agg(F.count(F.lit(1)).alias("snapshot_count"))


PRUNE_BEFORE = "1998-01-15"


def prune_counts(spark: SparkSession, d: str) -> DataFrame:
    headers = archive.snapshots(spark, built_archive(spark, d))
    return archive.prune_counts(headers, PRUNE_BEFORE, geo="ASIA")


def archive_pruned(spark: SparkSession, d: str) -> DataFrame:
    """What is left after two prunes: one geo, then everything of one source."""
    root = shared_folder(spark, "archive-pruned")
    _fill(spark, root, d)
    archive.prune(spark, root, PRUNE_BEFORE, geo="ASIA")
    archive.prune(spark, root, "2000-01-01", source="explore")
    rows = archive.trends(spark, root).groupBy("source", "geo", "fetched_at").agg(F.count(F.lit(1)).alias("row_count"))
    kept = archive.snapshots(spark, root).join(rows, ["source", "geo", "fetched_at"], "full_outer")
    return flat(kept.select("source", "geo", "fetched_at", "trend_count", "row_count"))


QUERIES = {
    "ranked_snapshots": ranked,
    "change_history": change_history,
    "diff_pair": diff_pair,
    "filtered_changes": filtered_changes,
    "change_summary": change_summary,
    "compact_trends": compact_trends,
    "snapshot_envelopes": snapshot_envelopes,
    "archive_append": archive_append,
    "archive_keyword_rows": archive_keyword_rows,
    "archive_flat": archive_flat,
    "archive_newest": archive_newest,
    "archive_with_keyword": archive_with_keyword,
    "keyword_history": keyword_history,
    "keyword_movement": keyword_movement,
    "compact_history": compact_history,
    "keyword_timeline": keyword_timeline,
    "archive_empty_snapshots": archive_empty_snapshots,
    "archive_stats": archive_stats,
    "archive_layouts": archive_layouts,
    "prune_counts": prune_counts,
    "archive_pruned": archive_pruned,
}

_EXPLORE_SQL = """,
explored AS (
  SELECT 'explore' AS source, geo, fetched_at, keyword, CAST(NULL AS INTEGER) AS rank,
         CAST(NULL AS VARCHAR) AS volume_text, CAST(NULL AS BIGINT) AS volume_min
  FROM trend_snap WHERE rank = 1
),
stored AS (
  SELECT source, geo, fetched_at, keyword, rank, volume_text, volume_min FROM trend_snap
  UNION ALL SELECT * FROM explored
),
stored_headers AS (
  SELECT source, geo, fetched_at, CAST(count(*) AS INTEGER) AS trend_count,
         CASE source WHEN 'rss' THEN '1.0' ELSE '1.2' END AS schema_version
  FROM stored GROUP BY source, geo, fetched_at
)"""


def _snap(body: str) -> str:
    return f"WITH {TREND_SNAP_SQL}\n{body}"


def _stored(body: str) -> str:
    return f"WITH {TREND_SNAP_SQL}{_EXPLORE_SQL}\n{body}"


def _changed(body: str) -> str:
    return f"WITH {CHANGES_SQL}\n{body}"


ORACLES = {
    "ranked_snapshots": _snap(
        "SELECT source, geo, fetched_at, keyword, rank, volume_text, volume_min, started_at FROM trend_snap"
    ),
    "change_history": _changed(f"SELECT {_CHANGE_COLUMNS} FROM changes"),
    "diff_pair": _snap(
        f"""
SELECT geo,
       CASE WHEN o.rank IS NULL THEN 'new' WHEN n.rank IS NULL THEN 'dropped'
            WHEN n.volume_min > o.volume_min THEN 'volume_up' WHEN n.volume_min < o.volume_min THEN 'volume_down'
            ELSE 'rank_change' END AS event,
       keyword, n.rank AS rank, o.rank AS prev_rank, n.volume_min AS volume_min, o.volume_min AS prev_volume_min
FROM (SELECT * FROM trend_snap WHERE fetched_at = TIMESTAMP '{OLD_MONTH}') o
FULL JOIN (SELECT * FROM trend_snap WHERE fetched_at = TIMESTAMP '{NEW_MONTH}') n USING (geo, keyword)
WHERE o.rank IS NULL OR n.rank IS NULL OR o.rank <> n.rank OR o.volume_min <> n.volume_min"""
    ),
    "filtered_changes": _changed(
        f"""
SELECT {_CHANGE_COLUMNS} FROM changes
WHERE coalesce(volume_min, prev_volume_min, 0) >= {FILTER_VOLUME} AND event IN ('new', 'volume_up')
  AND (contains(lower(keyword), 'red') OR contains(lower(keyword), 'plate'))"""
    ),
    "change_summary": _changed(
        "SELECT h.source, h.geo, h.fetched_at, any_value(h.prev_count) IS NULL AS baseline,\n"
        "       any_value(h.prev_count) AS previous_count, any_value(h.trend_count) AS current_count,\n"
        "       count(c.event) AS change_count,\n       "
        + ", ".join(f"count(*) FILTER (c.event = '{e}') AS {e}_count" for e in CHANGE_EVENTS)
        + """
FROM (SELECT *, lag(trend_count) OVER (PARTITION BY source, geo ORDER BY fetched_at) AS prev_count FROM headers) h
LEFT JOIN changes c ON c.source = h.source AND c.geo = h.geo AND c.fetched_at = h.fetched_at
GROUP BY h.source, h.geo, h.fetched_at"""
    ),
    "compact_trends": _snap(
        f"SELECT {_SNAP_COLUMNS}, true AS is_active FROM trend_snap WHERE regexp_replace(geo, ' [0-9]+$', '') IN ('ASIA', 'EUROPE')"
    ),
    "snapshot_envelopes": _snap(
        """
SELECT source, geo, fetched_at, '1.0' AS schema_version, CAST(count(*) AS INTEGER) AS count,
       string_agg(rank || ':' || keyword, '|' ORDER BY rank) AS trend_list, CAST(count(*) AS INTEGER) AS payload_count
FROM trend_snap GROUP BY source, geo, fetched_at"""
    ),
    "archive_append": _stored(
        "SELECT source, geo, fetched_at, keyword, lower(keyword) AS keyword_key, rank, volume_min FROM stored"
    ),
    "archive_keyword_rows": _stored("SELECT source, geo, fetched_at, keyword, rank, volume_text, volume_min FROM stored"),
    "archive_flat": _snap("SELECT fetched_at, geo, source, keyword, rank, volume_min, volume_text FROM trend_snap"),
    "archive_newest": _stored(
        """
SELECT source, geo, fetched_at, schema_version, trend_count FROM stored_headers
WHERE fetched_at >= TIMESTAMP '1996-03-01' AND fetched_at <= TIMESTAMP '1999-09-01'
ORDER BY fetched_at DESC, source, geo LIMIT 25"""
    ),
    "archive_with_keyword": _stored(
        """
SELECT source, geo, fetched_at, trend_count FROM stored_headers h
WHERE source = 'rss' AND EXISTS (
  SELECT 1 FROM stored s WHERE s.source = h.source AND s.geo = h.geo AND s.fetched_at = h.fetched_at
    AND lower(s.keyword) = 'red plate')"""
    ),
    "keyword_history": _stored(
        """
SELECT fetched_at, geo, source, rank, volume_min FROM stored
WHERE lower(keyword) = 'hot ring' AND fetched_at >= TIMESTAMP '1996-01-01'"""
    ),
    "keyword_movement": _snap(
        """
SELECT source, geo, keyword, fetched_at, min(fetched_at) OVER w AS first_seen_at,
       lag(fetched_at) OVER o AS prev_at, rank, lag(rank) OVER o AS prev_rank, lag(rank) OVER o - rank AS moved_up
FROM trend_snap
WINDOW w AS (PARTITION BY source, geo, keyword), o AS (PARTITION BY source, geo, keyword ORDER BY fetched_at)"""
    ),
    "compact_history": _stored(
        """
, newest AS (
  SELECT source, geo, fetched_at, trend_count FROM stored_headers h
  WHERE source = 'rss' AND geo = 'ASIA' AND EXISTS (
    SELECT 1 FROM stored s WHERE s.source = h.source AND s.geo = h.geo AND s.fetched_at = h.fetched_at
      AND lower(s.keyword) = 'red plate')
  ORDER BY fetched_at DESC LIMIT 10)
SELECT source, geo, fetched_at, trend_count, keyword, rank, volume_min
FROM newest JOIN stored USING (source, geo, fetched_at)"""
    ),
    "keyword_timeline": _stored(
        """
SELECT fetched_at, geo, source, rank, volume_min FROM stored
WHERE source = 'rss' AND geo = 'ASIA' AND lower(keyword) = 'red plate'"""
    ),
    "archive_empty_snapshots": _snap(
        """
, last AS (SELECT source, geo, max(fetched_at) AS fetched_at FROM headers GROUP BY source, geo)
SELECT source, geo, fetched_at + INTERVAL 1 DAY AS fetched_at, 'dropped' AS event, keyword,
       CAST(NULL AS INTEGER) AS rank, rank AS prev_rank, CAST(NULL AS BIGINT) AS volume_min, volume_min AS prev_volume_min
FROM last JOIN trend_snap USING (source, geo, fetched_at)"""
    ),
    "archive_stats": _stored(
        """
SELECT (SELECT count(*) FROM stored_headers) AS snapshot_count, count(*) AS trend_row_count,
       array_to_string(list_sort(list(DISTINCT geo)), ',') AS geos,
       array_to_string(list_sort(list(DISTINCT source)), ',') AS sources,
       min(fetched_at) AS first_fetched_at, max(fetched_at) AS last_fetched_at, 
       (SELECT count(*) FROM events WHERE CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) < 50) AS answer_count
FROM stored"""
    ),
    "archive_layouts": _stored(
        "SELECT source, 1 AS layout_version, count(*) AS snapshot_count FROM stored_headers GROUP BY source"
    ),
    "prune_counts": _stored(
        f"""
SELECT count(*) FILTER (fetched_at < TIMESTAMP '{PRUNE_BEFORE}' AND geo = 'ASIA') AS deleted,
       count(*) FILTER (NOT (fetched_at < TIMESTAMP '{PRUNE_BEFORE}' AND geo = 'ASIA')) AS kept
FROM stored_headers"""
    ),
    "archive_pruned": _stored(
        f"""
SELECT source, geo, fetched_at, trend_count, CAST(trend_count AS BIGINT) AS row_count FROM stored_headers
WHERE NOT (fetched_at < TIMESTAMP '{PRUNE_BEFORE}' AND geo = 'ASIA')
  AND NOT (fetched_at < TIMESTAMP '2000-01-01' AND source = 'explore')"""
    ),
}
