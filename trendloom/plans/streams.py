"""Streams and their sinks, driven over landed files in several triggers, with restarts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import archive, changes, envelopes
from ..schemas import CHANGE_COLUMNS
from ..session import RECOMMENDED, shared_folder
from ..sources.landing import stream_feeds, stream_snapshots
from ..streaming import alerts, ingest, interest, watch
from .base import CHANGES_SQL, TREND_SNAP_SQL, flat, landed_snap, table, trend_rows, trend_snap

#: Snapshots land in parts up to these times; a watch is restarted after each of them.
PARTS = ("1996-06-01", "1998-06-01", "2100-01-01")
#: Snapshots of this year land again, with other contents, after the second part.
LATE_YEAR = 1995
BROKEN_MONTH = "1997-01-01"
FEED_EVENTS = ("new", "volume_up")


def _stream_session(spark: SparkSession) -> SparkSession:
    """A session on the same context with the state store the streams need."""
    session = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.streaming.stateStore.providerClass"):
        session.conf.set(key, RECOMMENDED[key])
    # as many state partitions as cores: each one holds a state store
    session.conf.set("spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism)
    return session


def _parts(rows: DataFrame, column: str = "fetched_at"):
    """Rows in parts by time; within a part one geo's rows go to one file, so that files keep their order."""
    before = None
    for until in PARTS:
        part = rows.where(F.col(column) < F.lit(until).cast("timestamp"))
        yield until, part if before is None else part.where(F.col(column) >= F.lit(before).cast("timestamp"))
        before = until


def _watched(spark: SparkSession, d: str) -> tuple[str, str]:
    """A watch over all snapshots, restarted twice; returns its folder and that of the changes it found."""
    land, folder, found, check = (shared_folder(spark, p) for p in ("landing", "watch", "watched", "watch-check"))
    packed = envelopes.assemble(landed_snap(spark, d)[0], fields=["keyword", "rank", "volume_min"])
    packed = packed.select("source", "geo", "fetched_at", "trends")
    session = _stream_session(spark)
    job = watch.Watch(folder, alerts.changes_folder(found))
    for until, part in _parts(packed):
        part.repartition("source", "geo").write.mode("append").json(land)
        if until == PARTS[1]:
            again = packed.where(F.year("fetched_at") == LATE_YEAR).withColumn("trends", F.slice("trends", 3, 1))
            again.repartition("source", "geo").write.mode("append").json(land)
        watch.start_watch(stream_snapshots(session, land, max_files_per_trigger=8), job, check).awaitTermination()
    return folder, found


def change_stream(spark: SparkSession, d: str) -> DataFrame:
    return flat(alerts.read_changes(spark, _watched(spark, d)[1]).select(CHANGE_COLUMNS))


def late_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Snapshots that a watch has set aside, with the newest time their geo had by then."""
    return flat(watch.late_snapshots(spark, _watched(spark, d)[0]))


def watched_baseline(spark: SparkSession, d: str) -> DataFrame:
    """What a watch would compare the next snapshots with."""
    return flat(watch.baseline(spark, _watched(spark, d)[0]))


def _feed_documents(spark: SparkSession, d: str) -> DataFrame:
    """A feed document per snapshot; rank 19 has no volume, the documents of one month are cut off."""
    name = F.replace(F.replace("keyword", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    item = F.concat(
        F.lit("<item><title>"), name, F.lit("</title>"),
        F.when(F.col("rank") == 19, "").otherwise(
            F.concat(F.lit("<ht:approx_traffic>"), F.col("volume_text"), F.lit("</ht:approx_traffic>"))
        ),
        F.lit("</item>"),
    )
    head = '<?xml version="1.0" encoding="UTF-8"?><rss xmlns:ht="https://trends.google.com/trending/rss"><channel>'
    # Landed in parts, each of which would rank the whole history again.
    items = landed_snap(spark, d)[0].groupBy("geo", "fetched_at").agg(  # at most 20 trends per document
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", item.alias("item")))), lambda i: i["item"]), "").alias("body")
    )
    end = F.when(F.col("fetched_at") == F.lit(BROKEN_MONTH).cast("timestamp"), "").otherwise("</channel></rss>")
    return items.select("geo", "fetched_at", F.concat(F.lit(head), "body", end).alias("xml"))


def _feed_changes(spark: SparkSession, d: str, session: SparkSession) -> str:
    """Landed feed documents watched with filters inside the stream; returns the folder of changes."""
    land, folder, found, check = (shared_folder(spark, p) for p in ("feed-landing", "feed-watch", "feed-changes", "feed-check"))
    documents = _feed_documents(spark, d)
    job = watch.Watch(folder, alerts.changes_folder(found), min_volume=2, events=FEED_EVENTS)
    for _, part in _parts(documents):
        part.repartition("geo").write.mode("append").parquet(land)
        watch.start_watch(stream_feeds(session, land, max_files_per_trigger=8), job, check).awaitTermination()
    return found


def feed_alert_stream(spark: SparkSession, d: str) -> DataFrame:
    """Feed documents to alert records as streams: parsed, watched, filtered and written by the file sink."""
    session = _stream_session(spark)
    path, check = shared_folder(spark, "alert-stream"), shared_folder(spark, "alert-check")
    found = _feed_changes(spark, d, session)
    for files in (1, None):  # stopped and started again
        alerts.start_alerts(alerts.stream_changes(session, found, files), path, check).awaitTermination()
    record = alerts.alert_records(spark, path)
    field = lambda name: F.get_json_object("record", f"$.{name}").alias(name)
    return flat(record.select(
        field("geo"), F.to_timestamp(F.get_json_object("record", "$.fetched_at")).alias("fetched_at"), field("event"), field("keyword"),
        field("rank").cast("int").alias("rank"), field("prev_rank").cast("int").alias("prev_rank"),
        field("volume_min").cast("long").alias("volume_min"), field("prev_volume_min").cast("long").alias("prev_volume_min"),
    ))


def alert_stream_delivery(spark: SparkSession, d: str) -> DataFrame:
    """A watch's changes delivered as a stream to a receiver that refuses dropped keywords, over a restart."""

    def send(record: str) -> bool:
        if '"event":"dropped"' in record:
            raise ConnectionError("refused")
        return True

    session = _stream_session(spark)
    path, check = shared_folder(spark, "delivery"), shared_folder(spark, "delivery-check")
    found = _watched(spark, d)[1]
    for files in (2, None):
        alerts.start_delivery(alerts.stream_changes(session, found, files), send, path, check, attempts=2).awaitTermination()
    log = alerts.delivery_log(spark, path)
    return log.groupBy(F.get_json_object("record", "$.event").alias("event"), "delivered").agg(
        F.count(F.lit(1)).alias("records"), F.sum("tries").alias("tries")
    )


def interest_stream(spark: SparkSession, d: str) -> DataFrame:
    """Daily counts of events that land in four parts, counted in event time over several triggers."""
    land, path, check = (shared_folder(spark, p) for p in ("event-landing", "event-counts", "event-check"))
    events = table(spark, d, "events").select(F.col("event_type").alias("keyword"), F.col("ts").cast("timestamp").alias("ts"))
    session = _stream_session(spark)
    lo, hi = events.agg(F.unix_seconds(F.min("ts")), F.unix_seconds(F.max("ts"))).first()
    quarter = F.floor((F.unix_seconds("ts") - lo) * 4 / (hi - lo + 1))
    stream = lambda: interest.bucket_stream(session.readStream.schema(events.schema).option("maxFilesPerTrigger", 8).parquet(land))
    for number in range(4):
        events.where(quarter == number).write.mode("append").parquet(land)
        if number in (1, 3):
            if number == 3:  # a sign of life without keyword lets the last buckets close
                later = F.timestamp_seconds(F.lit(hi + 4 * 86400)).alias("ts")
                spark.range(1).select(F.lit(None).cast("string").alias("keyword"), later).write.mode("append").parquet(land)
            interest.start_counts(stream(), path, check).awaitTermination()
    return flat(interest.stored_counts(spark, path))


def alert_records(spark: SparkSession, d: str) -> DataFrame:
    """Changes as alert records in JSON, written and read back."""
    path = shared_folder(spark, "alerts")
    found = changes.diff_history(*landed_snap(spark, d))
    alerts.alert_folder(path)(changes.filter_changes(found, events=["new", "dropped"]), 0)
    record = alerts.read_alerts(spark, path)
    field = lambda name: F.get_json_object("record", f"$.{name}").alias(name)
    return record.select(
        "batch", field("geo"), field("event"), field("keyword"),
        field("rank").cast("int").alias("rank"), field("prev_rank").cast("int").alias("prev_rank"),
    )


def alert_delivery(spark: SparkSession, d: str) -> DataFrame:
    """Delivery of all changes to a receiver that refuses dropped keywords."""

    def send(record: str) -> bool:
        if '"event":"dropped"' in record:
            raise ConnectionError("refused")
        return True

    found = changes.diff_history(*landed_snap(spark, d))
    return alerts.delivery_report(alerts.deliver(found, send))


def stream_to_archive(spark: SparkSession, d: str) -> DataFrame:
    """Envelopes streamed into an archive; the first part lands once more later, and the stream is restarted."""
    land, root, check = (shared_folder(spark, p) for p in ("envelopes", "stream-archive", "archive-state"))
    packed = envelopes.snapshot_envelopes(trend_rows(spark, d, landed_snap(spark, d)[0]))
    session = _stream_session(spark)
    archive.create(session, root)
    first = None
    for until, part in _parts(packed):
        part.write.mode("append").parquet(land)
        first = part if first is None else first
        if until == PARTS[1]:
            first.write.mode("append").parquet(land)
        if until != PARTS[0]:
            landed = session.readStream.schema(packed.schema).option("maxFilesPerTrigger", 8).parquet(land)
            rows = landed.select("*", F.col("_metadata.file_modification_time").alias("landed_at"))
            ingest.start_archive(rows, root, check).awaitTermination()
    return flat(
        archive.trends(spark, root).groupBy("source", "geo", "fetched_at").agg(
            F.count(F.lit(1)).alias("row_count"), F.sum("volume_min").alias("volume_sum")
        )
    )


QUERIES = {
    "change_stream": change_stream,
    "late_snapshots": late_snapshots,
    "watched_baseline": watched_baseline,
    "feed_alert_stream": feed_alert_stream,
    "alert_stream_delivery": alert_stream_delivery,
    "interest_stream": interest_stream,
    "alert_records": alert_records,
    "alert_delivery": alert_delivery,
    "stream_to_archive": stream_to_archive,
}

#: Changes between feed documents: no volume at rank 19, one month is unreadable.
_FEED_SQL = CHANGES_SQL.replace(
    "|| '+' AS volume_text, volume_min, started_at\n  FROM ranked WHERE rank <= 20",
    f"|| '+' AS volume_text, CASE WHEN rank = 19 THEN 0 ELSE volume_min END AS volume_min, started_at\n"
    f"  FROM ranked WHERE rank <= 20 AND fetched_at <> TIMESTAMP '{BROKEN_MONTH}'",
)

ORACLES = {
    "change_stream": f"""WITH {CHANGES_SQL}
SELECT source, geo, fetched_at, event, keyword, rank, prev_rank, volume_min, prev_volume_min FROM changes""",
    "late_snapshots": f"""WITH {TREND_SNAP_SQL}
SELECT source, geo, fetched_at, newest_at FROM headers
JOIN (SELECT source, geo, max(fetched_at) AS newest_at FROM headers WHERE fetched_at < TIMESTAMP '{PARTS[1]}' GROUP BY ALL)
  USING (source, geo)
WHERE year(fetched_at) = {LATE_YEAR}""",
    "watched_baseline": f"""WITH {TREND_SNAP_SQL}
SELECT source, geo, fetched_at, keyword, rank, volume_min FROM trend_snap
WHERE fetched_at = (SELECT max(fetched_at) FROM headers h WHERE h.source = trend_snap.source AND h.geo = trend_snap.geo)""",
    "feed_alert_stream": f"""WITH {_FEED_SQL}
SELECT geo, fetched_at, event, keyword, rank, prev_rank, volume_min, prev_volume_min FROM changes
WHERE event IN {FEED_EVENTS} AND coalesce(volume_min, prev_volume_min) >= 2""",
    "alert_stream_delivery": f"""WITH {CHANGES_SQL}
SELECT event, event <> 'dropped' AS delivered, count(*) AS records,
       CAST(sum(CASE WHEN event = 'dropped' THEN 2 ELSE 1 END) AS BIGINT) AS tries
FROM changes GROUP BY event""",
    "interest_stream": """SELECT event_type AS keyword, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts, count(*) AS n
FROM events GROUP BY ALL""",
    "alert_records": f"""WITH {CHANGES_SQL}
SELECT CAST(0 AS BIGINT) AS batch, geo, event, keyword, rank, prev_rank FROM changes WHERE event IN ('new', 'dropped')""",
    "alert_delivery": f"""WITH {CHANGES_SQL}
SELECT count(*) FILTER (event <> 'dropped') AS delivered_count, count(*) FILTER (event = 'dropped') AS failed_count
FROM changes""",
    "stream_to_archive": f"""WITH {TREND_SNAP_SQL}
SELECT source, geo, fetched_at, count(*) AS row_count, CAST(sum(volume_min) AS BIGINT) AS volume_sum
FROM trend_snap GROUP BY source, geo, fetched_at""",
}
