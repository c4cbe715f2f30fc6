import json
import os
import time
from datetime import datetime, timedelta

import pytest
from tables import rows
from test_changes import A, B, expected_history, random_history

from trendloom import alerts, archive, envelopes, ingest, landing, watch
from trendloom.operators.changes import change_summary, diff_history
from trendloom.schemas import CHANGES
from trendloom.streaming import interest


class Feed:
    """A landing directory that is watched until all of it is read."""

    def __init__(self, spark, path, limit=1, **options):
        self.spark, self.limit, self.files = spark, limit, 0
        self.land, self.out, self.check, self.folder = (str(path / n) for n in ("land", "out", "check", "watch"))
        (path / "land").mkdir(parents=True)
        self.job = watch.Watch(self.folder, alerts.changes_folder(self.out), **options)

    def put(self, *snapshots):
        lines = [
            json.dumps({"source": "rss", "geo": g, "fetched_at": t and f"{t.isoformat()}Z", "trends": [
                {"keyword": k, "rank": i, "volume_min": v} for i, (k, v) in enumerate(terms, 1)]})
            for g, t, terms in snapshots
        ]
        name = f"{self.land}/{self.files:04d}.json"
        with open(name, "w") as f:
            f.write("\n".join(lines))
        os.utime(name, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1

    def run(self):
        stream = landing.stream_snapshots(self.spark, self.land, self.limit, None)
        watch.start_watch(stream, self.job, self.check).awaitTermination()
        return alerts.read_changes(self.spark, self.out)

    def late(self):
        return watch.late_snapshots(self.spark, self.folder).select("geo", "fetched_at")


def test_equals_brute_force_over_restarts(spark, tmp_path):
    history = random_history(21, snapshots=25)
    feed = Feed(spark, tmp_path)
    ordered = sorted(history, key=lambda k: k[1])
    thirds = [ordered[:20], ordered[20:33], ordered[33:]]
    for part in thirds:
        feed.put(*[(g, t, history[g, t]) for g, t in reversed(part)])
        got = feed.run()
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == expected_history(history)
    last = {g: max(t for geo, t in history if geo == g) for g, _ in history}
    kept = {(r.geo, r.keyword, r.rank) for r in watch.baseline(spark, feed.folder).collect()}
    want = {(g, k, i) for g, t in last.items() for i, (k, _) in enumerate(history[g, t], 1) if k}
    assert kept == want


@pytest.mark.parametrize("limit", [1, 2, 3, None])
def test_limits_do_not_decide(spark, tmp_path, limit):
    """Six files, some with snapshots older than what landed before: the same rows whatever a batch holds."""
    at = [datetime(2026, 8, 5) + timedelta(hours=h) for h in range(8)]
    feed = Feed(spark, tmp_path, limit)
    feed.put(("US", at[2], A), ("FR", at[0], A))
    feed.put(("US", at[1], [("older", 1)]), ("US", at[2], [("again", 1)]))
    feed.put(("US", at[4], B), ("FR", at[3], []), ("US", at[3], A))
    feed.put(("US", at[3], [("late", 1)]), ("FR", at[5], B), (None, at[5], A), ("FR", None, A))
    feed.put((None, at[6], B), ("FR", at[4], [("late", 1)]))
    feed.put(("US", at[7], []), ("US", at[6], A))
    history = {("US", at[2]): A, ("US", at[3]): A, ("US", at[4]): B, ("US", at[6]): A, ("US", at[7]): [],
               ("FR", at[0]): A, ("FR", at[3]): [], ("FR", at[5]): B, (None, at[5]): A, (None, at[6]): B}
    got = [tuple(r) for r in feed.run().collect()]
    assert len(got) == len(set(got)) and set(got) == expected_history(history)
    assert rows(feed.late()) == rows(
        spark.createDataFrame(
            [("US", at[1]), ("US", at[2]), ("US", at[3]), ("FR", at[4]), ("FR", None)], "geo string, fetched_at timestamp"
        )
    )


def test_repeated_batch_finds_the_same(spark, tmp_path):
    """A batch that Spark runs again after a crash before its commit."""
    at = datetime(2026, 8, 5)
    feed = Feed(spark, tmp_path, 1)
    feed.put(("US", at, A))
    feed.put(("US", at + timedelta(hours=1), B))
    first = rows(feed.run())
    last = max(int(x) for x in os.listdir(f"{feed.check}/commits") if x.isdigit())
    for name in (str(last), f".{last}.crc"):
        os.remove(f"{feed.check}/commits/{name}")
    assert rows(feed.run()) == first and feed.late().count() == 0


def test_baseline_then_filtered_changes(spark, tmp_path):
    feed = Feed(spark, tmp_path, events=["new", "volume_up"], min_volume=50)
    at = datetime(2026, 8, 5)
    feed.put(("US", at, A))
    assert feed.run().count() == 0
    feed.put(("US", at + timedelta(hours=1), B))
    assert rows(feed.run().select("event", "keyword", "volume_min")) == [("volume_up", "east", 333)]


def test_null_geo_is_a_geo(spark):
    at = datetime(2026, 8, 5)
    trends = spark.createDataFrame(
        [("rss", None, at, "gone", 1, 5), ("rss", None, at + timedelta(hours=1), "came", 1, 6)],
        "source string, geo string, fetched_at timestamp, keyword string, rank int, volume_min long",
    )
    heads = trends.groupBy("source", "geo", "fetched_at").count().withColumnRenamed("count", "trend_count")
    changes = diff_history(trends, heads)
    assert rows(changes.select("event", "keyword")) == [("dropped", "gone"), ("new", "came")]
    summary = change_summary(heads, changes).select("baseline", "previous_count", "current_count", "change_count")
    assert rows(summary) == [(False, 1, 1, 2), (True, None, 1, 0)]


XML = '<?xml version="1.0"?><rss xmlns:ht="x:y"><channel>{}</channel></rss>'


def test_feeds_to_alerts(spark, tmp_path):
    def land(n, terms, xml=None):
        items = "".join(f"<item><title>{k}</title><ht:approx_traffic>{v}+</ht:approx_traffic></item>" for k, v in terms)
        row = [("US", datetime(2026, 8, 5 + n), xml or XML.format(items))]
        spark.createDataFrame(row, "geo string, fetched_at timestamp, xml string").coalesce(1).write.mode("append").parquet(land_at)

    land_at, out, check, found = (str(tmp_path / x) for x in ("land", "out", "check", "found"))
    job = watch.Watch(str(tmp_path / "watch"), alerts.changes_folder(found), keywords=["BIT"], events=["volume_up", "dropped"])
    for n, (terms, xml) in enumerate([([("bitcoin", 5), ("x", 1)], None), ([("bitcoin", 9)], None), ([], "<rss><chan"), ([], None)]):
        land(n, terms, xml)
        stream = landing.stream_feeds(spark, land_at, 1)
        watch.start_watch(stream, job, str(tmp_path / "watch-check")).awaitTermination()
        alerts.start_alerts(alerts.stream_changes(spark, found), out, check).awaitTermination()
    got = [json.loads(r.record) for r in alerts.alert_records(spark, out).collect()]
    assert sorted((r["event"], r["keyword"], r["prev_volume_min"]) for r in got) == [("dropped", "bitcoin", 9), ("volume_up", "bitcoin", 5)]


def test_delivery_counts_across_a_restart(spark, found, tmp_path):
    """Refused records are tried again and counted; the log and the observed counts agree."""
    changes, log, check = (str(tmp_path / x) for x in ("changes", "log", "check"))

    def send(record):
        if json.loads(record)["event"] == "dropped":
            raise ConnectionError
        return True

    listener = alerts.DeliveryCounts()
    spark.streams.addListener(listener)
    try:
        for batch in range(2):
            alerts.changes_folder(changes)(found, batch)
            alerts.changes_folder(changes)(found, batch)  # repeated: written once
            stream = alerts.stream_changes(spark, changes)
            alerts.start_delivery(stream, send, log, check, attempts=3).awaitTermination()
        until = time.time() + 30
        while listener.totals["delivered"] < 2 and time.time() < until:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert dict(listener.totals) == {"delivered": 2, "failed": 2, "tries": 8}
    assert tuple(alerts.delivery_report(alerts.delivery_log(spark, log)).first()) == (2, 2)


def test_archive_stream_keeps_each_key_once(spark, tmp_path):
    land, root, check = (str(tmp_path / x) for x in ("land", "root", "check"))
    archive.create(spark, root)
    schema = "source string, geo string, fetched_at timestamp, keyword string, rank int, volume_text string, volume_min long"
    extra = [("started_at", "timestamp"), ("started_at_raw", "string"), ("ended_at", "timestamp"), ("is_active", "boolean"),
             ("related_queries", "array<string>"), ("explore_url", "string")]

    def put(hours):
        data = [("rss", "US", datetime(2026, 8, 5, h), k, i, "1+", 1) for h in hours for i, k in enumerate("abc", 1)]
        trends = spark.createDataFrame(data, schema)
        for name, kind in extra:
            trends = trends.selectExpr("*", f"cast(null as {kind}) as {name}")
        trends = trends.selectExpr("*", "cast(null as array<struct<headline:string,url:string,source:string,image:string>>) as news",
                                   "cast(null as struct<url:string,source:string>) as image")
        packed = envelopes.snapshot_envelopes(trends)
        packed.coalesce(1).write.mode("append").parquet(land)
        return packed.schema

    for hours in ([5, 6], [5, 7], [6, 7, 1]):
        kind = put(hours)
        rows_ = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(land)
        ingest.start_archive(rows_.selectExpr("*", "_metadata.file_modification_time as landed_at"), root, check).awaitTermination()
    stored = archive.trends(spark, root).groupBy("fetched_at").count()
    assert rows(stored.selectExpr("hour(fetched_at)", "count")) == [(1, 3), (5, 3), (6, 3), (7, 3)]


def test_interest_counts_close_with_the_watermark(spark, tmp_path):
    land, out, check = (str(tmp_path / x) for x in ("land", "out", "check"))
    day = lambda d, h: datetime(2026, 8, d, h)

    def put(*events):
        spark.createDataFrame(list(events), "keyword string, ts timestamp").coalesce(1).write.mode("append").parquet(land)
        stream = spark.readStream.schema("keyword string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(land)
        interest.start_counts(interest.bucket_stream(stream), out, check).awaitTermination()

    put(("a", day(1, 3)), ("a", day(1, 9)), ("b", day(1, 23)), (None, day(1, 1)))
    put(("a", day(2, 3)), ("a", day(1, 22)))
    put(("a", day(4, 12)), ("b", day(4, 1)))
    put(("a", day(1, 5)), ("a", day(9, 1)))  # the first one is too late
    got = interest.stored_counts(spark, out).selectExpr("keyword", "day(ts)", "n")
    assert rows(got) == [("a", 1, 3), ("a", 2, 1), ("a", 4, 1), ("b", 1, 1), ("b", 4, 1), (None, 1, 1)]


@pytest.fixture
def found(spark):
    when = datetime(2026, 8, 5)
    return spark.createDataFrame(
        [("rss", "US", when, "new", "a", 1, None, 5, None), ("rss", "US", when, "dropped", "b", None, 2, None, 7)], CHANGES
    )


def test_alert_records(spark, found, tmp_path):
    write = alerts.alert_folder(str(tmp_path))
    write(found, 3)
    write(found, 3)
    got = [json.loads(r["record"]) for r in alerts.read_alerts(spark, str(tmp_path)).collect()]
    assert len(got) == 2 and {r["keyword"] for r in got} == {"a", "b"}
    assert all(set(r) == set(found.columns) for r in got)


def test_failed_deliveries_are_counted(found):
    def send(record):
        if json.loads(record)["event"] == "dropped":
            raise ConnectionError
        return True

    assert tuple(alerts.delivery_report(alerts.deliver(found, send)).first()) == (1, 1)
    assert tuple(alerts.delivery_report(alerts.deliver(found, lambda r: None)).first()) == (0, 2)
