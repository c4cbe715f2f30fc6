import json
from datetime import datetime

import pytest
from tables import rows
from pyspark.sql import functions as F, types as T

from trendloom import archive
from trendloom.operators.envelopes import snapshot_envelopes
from trendloom.schemas import TREND_FIELDS, TREND_STRUCT

ENTRY = "array<struct<keyword:string,rank:int,volume_text:string,volume_min:bigint>>"
SHAPE = f"source STRING, geo STRING, fetched_at TIMESTAMP, trends {ENTRY}"
HISTORY = [
    ("rss", "US", datetime(2031, 3, 14, 9), ["harbor", "tide table"]),
    ("csv", "PT", datetime(2031, 3, 14, 9, 30), ["quilt fair"]),
    ("rss", "US", datetime(2031, 3, 14, 10), ["harbor"]),
    ("rss", "US", datetime(2031, 3, 14, 11), ["night train"]),
]


def normalize_fields():
    """Names and types of a trend's fields."""
    kinds = T._parse_datatype_string(TREND_STRUCT)
    return {f.name: f.dataType for f in kinds.fields if f.name in TREND_FIELDS}


def envelopes(spark, history=HISTORY):
    data = [(s, g, t, [(k, i, f"{i}+", i * 10) for i, k in enumerate(ks, 1)]) for s, g, t, ks in history]
    made = spark.createDataFrame(data, SHAPE).withColumn("schema_version", F.lit("1.0"))
    return made.withColumn("payload_json", F.to_json(F.struct("source", "geo", "fetched_at", "trends")))


@pytest.fixture
def root(spark, tmp_path):
    at = str(tmp_path / "archive")
    archive.create(spark, at)
    archive.append(spark, at, envelopes(spark))
    return at


def hours(found):
    return [r["fetched_at"].hour + r["fetched_at"].minute / 60 for r in found.collect()]


def test_new_archive_is_empty(spark, tmp_path):
    at = str(tmp_path / "none")
    archive.create(spark, at)
    archive.create(spark, at)
    assert archive.snapshots(spark, at).count() == archive.trends(spark, at).count() == 0
    stats = archive.archive_stats(archive.snapshots(spark, at), archive.trends(spark, at)).first()
    assert (stats["snapshot_count"], stats["trend_row_count"], stats["geos"], stats["first_fetched_at"]) == (0, 0, [], None)


def test_append_twice_is_once(spark, root):
    before = rows(archive.trends(spark, root)), rows(archive.snapshots(spark, root))
    archive.append(spark, root, envelopes(spark))
    more = envelopes(spark, HISTORY[:1] + [("rss", "US", datetime(2031, 3, 14, 12), [])])
    archive.append(spark, root, more.unionAll(more))
    assert rows(archive.trends(spark, root)) == before[0]
    got = archive.snapshots(spark, root)
    assert got.count() == len(before[1]) + 1
    assert got.where("hour(fetched_at) = 12").first()["trend_count"] == 0


def test_first_stored_wins(spark, root):
    archive.append(spark, root, envelopes(spark, [("rss", "US", datetime(2031, 3, 14, 9), ["other"])]))
    assert archive.trends(spark, root).where("keyword = 'other'").count() == 0


def test_differing_duplicates_in_one_batch_give_one_snapshot(spark, tmp_path):
    at = str(tmp_path / "dup")
    archive.create(spark, at)
    when = datetime(2031, 3, 15)
    both = envelopes(spark, [("rss", "US", when, ["a", "b"]), ("rss", "US", when, ["c"])])
    archive.append(spark, at, both)
    head = archive.snapshots(spark, at).collect()
    kept = {r["keyword"] for r in archive.trends(spark, at).collect()}
    assert len(head) == 1 and kept in ({"a", "b"}, {"c"}) and head[0]["trend_count"] == len(kept)


def test_interrupted_append_is_finished_by_the_next(spark, root, monkeypatch):
    batch = envelopes(spark, [("rss", "US", datetime(2031, 3, 16), ["late", "later"])])
    real = archive._write

    def failing(df, path, sort=()):
        if path.endswith("snapshots"):
            raise OSError("lost")
        real(df, path, sort)

    monkeypatch.setattr(archive, "_write", failing)
    with pytest.raises(OSError):
        archive.append(spark, root, batch)
    monkeypatch.setattr(archive, "_write", real)
    archive.append(spark, root, batch)
    assert archive.trends(spark, root).where("keyword LIKE 'late%'").count() == 2
    assert archive.snapshots(spark, root).count() == 5


@pytest.mark.parametrize("table", ["trends", "snapshots"])
def test_half_a_table_written(spark, root, monkeypatch, table):
    """A write that dies with a part of its rows in place leaves nothing half; the rerun makes it whole."""
    days = [("rss", g, datetime(2031, 3, 17, h), ["wide", "narrow", "low"]) for g in ("US", "PT") for h in range(4)]
    real = archive._write

    def dying(df, path, sort=()):
        if not path.endswith(table):
            return real(df, path, sort)
        real(df.where("geo = 'US' AND hour(fetched_at) < 3" + (" AND rank < 3" if table == "trends" else "")), path, sort)
        raise OSError("lost")

    monkeypatch.setattr(archive, "_write", dying)
    with pytest.raises(OSError):
        archive.append(spark, root, envelopes(spark, days))
    monkeypatch.setattr(archive, "_write", real)
    per_key = lambda: archive.trends(spark, root).where("keyword IN ('wide', 'narrow', 'low')").groupBy("geo", "fetched_at").count()
    assert {r["count"] for r in per_key().collect()} <= {3}
    archive.append(spark, root, envelopes(spark, days))
    found = per_key().collect()
    assert len(found) == 8 and {r["count"] for r in found} == {3}
    assert archive.snapshots(spark, root).count() == 4 + 8


def test_two_appends_at_once_count_once(spark, root, monkeypatch):
    when = datetime(2031, 3, 18)
    first, second = (envelopes(spark, [("rss", "US", when, ks)]) for ks in (["a", "b"], ["c"]))
    monkeypatch.setattr(archive, "_missing", lambda rows, existing: rows)  # neither sees the other
    archive.append(spark, root, first)
    archive.append(spark, root, second)
    monkeypatch.undo()
    kept = archive.snapshots(spark, root).where(F.col("fetched_at") == F.lit(when)).collect()
    assert [r["trend_count"] for r in kept] == [2]
    assert rows(archive.trends(spark, root).where(F.col("fetched_at") == F.lit(when)).select("keyword")) == [("a",), ("b",)]
    assert archive.stored(spark, root, "trends").where("keyword = 'c'").count() == 1
    # a prune leaves out what no longer counts
    assert archive.prune(spark, root, "2031-03-14T10:00:00Z") == 2
    assert archive.prune(spark, root, "2032-01-01", geo="US") == 3
    assert archive.stored(spark, root, "trends").count() == 0


def test_rows_without_label_are_the_first_batch(spark, root):
    old = archive.stored(spark, root, "snapshots").where("hour(fetched_at) = 11").drop("batch")
    gone = archive.stored(spark, root, "trends").where("keyword = 'night train'").drop("batch")
    for frame, table in ((old, "snapshots"), (gone.withColumn("keyword", F.lit("old train")), "trends")):
        frame.write.mode("append").partitionBy("source", "fetched_date").parquet(f"{root}/{table}")
    assert archive.snapshots(spark, root).count() == 4
    assert archive.trends(spark, root).where("keyword LIKE '% train'").first()["keyword"] == "old train"


def test_long_and_empty_snapshots_are_whole(spark, tmp_path):
    at = str(tmp_path / "long")
    archive.create(spark, at)
    when = F.lit("2031-03-14").cast("timestamp")
    row = lambda n, rank: spark.range(n).select(
        F.lit("csv").alias("source"), F.concat(F.lit("G"), F.lit(str(n))).alias("geo"), when.alias("fetched_at"),
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("keyword"), rank.cast("int").alias("rank"),
        F.lit("1+").alias("volume_text"), F.lit(1).cast("bigint").alias("volume_min"),
    )
    trends = row(1500, F.col("id") + 1).union(row(7, F.col("id") + 2000)).union(row(2, F.when(F.col("id") == 0, 1)))
    for name, kind in normalize_fields().items():
        if name not in trends.columns:
            trends = trends.withColumn(name, F.lit(None).cast(kind))
    empty = spark.createDataFrame([("csv", "G0", datetime(2031, 3, 14))], "source STRING, geo STRING, fetched_at TIMESTAMP")
    headers = trends.select("source", "geo", "fetched_at").union(empty)
    packed = snapshot_envelopes(trends, headers)
    archive.append(spark, at, packed)
    got = {r["geo"]: r for r in archive.snapshots(spark, at).collect()}
    assert {g: r["trend_count"] for g, r in got.items()} == {"G1500": 1500, "G7": 7, "G2": 2, "G0": 0}
    for geo, n in (("G1500", 1500), ("G7", 7), ("G0", 0)):
        payload = json.loads(got[geo]["payload_json"])
        assert payload["count"] == n and [t["keyword"] for t in payload["trends"]] == [f"k{i}" for i in range(n)]
    assert [t.get("rank") for t in json.loads(got["G2"]["payload_json"])["trends"]] == [1, None]


def test_the_day_is_utc_whatever_the_session_says(spark, root):
    zone = spark.conf.get("spark.sql.session.timeZone")
    when = datetime(2031, 3, 20, 2)
    batch = envelopes(spark, [("rss", "US", when, ["late"])]).persist()
    try:
        batch.count()
        archive.append(spark, root, batch)
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        archive.append(spark, root, batch)
        rows_ = archive.trends(spark, root)
        assert rows_.where("keyword = 'late'").count() == 1
        bound = {"start": "2031-03-20T02:00:00Z", "end": "2031-03-20T02:00:00Z"}
        assert archive.read_snapshots(archive.snapshots(spark, root), rows_, **bound).count() == 1
        assert archive.prune(spark, root, "2031-03-20T02:00:01Z", source="rss") == 4
        assert archive.snapshots(spark, root).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_incomplete_keys_are_set_aside(spark, root):
    batch = envelopes(spark, [("rss", None, datetime(2031, 3, 14), ["a"]), ("rss", "US", None, ["b"]), ("csv", "US", datetime(2031, 3, 14), ["c"])])
    for _ in range(2):
        archive.append(spark, root, batch)
    assert archive.trends(spark, root).count() == 6 and archive.snapshots(spark, root).count() == 5
    assert rows(archive.incomplete(batch).select("reason")) == [("no fetched_at",), ("no geo",)]


def test_keyword_rows_of_every_kind(spark):
    when = datetime(2031, 3, 14)
    shape = f"source STRING, geo STRING, fetched_at TIMESTAMP, trends {ENTRY}, keywords ARRAY<STRING>, keyword STRING"
    made = spark.createDataFrame(
        [
            ("rss", "US", when, [("a", 1, "5+", 5)], None, None),
            ("explore", "US", when, None, None, "b"),
            ("explore_comparison", "US", when, None, ["c", "d"], None),
            ("rss", "DE", when, [], None, None),
            ("x", "US", when, None, None, None),
        ],
        shape,
    )
    got = rows(archive.keyword_rows(made).select("source", "keyword", "rank", "volume_min"))
    assert got == [
        ("explore", "b", None, None), ("explore_comparison", "c", None, None),
        ("explore_comparison", "d", None, None), ("rss", "a", 1, 5),
    ]


def test_read(spark, root):
    head, trends = archive.snapshots(spark, root), archive.trends(spark, root)
    read = lambda **kw: hours(archive.read_snapshots(head, trends, **kw))
    assert read() == [11, 10, 9.5, 9]
    assert read(geo="US") == [11, 10, 9]
    assert read(geo="US", start="2031-03-14 09:00", end=datetime(2031, 3, 14, 10)) == [10, 9]
    assert read(start="2031-03-14T12:00:00+02:00") == [11, 10]
    assert read(end="2031-03-14") == [] and read(start="2031-03-14") == [11, 10, 9.5, 9]
    assert read(keyword="HARBOR") == [10, 9]
    assert read(keyword=" harbor") == []
    assert read(geo="US", limit=1) == [11]
    assert read(source=["csv", "explore"]) == [9.5] and read(source="csv") == [9.5]
    for bad in ({"source": []}, {"source": [1]}, {"start": " "}):
        with pytest.raises(ValueError):
            read(**bad)


def test_filters_prune_partitions(spark, root):
    found = archive.matching(archive.trends(spark, root), source="rss", start="2031-03-14")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan and "fetched_date" in plan.split("PartitionFilters")[1][:200]
    looked = archive.keyword_history(archive.trends(spark, root), "harbor")
    assert "EqualTo(keyword_key,harbor)" in looked._jdf.queryExecution().executedPlan().toString()


def test_history(spark, root):
    trends = archive.trends(spark, root)
    got = archive.keyword_history(trends, " HarBor ").collect()
    assert [(r["fetched_at"].hour, r["rank"], r["volume_min"]) for r in got] == [(9, 1, 10), (10, 1, 10)]
    assert archive.keyword_history(trends, "nothing").count() == 0
    with pytest.raises(ValueError):
        archive.keyword_history(trends, "  ")


def test_history_folds_ascii_only_and_keeps_repeats(spark, tmp_path):
    at = str(tmp_path / "fold")
    archive.create(spark, at)
    archive.append(spark, at, envelopes(spark, [("rss", "FR", datetime(2031, 3, 14), ["École", "école", "ECOLE", "Ecole"])]))
    trends = archive.trends(spark, at)
    assert [r["rank"] for r in archive.keyword_history(trends, "école").collect()] == [2]
    assert [r["rank"] for r in archive.keyword_history(trends, "ecole").collect()] == [3, 4]


def test_compact_history(spark, root):
    head, trends = archive.snapshots(spark, root), archive.trends(spark, root)
    entries, line = archive.compact_history(head, trends, geo="US", keyword="harbor", limit=1)
    assert [(r["fetched_at"].hour, r["keyword"]) for r in entries.collect()] == [(10, "harbor")]
    assert hours(line) == [9, 10]
    assert archive.compact_history(head, trends)[1] is None
    for limit in (0, 101):
        with pytest.raises(ValueError):
            archive.compact_history(head, trends, limit=limit)


def test_stats(spark, root):
    stats = archive.archive_stats(archive.snapshots(spark, root), archive.trends(spark, root)).first()
    assert stats.asDict() == {
        "snapshot_count": 4, "trend_row_count": 5, "geos": ["PT", "US"], "sources": ["csv", "rss"],
        "first_fetched_at": datetime(2031, 3, 14, 9), "last_fetched_at": datetime(2031, 3, 14, 11), "answer_count": 0,
    }


def test_prune_is_strict_and_takes_trends_along(spark, root):
    assert archive.prune_counts(archive.snapshots(spark, root), datetime(2031, 3, 14, 10)).first()["deleted"] == 2
    assert archive.prune(spark, root, datetime(2031, 3, 14, 10)) == 2
    assert rows(archive.snapshots(spark, root).select(F.hour("fetched_at"))) == [(10,), (11,)]
    assert rows(archive.trends(spark, root).select("keyword")) == [("harbor",), ("night train",)]
    assert archive.prune(spark, root, datetime(2031, 3, 14, 10)) == 0


def test_prune_by_geo_and_source(spark, root):
    assert archive.prune(spark, root, "2032-01-01", geo="PT") == 1
    assert archive.prune(spark, root, "2032-01-01", source="csv") == 0
    assert archive.snapshots(spark, root).count() == 3
    assert archive.prune(spark, root, "2032-01-01", source="rss") == 3
    assert archive.trends(spark, root).count() == archive.snapshots(spark, root).count() == 0


def test_layout_guard(spark, root):
    head = archive.snapshots(spark, root)
    assert archive.guard_layout(head).count() == 4 and archive.incompatible_layout(head).count() == 0
    assert archive.incompatible_layout(head, 2).first()["snapshot_count"] == 4
    with pytest.raises(Exception, match="unsupported archive layout 1"):
        archive.guard_layout(head, 2).select("geo").collect()


@pytest.mark.parametrize("table", ["trends", "snapshots"])
def test_readers_refuse_other_layouts(spark, root, table):
    other = archive.stored(spark, root, table).limit(1).withColumn("layout_version", F.lit(99))
    other.write.mode("append").partitionBy("source", "fetched_date").parquet(f"{root}/{table}")
    reader = {"trends": archive.trends, "snapshots": archive.snapshots}[table]
    with pytest.raises(Exception, match="unsupported archive layout 99"):
        reader(spark, root).select("geo").collect()
    assert archive.incompatible_layout(archive.stored(spark, root, table)).first()["snapshot_count"] == 1


def test_movement(spark, root):
    got = archive.keyword_movement(archive.trends(spark, root), "US").where("keyword = 'harbor'").orderBy("fetched_at").collect()
    assert [(r["first_seen_at"].hour, r["prev_rank"], r["moved_up"]) for r in got] == [(9, None, None), (9, 1, 0)]


def test_only_repeated_keys_are_sorted_whole(spark):
    from datetime import datetime

    at = datetime(2026, 1, 1)
    schema = "source string, geo string, fetched_at timestamp, schema_version string, payload_json string"
    one = spark.createDataFrame([("rss", f"g{i}", at, "1.0", f"p{i}") for i in range(5)], schema)
    assert "Aggregate" not in archive._one_per_key(one)._jdf.queryExecution().optimizedPlan().toString()
    two = one.unionByName(spark.createDataFrame([("rss", "g1", at, "1.0", "other"), ("rss", "g2", at, "1.0", "p2")], schema))
    kept = archive._one_per_key(two).collect()
    assert sorted(r.geo for r in kept) == [f"g{i}" for i in range(5)]
    assert {r.payload_json for r in kept} - {"other", "p1"} == {"p0", "p2", "p3", "p4"}
