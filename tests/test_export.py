from datetime import datetime

import pytest
from tables import rows
from pyspark.sql import functions as F

from trendloom import envelopes, export, normalize, quality, reports, sinks

HEADER = '"Trends","Search volume","Started","Ended","Trend breakdown","Explore link"\n'


def write(folder, name, lines):
    (folder / name).write_text(HEADER + "".join(lines), encoding="utf-8")


def line(term, volume="5M+", started="August 15, 2026 at 7:10:00 AM UTC+3", ended="", terms="a, ,b"):
    cells = [term, volume, started, ended, terms, "./explore?q=" + term]
    return ",".join('"' + c.replace('"', '""') + '"' for c in cells) + "\n"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("exports")
    write(at, "trends_US_24h_sports_20260816-101500.csv", [
        line("active"), line('quo"ted, and\nbroken', "200K+", ended="August 15, 2026 at 9:00:00 AM UTC"), line("", "N/A", "x", "", ""),
    ])
    write(at, "trends_US-CA_168h_all_20260816-101600.csv", [line("west")])
    write(at, "other.csv", [line("lost")])
    return at


def test_file_name_and_rank(spark, folder):
    got = rows(export.read_exports(spark, str(folder)).select("geo", "hours", "category", "fetched_at", "rank", "Trends"))
    assert got == [
        ("US", 24, "sports", datetime(2026, 8, 16, 10, 15), 1, "active"),
        ("US", 24, "sports", datetime(2026, 8, 16, 10, 15), 2, 'quo"ted, and\nbroken'),
        ("US", 24, "sports", datetime(2026, 8, 16, 10, 15), 3, None),
        ("US-CA", 168, "all", datetime(2026, 8, 16, 10, 16), 1, "west"),
    ]


def test_foreign_names_are_set_aside(spark, folder):
    assert export.rejected_exports(spark, str(folder)).count() == 1
    one = export.read_exports(spark, str(folder), geos=["US-CA"], start="2026-08-16 10:16")
    assert rows(one.select("geo", "Trends")) == [("US-CA", "west")]
    assert export.read_exports(spark, str(folder), end="2026-08-16 10:15").count() == 3


def test_columns_by_name(spark, tmp_path):
    """Shuffled and added columns, a byte order mark, a missing column, an empty file, a foreign name, a file without rows."""
    name = lambda geo: tmp_path / f"trends_{geo}_24h_all_20260816-101500.csv"
    write(tmp_path, name("US").name, [line(f"us {i}") for i in range(700)])
    turned = ["\ufeffExplore link", "Note", "Ended", " Trends", "Started", "Search volume", "Trend breakdown"]
    body = "".join(f'l{i},"n,\n{i}",,"fr ""{i}""",s,{i}K+,b\n' for i in range(500))
    name("FR").write_text(",".join(turned) + "\n" + body, encoding="utf-8")
    name("DE").write_text("Trends,Volume\na,1\n")
    name("IT").write_text("")
    name("ES").write_text(HEADER)
    write(tmp_path, "other.csv", [line("lost")])
    got = export.read_exports_by_name(spark, str(tmp_path))
    want = [("US", i + 1, f"us {i}", "5M+", None) for i in range(700)]
    want += [("FR", i + 1, f'fr "{i}"', f"{i}K+", None) for i in range(500)]
    assert rows(got.select("geo", "rank", "Trends", "`Search volume`", "Ended")) == sorted(
        want, key=lambda r: tuple((v is None, str(v)) for v in r)
    )
    same = got.where("geo = 'US'").select("rank", *[f"`{c}`" for c in ("Trends", "Started", "Trend breakdown", "Explore link")])
    one = export.read_exports(spark, str(name("US")))
    assert rows(same) == rows(one.select(same.columns[0], *[f"`{c}`" for c in same.columns[1:]]))
    heads = {r.geo: (r.header[:2], r.missing, r.extra) for r in export.export_headers(spark, str(tmp_path)).collect()}
    assert heads["FR"] == (["Explore link", "Note"], [], ["Note"]) and heads["ES"][1:] == ([], [])
    assert heads["DE"][1] == ["Search volume", "Started", "Ended", "Trend breakdown", "Explore link"]
    reasons = {r.geo: r.reason for r in export.export_quarantine(spark, str(tmp_path)).collect()}
    assert reasons == {
        "DE": "no Search volume, Started, Ended, Trend breakdown, Explore link", None: "no export's name"
    }


def test_rank_is_the_line_over_many_files_and_batches(spark, tmp_path):
    for f in range(30):
        write(tmp_path, f"trends_US_4h_all_202608{f % 28 + 1:02d}-{f:06d}.csv", [line(f"{f}\n{i}") for i in range(480)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = export.read_exports(spark, str(tmp_path)).select("Trends", "rank").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 30 * 480 and all(int(r["Trends"].split("\n")[1]) + 1 == r["rank"] for r in got)


def test_large_files_are_read_in_blocks(spark, tmp_path):
    for f in range(2):
        write(tmp_path, f"trends_US_4h_all_2026080{f + 1}-000000.csv", [line(f"{i}") for i in range(4000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = export.read_exports(spark, str(tmp_path), multi_line=False)
        assert found.rdd.getNumPartitions() > 2
        got = found.select("Trends", "rank").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 8000 and all(int(r["Trends"]) + 1 == r["rank"] for r in got)


def test_reading_needs_no_shuffle(spark, folder):
    plan = normalize.normalize_export(export.read_exports(spark, str(folder)))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_other_headers_fail(spark, tmp_path):
    (tmp_path / "trends_US_24h_all_20260816-101500.csv").write_text("Trends,Volume\na,1\n")
    with pytest.raises(Exception):
        export.read_exports(spark, str(tmp_path)).collect()


def test_normalized(spark, folder):
    raw = export.read_exports(spark, str(folder)).where("geo = 'US'")
    got = normalize.normalize_export(raw).orderBy("rank").collect()
    assert [(r["keyword"], r["volume_min"], r["is_active"], r["related_queries"]) for r in got] == [
        ("active", 5_000_000, True, ["a", "b"]), ('quo"ted, and\nbroken', 200_000, False, ["a", "b"]), ("", 0, True, []),
    ]
    assert got[0]["started_at"] == datetime(2026, 8, 15, 4, 10)
    assert (got[2]["started_at"], got[2]["started_at_raw"]) == (None, "x")
    assert got[1]["ended_at"] == datetime(2026, 8, 15, 9)
    assert all(r["news"] == [] and r["image"] is None for r in got)


def test_union_with_feed_shape(spark, folder):
    csv = normalize.normalize_export(export.read_exports(spark, str(folder)))
    both = normalize.union_trends(csv, csv.withColumn("source", F.lit("rss")))
    assert both.count() == 2 * csv.count()


def test_envelopes_of_raw_rows(spark, folder):
    raw = export.read_exports(spark, str(folder)).where("geo = 'US'")
    got = envelopes.plain_envelopes(raw).first()
    assert got["count"] == 3 and [t["Search volume"] for t in got["trends"]] == ["5M+", "200K+", "N/A"]


def test_quality(spark, folder):
    raw = export.read_exports(spark, str(folder))
    got = rows(quality.export_quality(raw.where("geo IS NOT NULL"), minimum=1).select("geo", "row_count", "bad_started", "passes"))
    assert got == [("US", 3, 1, False), ("US-CA", 1, 0, True)]
    assert quality.missing_export_headers(["Trends", "Started"]) == ["Search volume", "Ended", "Trend breakdown", "Explore link"]


def test_filter_sort_and_top(spark, folder):
    raw = export.read_exports(spark, str(folder)).where("geo = 'US'")
    trends = normalize.normalize_export(raw).withColumn("category", F.lit("sports"))
    names = lambda df: [r["keyword"] for r in df.collect()]
    assert sorted(names(reports.filter_export(trends, 48, "SPORTS"))) == ["active", 'quo"ted, and\nbroken']
    assert names(reports.filter_export(trends, 48, active_only=True)) == ["active"]
    assert names(reports.filter_export(trends, 4)) == [] and names(reports.filter_export(trends, 48, "law")) == []
    with pytest.raises(ValueError):
        reports.filter_export(trends, 5)
    assert names(reports.sort_trends(trends, "title"))[0] == ""
    assert names(reports.sort_trends(trends, "volume")) == names(reports.sort_trends(trends))
    with pytest.raises(ValueError):
        reports.sort_trends(trends, "size")
    top = reports.top_export_rows(raw, n=1).collect()
    assert [(r["keyword"], r["terms"]) for r in top] == [("active", "a|b")]


def test_sinks_round_trip(spark, folder, tmp_path):
    trends = normalize.normalize_export(export.read_exports(spark, str(folder)))
    flat = trends.select("geo", "keyword", "volume_min", "started_at")
    sinks.write_csv(flat, str(tmp_path / "csv"))
    back = spark.read.schema(flat.schema).options(header=True, escape='"', multiLine=True).csv(str(tmp_path / "csv"))
    assert back.where("keyword LIKE 'quo%'").collect() == flat.where("keyword LIKE 'quo%'").collect()
    sinks.write_json(trends, str(tmp_path / "json"))
    assert rows(spark.read.schema(trends.schema).json(str(tmp_path / "json"))) == rows(trends)
    sinks.write_parquet(trends, str(tmp_path / "parquet"), partition_by=["source"])
    assert rows(spark.read.parquet(str(tmp_path / "parquet")).select(trends.columns)) == rows(trends)
