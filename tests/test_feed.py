import json
from datetime import datetime

import pytest
from tables import rows
from pyspark.sql import functions as F

from trendloom import envelopes, feed, normalize

HEAD = '<rss xmlns:ht="https://trends.google.com/trending/rss" version="2.0"><channel><title>Daily</title>'
FULL = (
    HEAD
    + "<item><title>alpha &amp; co</title><ht:approx_traffic>2K+</ht:approx_traffic>"
    "<pubDate>Tue, 4 Nov 2025 03:00:00 -0800</pubDate><ht:picture>https://p</ht:picture>"
    "<ht:picture_source>Pics</ht:picture_source>"
    + "".join(
        f"<ht:news_item><ht:news_item_title>h{i}</ht:news_item_title><ht:news_item_url>u{i}</ht:news_item_url>"
        f"<ht:news_item_source>s{i}</ht:news_item_source><ht:news_item_picture> </ht:news_item_picture></ht:news_item>"
        for i in range(7)
    )
    + "</item><item><title></title><ht:approx_traffic/><pubDate>2025/11/04</pubDate></item>"
    "<item><ht:approx_traffic>500+</ht:approx_traffic></item><item><title><![CDATA[x <y>]]></title></item></channel></rss>"
)
EMPTY = HEAD + "</channel></rss>"
BROKEN = HEAD + "<item><title>x</title>"


@pytest.fixture(scope="module")
def landing(spark):
    docs = [("US", FULL), ("DE", EMPTY), ("GB", BROKEN), ("FR", "junk"), ("IT", ""), ("ES", None)]
    return spark.createDataFrame(docs, "geo STRING, xml STRING").withColumn(
        "fetched_at", F.lit("2025-11-04 12:00:00").cast("timestamp")
    )


def test_rows_in_document_order(landing):
    got = feed.read_feeds(landing).orderBy("rank").collect()
    assert [(r["rank"], r["trend"], r["traffic"], r["traffic_min"]) for r in got] == [
        (1, "alpha & co", "2K+", 2000), (2, "", "", 0), (3, "N/A", "500+", 500), (4, "x <y>", "N/A", 0),
    ]
    assert got[0]["published"] == datetime(2025, 11, 4, 11)
    assert (got[1]["published"], got[1]["published_raw"]) == (None, "2025/11/04")
    assert got[0]["image"].asDict() == {"url": "https://p", "source": "Pics"}
    assert [a["headline"] for a in got[0]["news_articles"]] == ["h0", "h1", "h2", "h3", "h4"]
    assert [len(r["news_articles"]) for r in got] == [5, 0, 0, 0]
    assert got[0]["explore_link"].endswith("explore?q=alpha & co&geo=US&hl=en-US")
    assert got[1]["explore_link"].endswith("explore?q=None&geo=US&hl=en-US")


def test_broken_documents_are_set_aside(landing):
    assert sorted(r["geo"] for r in feed.rejected_feeds(landing).collect()) == ["ES", "FR", "GB", "IT"]
    assert rows(feed.feed_snapshots(landing).select("geo", "trend_count")) == [("DE", 0), ("US", 4)]


def test_each_document_is_parsed_once(landing):
    for df in (feed.read_feeds(landing), feed.rejected_feeds(landing), feed.feed_snapshots(landing), feed.feed_envelopes(landing)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_xml") == 1


def test_options(landing):
    slim = feed.read_feeds(landing, include_images=False, include_articles=False)
    assert not {"image", "news_articles"} & set(slim.columns)
    assert set(normalize.flatten_feed(slim).columns).isdisjoint({"image_url", "article_count"})
    assert normalize.normalize_feed(slim).where("size(news) > 0 OR image IS NOT NULL").count() == 0
    capped = feed.read_feeds(landing, max_articles=2).where("rank = 1").first()
    assert len(capped["news_articles"]) == 2
    with pytest.raises(ValueError):
        feed.read_feeds(landing, max_articles=-1)


def test_normalized(landing):
    got = normalize.normalize_feed(feed.read_feeds(landing)).orderBy("rank").collect()
    assert [r["keyword"] for r in got] == ["alpha & co", "", "N/A", "x <y>"]
    assert all(r["is_active"] and r["ended_at"] is None and r["related_queries"] == [] for r in got)
    assert got[0]["news"][0].asDict() == {"headline": "h0", "url": "u0", "source": "s0", "image": None}
    assert got[0]["image"]["url"] == "https://p" and got[1]["image"] is None


def test_flat(landing):
    got = normalize.flatten_feed(feed.read_feeds(landing)).orderBy("rank").collect()
    assert (got[0]["article_count"], got[0]["top_article_headline"], got[0]["image_url"]) == (5, "h0", "https://p")
    assert (got[1]["article_count"], got[1]["top_article_headline"]) == (0, None)


def test_envelopes_agree_with_rows(landing):
    direct = feed.feed_envelopes(landing)
    assert rows(direct.select("geo", "count", "schema_version")) == [("DE", 0, "1.0"), ("US", 4, "1.0")]
    grouped = envelopes.snapshot_envelopes(normalize.normalize_feed(feed.read_feeds(landing)))
    assert direct.where("geo = 'US'").first()["trends"] == grouped.first()["trends"]
    payload = json.loads(direct.where("geo = 'US'").first()["payload_json"])
    assert payload["count"] == 4 and [t["rank"] for t in payload["trends"]] == [1, 2, 3, 4]


def test_headers_keep_empty_snapshots(landing):
    trends = normalize.normalize_feed(feed.read_feeds(landing))
    headers = feed.feed_envelopes(landing).select("source", "geo", "fetched_at")
    assert rows(envelopes.snapshot_envelopes(trends, headers).select("geo", "count")) == [("DE", 0), ("US", 4)]
    plain = envelopes.plain_envelopes(feed.read_feeds(landing), headers)
    assert rows(plain.select("geo", "count")) == [("DE", 0), ("US", 4)]


def test_plain_envelope(landing):
    got = envelopes.plain_envelopes(feed.read_feeds(landing)).first()
    assert (got["geo"], got["count"], [t["trend"] for t in got["trends"]]) == ("US", 4, ["alpha & co", "", "N/A", "x <y>"])


def test_compact(landing):
    trends = normalize.normalize_feed(feed.read_feeds(landing))
    assert normalize.compact(trends, ["US"]).columns[3:] == ["keyword", "rank", "volume_min", "is_active"]
    assert normalize.compact(trends, ["DE"]).count() == 0
    for geos in ([], ["X"] * 21):
        with pytest.raises(ValueError):
            normalize.compact(trends, geos)


def test_compact_keeps_all_areas_of_a_region(spark):
    from trendloom.plans.base import region_of

    geos = ["ASIA", "ASIA 1", "ASIA 12", "MIDDLE EAST 2", "AFRICA", None]
    trends = spark.createDataFrame([("rss", g, "k", 1, 5, True) for g in geos], "source STRING, geo STRING, keyword STRING, rank INT, volume_min BIGINT, is_active BOOLEAN")
    trends = trends.withColumn("fetched_at", F.lit("2025-11-04").cast("timestamp"))
    kept = normalize.compact(trends, ["ASIA", "MIDDLE EAST"], within=region_of(F.col("geo")))
    assert sorted(r.geo for r in kept.collect()) == ["ASIA", "ASIA 1", "ASIA 12", "MIDDLE EAST 2"]
    assert [r.geo for r in normalize.compact(trends, ["ASIA"]).collect()] == ["ASIA"]


def test_partitioned_parquet_has_a_file_per_folder(spark, tmp_path):
    from trendloom.sinks import files

    rows_ = spark.range(0, 800, 1, 8).select(F.concat(F.lit("g"), F.col("id") % 3).alias("geo"), "id")
    files.write_parquet(rows_, str(tmp_path / "out"), partition_by=["geo"])
    assert len(list(tmp_path.glob("out/geo=*/*.parquet"))) == 3
    assert spark.read.parquet(str(tmp_path / "out")).count() == 800


def test_documents_are_rendered_after_their_trends_met(spark, tmp_path):
    from datetime import datetime

    from trendloom.plans import feeds

    day = datetime(1996, 3, 5)
    tables = {
        "region": ("r_regionkey int, r_name string", [(0, "ASIA")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "N", 0)]),
        "customer": ("c_custkey long, c_nationkey int", [(1, 0)]),
        "orders": ("o_orderkey long, o_custkey long", [(1, 1)]),
        "part": ("p_partkey long, p_name string", [(1, "a & b"), (2, "c")]),
        "lineitem": ("l_orderkey long, l_partkey long, l_shipdate timestamp_ntz", [(1, 1, day), (1, 1, day), (1, 2, day)]),
        "documents": ("doc_id long, text string, lang string, source string", [(0, "x <y>", "de", "src0"), (1, None, None, None)]),
    }
    for name, (schema, data) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    found = feeds.rendered(spark, str(tmp_path))
    [document] = found.collect()
    assert "<title>a &amp; b</title><ht:approx_traffic>2+</ht:approx_traffic>" in document.xml
    assert document.xml.index("<title>c</title>") > document.xml.index("Breaking: x &lt;y&gt;")
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    grouped = next(i for i, line in enumerate(plan) if "Aggregate [geo" in line)
    assert not any("<item>" in line for line in plan[grouped + 1 :])


def test_sink_files_of_the_feeds_are_small(spark, tmp_path, monkeypatch):
    """Rows of text repeat names and addresses: what the sink queries write takes a part of that, and all of it comes back."""
    from trendloom.plans import feeds

    docs = [(f"area {i}", FULL.replace("alpha", f"alpha {i}")) for i in range(300)]
    made = spark.createDataFrame(docs, "geo STRING, xml STRING").withColumn("fetched_at", F.lit("2026-01-01").cast("timestamp")).coalesce(1)
    monkeypatch.setattr(feeds, "landing", lambda *_: made)
    monkeypatch.setattr(feeds, "shared_folder", lambda _, purpose: str(tmp_path / purpose))
    raw = feed.read_feeds(made)
    for query, purpose, plain in (
        (feeds.csv_sink, "csv-sink", normalize.flatten_feed(raw)), (feeds.json_sink, "json-sink", normalize.normalize_feed(raw))
    ):
        got = query(spark, "")
        assert got.count() == plain.count() == 1200
        text = plain.select(F.to_json(F.struct("*")).alias("t")).agg(F.sum(F.length("t"))).first()[0]
        written = sum(f.stat().st_size for f in (tmp_path / purpose).glob("part-*"))
        assert 0 < written < text / 5
        assert {r.geo for r in got.select("geo").collect()} == {f"area {i}" for i in range(300)}
