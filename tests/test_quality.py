from tables import rows
from pyspark.sql import functions as F

from trendloom import dims, quality, reports


def test_dimensions(spark):
    geos = dims.geo_dim(spark)
    assert rows(geos.groupBy("kind").count()) == [("country", 125), ("us_state", 51)]
    assert geos.select("code").distinct().count() == 176
    assert dims.category_dim(spark).count() == 20
    assert geos.where("code = 'CI'").first()["name"] == "Côte d'Ivoire"
    options = dims.supported_options(spark).groupBy("option").count()
    assert rows(options) == [("category", 20), ("country", 125), ("gprop", 5), ("hours", 4), ("sort", 4), ("us_state", 51)]


def test_geo_check(spark):
    asked = spark.createDataFrame([("us",), ("US-CA",), ("zz",), ("1X",), ("",)], "geo STRING")
    got = {r["geo"]: r for r in quality.check_codes(asked, dims.geo_dim(spark)).collect()}
    assert (got["us"]["code"], got["us"]["name"], got["us"]["is_valid"], got["us"]["suggestions"]) == ("US", "United States", True, [])
    assert got["US-CA"]["name"] == "California"
    assert (got["zz"]["is_valid"], got["zz"]["suggestions"]) == (False, ["ZA", "ZM", "ZW"])
    assert got["1X"]["suggestions"] == [] and got[""]["suggestions"] == []
    many = quality.check_codes(spark.createDataFrame([("UX",)], "geo STRING"), dims.geo_dim(spark)).first()
    assert many["suggestions"] == ["UG", "UA", "US", "UY", "UZ"]


def test_category_check(spark):
    asked = spark.createDataFrame([("Sports",), ("spo",), ("sp",), ("travels",)], "category STRING")
    got = {r["category"]: (r["is_valid"], r["suggestions"]) for r in quality.check_categories(asked, dims.category_dim(spark)).collect()}
    assert got == {"Sports": (True, []), "spo": (False, ["sports"]), "sp": (False, []), "travels": (False, ["travel"])}
    hours = spark.createDataFrame([(4,), (24,), (48,), (168,), (5,), (None,)], "h INT")
    assert rows(hours.where(quality.hours_ok(F.col("h")))) == [(168,), (24,), (4,), (48,)]


def test_comparison_check(spark):
    asked = [
        (1, ["bitcoin", " ethereum "], "web", 60.0), (2, ["one"], "", None), (3, list("abcdef"), "", None),
        (4, ["a", "  "], "", None), (5, ["a", None], "", None), (6, ["a,b", "c"], "", None), (7, ["A", " a"], "", None),
        (8, ["a", "b"], "maps", None), (9, ["a", "b"], None, None), (10, ["a", "b"], "news", 0.0),
    ]
    made = spark.createDataFrame(asked, "id INT, keywords ARRAY<STRING>, gprop STRING, ttl_seconds DOUBLE")
    got = {r["id"]: r for r in quality.check_comparisons(made).collect()}
    assert (got[1]["terms"], got[1]["gprop"], got[1]["is_valid"]) == (["bitcoin", "ethereum"], "", True)
    assert [got[i]["reason"] for i in range(2, 11)] == [
        "needs 2 to 5 keywords", "needs 2 to 5 keywords", "empty keyword", "empty keyword", "comma in keyword",
        "duplicate keyword", "unknown property", "unknown property", "ttl must be positive",
    ]


def test_feed_quality_and_reports(spark):
    shape = (
        "geo STRING, fetched_at TIMESTAMP, rank INT, trend STRING, traffic STRING, traffic_min BIGINT, published TIMESTAMP,"
        " image STRUCT<url: STRING, source: STRING>, news_articles ARRAY<STRUCT<headline: STRING, url: STRING, source: STRING>>"
    )
    when = None
    news = lambda *pairs: [(h, "u", s) for h, s in pairs]
    made = spark.createDataFrame(
        [
            ("US", when, 1, "a", "500+", 500, None, ("p", "s"), news(("BREAKING now", "CNN"), ("x", "CNN"), ("y", "Blog"))),
            ("US", when, 2, "b", "200+", 200, None, (None, None), news(("an Update", "Blog"))),
            ("US", when, 3, "c", "N/A", 0, None, None, []),
            ("US", when, 4, "d", "10+", 10, None, ("", ""), news(("p", "x"), ("q", "x"), ("r", "x"), ("breaking", "BBC"))),
        ],
        shape,
    )
    found = quality.feed_quality(made.withColumn("published", F.lit("2026-01-01").cast("timestamp"))).first()
    assert (found["row_count"], found["volumes_ok"], found["dates_ok"], found["passes"]) == (4, 3, 4, False)
    got = {r["trend"]: r for r in reports.story_report(made).collect()}
    assert [got[t]["traffic_band"] for t in "abcd"] == ["high", "moderate", None, "low"]
    assert [got[t]["is_verified"] for t in "abcd"] == [True, False, None, True]
    assert [got[t]["story_angle"] for t in "abcd"] == ["breaking", "developing", None, "feature"]
    assert [got[t]["has_image"] for t in "abcd"] == [True, False, False, False]
    assert got["a"]["source_count"] == 2 and got["a"]["confirmed_by"] == "CNN"
    assert reports.story_report(made, top=3).count() == 3
    assert tuple(reports.coverage(made).first()) == (2.0, 4, 2)
    assert rows(reports.traffic_distribution(made)) == [("10+", 1), ("200+", 1), ("500+", 1), ("N/A", 1)]
    assert [(r["trend"], r["top_article_headline"]) for r in reports.high_traffic(made).collect()] == [("a", "BREAKING now"), ("b", "an Update")]
