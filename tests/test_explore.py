import json
from datetime import datetime

import pytest
from tables import rows
from pyspark.sql import functions as F

from trendloom import answers, explore, quality

PREFIX = ")]}',\n"
SERIES = {"default": {"timelineData": [
    {"time": "1900000800", "value": [31], "hasData": [True]},
    {"time": "bad", "value": []},
    {"value": ["x"]},
    {"time": 1900087200, "value": [84], "isPartial": True},
]}}
REGIONS = {"default": {"geoMapData": [
    {"geoCode": "FI-18", "geoName": "Uusimaa", "value": [97], "hasData": [True]},
    {"geoCode": "FI-10", "geoName": "Lapland", "value": [41], "hasData": [True]},
    {"geoCode": "XX", "geoName": "None", "value": [0], "hasData": [False]},
    {"geoCode": "YY", "value": [1]},
]}}
RELATED = {"default": {"rankedList": [
    {"rankedKeyword": [{"query": "repair kit", "value": 72, "formattedValue": "72", "link": "/trends/explore?q=repair"}]},
    {"rankedKeyword": [
        {"query": "rental", "value": 1240, "formattedValue": "+1,240%", "link": "https://else.example/x"},
        {"query": "new route", "value": 0, "formattedValue": "Breakout"},
    ]},
]}}
WORDS = ["kayak", "canoe", "raft"]
COMPARED = {"default": {"averages": [52, 13], "timelineData": [
    {"time": "0", "value": [47, 12, 9]}, {"time": "60", "value": [93]}, {"time": "120", "value": [55, 14, 2], "isPartial": True},
]}}
COMPARED_REGIONS = {"default": {"geoMapData": [
    {"geoCode": "BY", "geoName": "Bavaria", "value": [61, 20, 3], "maxValueIndex": 0, "hasData": [True, True, True]},
    {"geoCode": "SN", "geoName": "Saxony", "value": [15, 33, 33], "maxValueIndex": 9, "hasData": [False, True, True]},
    {"geoCode": "HH", "geoName": "Hamburg", "value": [8], "hasData": [True]},
    {"geoCode": "XX", "geoName": "None", "value": [0, 0, 0], "hasData": [False, False, False]},
]}}


def dump(payload):
    return PREFIX + json.dumps(payload)


@pytest.fixture(scope="module")
def single(spark):
    empty = {"default": {"timelineData": [{"time": "0", "value": [0]}]}}
    made = [
        ("a1", "kayak", dump(SERIES), dump(RELATED), dump(REGIONS)),
        ("a2", "quiet", dump(empty), None, None),
        ("a3", "none", dump({}), dump({"default": {"rankedList": []}}), dump({"default": {}})),
    ]
    return _context(spark.createDataFrame(made, "answer_id STRING, keyword STRING, series_json STRING, related_json STRING, regions_json STRING"))


@pytest.fixture(scope="module")
def compared(spark):
    made = [("c1", WORDS, dump(COMPARED), dump(COMPARED_REGIONS))]
    return _context(spark.createDataFrame(made, "answer_id STRING, keywords ARRAY<STRING>, series_json STRING, regions_json STRING"))


def _context(df):
    return df.withColumns({
        "geo": F.lit("US"), "timeframe": F.lit("today 12-m"), "gprop": F.lit(""),
        "fetched_at": F.lit("2031-03-14").cast("timestamp"),
    })


def test_series(single):
    got = explore.read_interest(single).where("answer_id = 'a1'").orderBy("pos").collect()
    assert [(r["ts"], r["value"], r["is_partial"]) for r in got] == [
        (datetime(2030, 3, 17, 18), 31, False), (None, 0, False), (None, 0, False), (datetime(2030, 3, 18, 18), 84, True),
    ]
    assert explore.read_interest(single).where("answer_id = 'a3'").count() == 0


def test_regions(single):
    got = rows(explore.read_regions(single).select("geo_code", "geo_name", "value", "pos"))
    assert got == [("FI-10", "Lapland", 41, 2), ("FI-18", "Uusimaa", 97, 1)]


def test_related(single):
    got = rows(explore.read_related(single).drop("answer_id", "keyword"))
    assert got == [
        ("rising", 1, "rental", 1240, "+1,240%", "https://else.example/x"),
        ("rising", 2, "new route", 0, "Breakout", ""),
        ("top", 1, "repair kit", 72, "72", "https://trends.google.com/trends/explore?q=repair"),
    ]


def test_comparison(compared):
    got = explore.read_comparison(compared).orderBy("ts", "kw_pos").collect()
    assert [r["value"] for r in got] == [47, 12, 9, 93, 0, 0, 55, 14, 2]
    assert [r["keyword"] for r in got[:3]] == WORDS and [r["is_partial"] for r in got[-3:]] == [True] * 3
    assert rows(explore.read_averages(compared).select("keyword", "average")) == [("canoe", 13), ("kayak", 52), ("raft", 0)]


def test_comparison_regions(compared):
    got = explore.read_comparison_regions(compared)
    assert rows(got.select("geo_code", "top_keyword").distinct()) == [("BY", "kayak"), ("HH", "kayak"), ("SN", "canoe")]
    assert rows(got.where("geo_code = 'HH'").select("keyword", "value")) == [("canoe", 0), ("kayak", 8), ("raft", 0)]


def test_answers(single, compared):
    got = {r["answer_id"]: r for r in answers.explore_answers(single).collect()}
    assert (got["a1"]["count"], got["a1"]["is_empty"], len(got["a1"]["rising"])) == (4, False, 2)
    assert (got["a2"]["count"], got["a2"]["is_empty"], got["a2"]["interest_by_region"]) == (1, True, [])
    assert (got["a3"]["count"], got["a3"]["is_empty"]) == (0, True)
    assert json.loads(got["a1"]["payload_json"])["schema_version"] == "1.2"
    one = answers.comparison_answers(compared).first()
    assert (one["count"], one["schema_version"], [a["average"] for a in one["averages"]]) == (3, "1.1", [52, 13, 0])


def test_assembly_needs_no_shuffle(single, compared):
    for df in (answers.explore_answers(single), answers.comparison_answers(compared), explore.read_interest(single)):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_bad_payloads_are_listed(spark, single):
    bad = _context(spark.createDataFrame(
        [("b1", "k", "<html>", dump(RELATED), None), ("b2", "k", dump(SERIES), "{broken", None), ("b3", "k", "[1]", None, None)],
        "answer_id STRING, keyword STRING, series_json STRING, related_json STRING, regions_json STRING",
    ))
    got = rows(explore.rejected_payloads(single.unionByName(bad)).select("answer_id", F.array_join("bad_payloads", ",")))
    assert got == [("b1", "series_json"), ("b2", "related_json"), ("b3", "series_json")]
    assert explore.read_interest(bad).where("answer_id = 'b1'").count() == 0


def test_quality(single):
    got = {r["answer_id"]: r for r in quality.interest_quality(explore.read_interest(single), minimum=1).collect()}
    assert (got["a1"]["point_count"], got["a1"]["dates_ok"], got["a1"]["is_chronological"], got["a1"]["passes"]) == (4, 2, True, False)
    assert (got["a2"]["is_chronological"], got["a2"]["passes"]) == (False, False)
    assert quality.related_quality(explore.read_related(single)).first()["passes"]
