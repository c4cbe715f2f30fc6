import random
from datetime import datetime, timedelta

from tables import rows
from pyspark.sql import functions as F

from trendloom import reuse

NOW = datetime(2026, 8, 10, 12)
ANSWER = (
    "answer_id STRING, kind STRING, keywords_lc ARRAY<STRING>, geo STRING, timeframe STRING, category INT,"
    " gprop STRING, has_related BOOLEAN, has_geo BOOLEAN, stored_at TIMESTAMP"
)
REQUEST = (
    "request_id STRING, kind STRING, keywords ARRAY<STRING>, geo STRING, timeframe STRING, category INT,"
    " gprop STRING, want_related BOOLEAN, want_geo BOOLEAN, asked_at TIMESTAMP, ttl_seconds DOUBLE"
)


def answer(name, ago, related=False, geo=False, keywords=("kayak",), timeframe="today 12-m", kind="explore"):
    return (name, kind, list(keywords), "US", timeframe, 0, "", related, geo, NOW - timedelta(seconds=ago))


def request(name="r", related=False, geo=False, ttl=None, keywords=("Kayak",), timeframe="today 12-m", kind="explore"):
    return (name, kind, list(keywords), "US", timeframe, 0, "", related, geo, NOW, ttl)


def served(spark, answers, *requests):
    found = reuse.match_answers(spark.createDataFrame(list(requests), REQUEST), spark.createDataFrame(answers, ANSWER))
    return {r["request_id"]: r for r in found.collect()}


def one(spark, answers, *args, **kw):
    return served(spark, answers, request(*args, **kw))["r"]["answer_id"]


def test_age(spark):
    assert one(spark, [answer("a", 86400)]) == "a"  # the limit itself still counts
    assert one(spark, [answer("a", 86401)]) is None
    assert one(spark, [answer("a", 3601, timeframe=" Now 7-d")], timeframe=" Now 7-d") is None
    assert one(spark, [answer("a", 90000)], ttl=100000.0) == "a"
    assert one(spark, [answer("a", 0)], ttl=0.5) == "a"
    assert one(spark, [answer("a", -1)]) is None  # stored after the request
    assert one(spark, [answer("a", 50), answer("b", 20), answer("c", 90)]) == "b"


def test_larger_answers_serve_smaller_questions(spark):
    full, rel, reg, plain = answer("full", 9, True, True), answer("rel", 8, True), answer("reg", 7, False, True), answer("plain", 99)
    assert one(spark, [full, rel, reg, plain]) == "plain"
    assert one(spark, [full, rel, reg]) == "full"
    assert one(spark, [rel, reg]) == "rel" and one(spark, [reg]) == "reg"
    assert one(spark, [rel, plain], geo=True) is None
    assert one(spark, [full, rel], related=True) == "rel"
    hit = served(spark, [full], request(related=True))["r"]
    assert (hit["is_exact"], hit["drops_related"], hit["drops_geo"]) == (False, False, True)
    # a stale exact answer does not hide a fresh larger one
    assert one(spark, [answer("plain", 90000), full]) == "full"


def test_keys(spark):
    stored = [answer("ab", 5, keywords=["a", "b"], kind="comparison")]
    ask = lambda *k: one(spark, stored, keywords=k, kind="comparison")
    assert ask("A", "B") == "ab" and ask("b", "a") is None and ask("a") is None
    assert one(spark, [answer("x", 5, keywords=["école"])], keywords=["ÉCOLE"]) == "x"


def test_equals_brute_force(spark):
    rng = random.Random(5)
    key = lambda: {"keywords": [rng.choice("ab")], "related": rng.random() < 0.5, "geo": rng.random() < 0.5}
    answers = [answer(f"a{i:03d}", rng.randint(0, 400_000), **key()) for i in range(150)]
    asked = []
    for i in range(120):
        base = request(f"r{i}", ttl=rng.choice([None, 600.0, 200_000.0]), **key())
        asked.append((*base[:9], NOW - timedelta(seconds=rng.randint(0, 300_000)), base[10]))
    got = served(spark, answers, *asked)
    for r in asked:
        oldest = r[9] - timedelta(seconds=r[10] or 86400)
        fit = [a for a in answers if a[2] == r[2] and oldest <= a[9] <= r[9]]
        best = None
        for widgets in ((r[7], r[8]), (True, True), (True, False), (False, True)):
            if (r[7] and not widgets[0]) or (r[8] and not widgets[1]):
                continue
            pick = [a for a in fit if (a[7], a[8]) == widgets]
            if pick:
                best = max(pick, key=lambda a: (a[9], a[0]))[0]
                break
        assert got[r[0]]["answer_id"] == best


def test_stats(spark):
    answers = spark.createDataFrame([answer("a", 5)], ANSWER)
    asked = spark.createDataFrame([request("1"), request("2"), request("3", related=True)], REQUEST)
    assert tuple(reuse.reuse_stats(reuse.match_answers(asked, answers), answers).first()) == (2, 1, 1, 66.7)
    none = reuse.match_answers(asked.limit(0), answers)
    assert reuse.reuse_stats(none, answers).first()["hit_rate"] == 0.0


def test_retention_is_thirty_days_and_one_per_key(spark):
    day = 86400
    answers = spark.createDataFrame(
        [answer("old", 30 * day + 1), answer("edge", 30 * day, True), answer("a", 50), answer("b", 20), answer("c", 20, False, True)], ANSWER
    )
    kept = reuse.compact_answers(answers, F.lit(NOW))
    assert rows(kept.select("answer_id")) == [("b",), ("c",), ("edge",)] and kept.columns == answers.columns


def test_every_request_comes_back(spark):
    made = [answer("w", 5, geo=True), answer("c", 5, geo=True, kind="comparison", keywords=("a", "b"))]
    nowhere = (*request("nogeo")[:3], None, *request()[4:])
    never = (*request("nevertime")[:9], None, None)
    got = served(spark, made, request("plain"), request("pair", kind="comparison", keywords=("A", "B")),
                 request("same", kind="comparison", keywords=("a", "b"), geo=True), request("turned", kind="comparison", keywords=("b", "a"), geo=True),
                 nowhere, never)
    assert {k: v["answer_id"] for k, v in got.items()} == {
        "plain": "w", "pair": None, "same": "c", "turned": None, "nogeo": None, "nevertime": None,
    }
