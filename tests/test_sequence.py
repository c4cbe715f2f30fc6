import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trendloom.operators.sequence import cut_in_ranges, last_known, neighbours

START = datetime(2026, 1, 1)


def walk(seed, n, keys="ab"):
    """Times with long gaps and dense runs; key 'a' gets most of the rows."""
    rng = random.Random(seed)
    at, out = START, []
    for i in range(n):
        at += timedelta(minutes=rng.choice([0, 1, 5, 70, 60 * 40]))
        out.append((rng.choice(keys + "aaa"), at, i, rng.choice([None, None, rng.randint(0, 9)])))
    return out


@pytest.mark.parametrize("bucket", ["minute", "hour", "day", "year", None])
def test_neighbours_equal_brute_force(spark, bucket):
    times = sorted({(k, t): v for k, t, _, v in walk(3, 300)}.items())
    made = spark.createDataFrame([(k, t, v) for (k, t), v in times], "k STRING, t TIMESTAMP, v INT")
    got = neighbours(made, ["k"], "t", bucket, carry=["v"]).collect()
    want = []
    for key in "ab":
        own = [(t, v) for (k, t), v in times if k == key]
        for i, (t, v) in enumerate(own):
            before = own[i - 1] if i else (None, None)
            after = own[i + 1][0] if i + 1 < len(own) else None
            want.append((key, t, v, before[0], after, own[0][0], before[1]))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("bucket", ["minute", "hour", "day", "year", None])
def test_last_known_equals_brute_force(spark, bucket):
    data = walk(11, 400)
    df = spark.createDataFrame(data, "k STRING, t TIMESTAMP, i INT, v INT")
    found = last_known(df, ["k"], [F.col("t"), F.col("i")], "t", {"seen": F.col("v"), "odd": F.when(F.col("v") % 2 == 1, F.col("v"))}, bucket)
    want, state = {}, {}
    for k, _, i, v in data:
        if v is not None:
            state[k, "seen"] = v
            if v % 2 == 1:
                state[k, "odd"] = v
        want[i] = (state.get((k, "seen")), state.get((k, "odd")))
    assert {r["i"]: (r["seen"], r["odd"]) for r in found.collect()} == want


def test_null_keys_and_times_stay(spark):
    rows = [(None, START, 1), (None, START + timedelta(days=3), 2), ("a", None, 3), ("a", START, 4)]
    got = neighbours(spark.createDataFrame(rows, "k STRING, t TIMESTAMP, v INT"), ["k"], "t", carry=["v"]).collect()
    assert {(r["v"], r["prev_at"], r["first_at"]) for r in got} == {
        (1, None, START), (2, START, START), (3, None, START), (4, None, START),
    }


@pytest.fixture
def ranges_stay(spark):
    """Small tables are not merged into one range."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def test_one_key_in_one_hour_is_cut(spark, ranges_stay):
    """All rows of a table have one key and one hour: ranges are even, results as in one piece."""
    at = F.timestamp_micros(F.lit(1_767_225_600_000_000) + F.col("id") * 89_000)
    made = spark.range(40_000).select(F.lit("k").alias("k"), at.alias("t"), F.col("id").cast("int").alias("v"))
    sizes = [r["count"] for r in cut_in_ranges(made, ["k"], [F.col("t")]).groupBy("_bucket").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 1.5 * min(sizes)
    got = neighbours(made, ["k"], "t", None, carry=["v"])
    wrong = got.where(
        ~F.col("prev_v").eqNullSafe(F.when(F.col("v") > 0, F.col("v") - 1))
        | ~F.col("next_at").eqNullSafe(F.when(F.col("v") < 39_999, F.timestamp_micros(F.unix_micros("t") + 89_000)))
    )
    assert got.count() == 40_000 and wrong.count() == 0
    rare = {"seen": F.when(F.col("v") % 13_000 == 0, F.col("v"))}
    seen = last_known(made, ["k"], [F.col("t"), F.col("v")], "t", rare, None)
    assert seen.where(F.col("seen") != F.floor(F.col("v") / 13_000) * 13_000).count() == 0


def test_equal_times_share_a_range(spark, ranges_stay):
    made = spark.range(1000).select(F.lit("k").alias("k"), F.lit(START).alias("t"), F.col("id").alias("v"))
    assert cut_in_ranges(made, ["k"], [F.col("t")]).select("_bucket").distinct().count() == 1
    assert cut_in_ranges(made.limit(0), ["k"], [F.col("t")]).count() == 0
    seen = last_known(made, ["k"], [F.col("t"), F.col("v")], "t", {"seen": F.when(F.col("v") % 400 == 0, F.col("v"))}, None)
    assert seen.where(F.col("seen") != F.floor(F.col("v") / 400) * 400).count() == 0
