from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from tables import rows

from trendloom import interest, ranking, related

DAY = datetime(2026, 8, 1)


@pytest.fixture(scope="module")
def counts(spark):
    uses = {"a": [0] * 4 + [2] * 2, "b": [1], "c": [2] * 8}
    made = [(k, DAY + timedelta(days=d, hours=5)) for k, days in uses.items() for d in days]
    return interest.bucket_counts(spark.createDataFrame(made, "keyword STRING, ts TIMESTAMP"))


def values(df):
    got = {}
    for r in df.orderBy("ts").collect():
        got.setdefault(r["keyword"], []).append(r["value"])
    return got


def test_own_scale_fills_gaps(counts):
    assert values(interest.interest_over_time(counts)) == {"a": [100, 0, 50], "b": [0, 100, 0], "c": [0, 0, 100]}
    last = counts.where("is_partial").select("ts").distinct().collect()
    assert [r["ts"] for r in last] == [DAY + timedelta(days=2)]


def test_shared_scale(counts):
    series = interest.compare_keywords(counts, ["a", "c"])
    assert values(series) == {"a": [50, 0, 25], "c": [0, 0, 100]}
    got = interest.winners(interest.averages(series)).orderBy("place").collect()
    assert [(r["keyword"], r["average"]) for r in got] == [("c", 33), ("a", 25)]
    table = interest.comparison_table(series, ["c", "a"])
    assert table.columns == ["date", "c", "a", "is_partial"]
    assert [(r["c"], r["a"]) for r in table.collect()] == [(0, 50), (0, 0), (100, 25)]
    for bad in (["a"], list("abcdef")):
        with pytest.raises(ValueError):
            interest.compare_keywords(counts, bad)


def test_series_views(counts):
    series = interest.interest_over_time(counts)
    assert [r["value"] for r in interest.series_table(series, "a").collect()] == [100, 0, 50]
    peak = interest.peaks(series).where("keyword = 'a'").first()
    assert (peak["peak_at"], peak["peak_value"], peak["point_count"], peak["is_empty"]) == (DAY, 100, 3, False)
    assert sorted(r["value"] for r in interest.latest_points(series, 2).where("keyword = 'a'").collect()) == [0, 50]


def test_regions(spark):
    events = spark.createDataFrame([("a", 1)] * 4 + [("b", 1)] * 4 + [("a", 2)] * 2 + [("b", 3)], "keyword STRING, user INT")
    users = spark.createDataFrame([(1, "X", "Ex"), (2, "Y", "Why"), (3, "Y", "Why")], "user INT, geo_code STRING, geo_name STRING")
    found = interest.region_counts(events, users)
    got = interest.strongest_first(interest.interest_by_region(found)).collect()
    assert [(r["keyword"], r["geo_code"], r["value"]) for r in got] == [("a", "X", 100), ("a", "Y", 50), ("b", "X", 100), ("b", "Y", 25)]
    for order in (["a", "b"], ["b", "a"]):
        wins = {r["geo_code"]: r for r in interest.compare_regions(found, order).collect()}
        assert wins["X"]["top_keyword"] == order[0] and wins["Y"]["top_keyword"] == "a"
        assert wins["Y"]["values"] == {"a": 50, "b": 25}


def test_ranked_snapshots(spark):
    made = [("US", DAY, k) for k in "aaabbccd"] + [("US", DAY + timedelta(days=40), "z")]
    got = ranking.ranked_snapshots(spark.createDataFrame(made, "geo STRING, ts TIMESTAMP, keyword STRING"), "month", 3)
    assert rows(got.where("month(fetched_at) = 8").select("rank", "keyword", "volume_min", "volume_text")) == [
        (1, "a", 3, "3+"), (2, "b", 2, "2+"), (3, "c", 2, "2+"),
    ]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_related(spark):
    old, new = DAY - timedelta(days=500), DAY
    baskets = {1: (new, "kxy"), 2: (new, "kx"), 3: (new, "kx"), 4: (old, "kx"), 5: (old, "kz"), 6: (new, "xyz")}
    made = [(b, k, t) for b, (t, ks) in baskets.items() for k in ks * 2]
    uses = spark.createDataFrame(made, "basket INT, keyword STRING, ts TIMESTAMP")
    found = related.related_queries(uses, ["k"], DAY - timedelta(days=365), DAY - timedelta(days=730))
    got = [(r["bucket"], r["pos"], r["query"], r["value"], r["formatted_value"]) for r in found.orderBy("bucket", "pos").collect()]
    assert got == [
        ("rising", 1, "y", 0, "Breakout"), ("rising", 2, "x", 200, "+200%"),
        ("top", 1, "x", 100, "100"), ("top", 2, "y", 25, "25"), ("top", 3, "z", 25, "25"),
    ]
    table = uses.sparkSession.createDataFrame([(k,) for k in "kabcdefk"], "seed STRING")
    same = related.related_queries(uses, table, DAY - timedelta(days=365), DAY - timedelta(days=730))
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, found.collect()))
    with pytest.raises(ValueError):
        related.related_queries(uses, [], DAY, DAY)


def test_large_baskets_are_counted_in_parts(spark):
    """One basket with a third of all uses and half of the seeds: same rows in any number of parts, no large cell."""
    big = spark.range(3000).select(F.lit(-1).cast("long").alias("basket"), (F.col("id") % 900).alias("w"), F.col("id").alias("i"))
    small = spark.range(6000).select((F.col("id") % 500).alias("basket"), (F.col("id") * 7 % 1000).alias("w"), F.col("id").alias("i"))
    uses = big.union(small).select(
        "basket", F.concat(F.lit("w"), F.col("w").cast("string")).alias("keyword"),
        (F.lit(DAY) - F.make_dt_interval(days=(F.col("i") % 700).cast("int"))).alias("ts"),
    )
    seeds = spark.range(0, 1000, 10).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("seed"))
    bounds = DAY - timedelta(days=300), DAY - timedelta(days=600)
    whole = related.related_queries(uses, seeds, *bounds, part=10_000)
    assert rows(related.related_queries(uses, seeds, *bounds, part=20)) == rows(whole)
    used = uses.select("basket", "keyword").distinct()
    seeded = used.join(seeds, F.col("keyword") == F.col("seed"), "left_semi").select("basket", F.col("keyword").alias("seed"))
    left, right = related.cells(used, seeded, part=20)
    for side in (left, right):
        assert side.groupBy("basket", "_n", "_m").count().agg(F.max("count")).first()[0] < 60
    pairs = left.join(right, ["basket", "_n", "_m"]).groupBy("basket", "keyword", "seed").count()
    assert pairs.agg(F.max("count")).first()[0] == 1
    assert pairs.count() == used.join(seeded, "basket").count()


def test_many_comparisons_equal_single_ones(spark):
    """Thirty comparisons in one job, all of them with one keyword; no window over everything."""
    import random
    from datetime import datetime, timedelta

    draw = random.Random(9)
    words = [f"k{i}" for i in range(12)]
    data = [(draw.choice(words), datetime(2026, 1, 1) + timedelta(hours=draw.randrange(480)), f"u{draw.randrange(9)}") for _ in range(900)]
    events = spark.createDataFrame(data, "keyword string, ts timestamp, user string")
    users = spark.createDataFrame([(f"u{i}", f"g{i % 4}", f"G{i % 4}") for i in range(9)], "user string, geo_code string, geo_name string")
    asked = {i: ["k0", *draw.sample(words[1:], 1 + i % 4)] for i in range(30)}
    odd = [(100, ["k1", "k1"]), (101, words), (102, None), (None, ["k1", "k2"]), (103, ["k1", None, "k2", "never used"])]
    requests = spark.createDataFrame([*asked.items(), *odd], "comparison_id long, keywords array<string>")
    members = interest.comparison_members(requests)
    counts, regions = interest.bucket_counts(events), interest.region_counts(events, users)
    series = interest.compare_many(counts, members)
    got, places = {}, {}
    for r in series.collect():
        got.setdefault(r.comparison_id, set()).add((r.keyword, r.ts, r.value, r.is_partial))
    for r in interest.many_winners(series).collect():
        places.setdefault(r.comparison_id, set()).add((r.keyword, r.average, r.place))
    wins = {}
    for r in interest.many_region_winners(regions, members).collect():
        wins.setdefault(r.comparison_id, set()).add((r.geo_code, r.top_keyword, r.top_value))
    assert set(got) == {*asked, 103}
    for i in (0, 1, 2, 3, 17, 29):
        single = interest.compare_keywords(counts, asked[i])
        assert got[i] == {tuple(r) for r in single.collect()}
        assert places[i] == {tuple(r) for r in interest.winners(interest.averages(single)).collect()}
        one = interest.compare_regions(regions, asked[i])
        assert wins[i] == {(r.geo_code, r.top_keyword, r.top_value) for r in one.collect()}
    assert rows(interest.rejected_comparisons(requests)) == rows(
        spark.createDataFrame([(100, 1), (101, 12), (102, 0), (None, 2)], "comparison_id long, term_count int")
    )
    plan = interest.many_winners(series)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("[comparison_id#" in w or "[keyword#" in w for w in windows)


def test_region_winners_of_many_chunks_and_blocks(spark, monkeypatch):
    """Cells of every size find what one pass over all rows finds; nothing of the result's size is shuffled."""
    import random

    draw = random.Random(3)
    words = [f"k{i}" for i in range(9)]
    places = [(f"g{i}", f"G{i}") for i in range(23)] + [(None, None)]
    used = [(w, *p, draw.choice([1, 2, 3, 7, 200, 399])) for w in words for p in places if draw.random() < 0.8]
    counts = spark.createDataFrame(used, "keyword string, geo_code string, geo_name string, n long")
    asked = [(i, draw.sample([*words, "never used"], 2 + i % 4)) for i in range(60)]
    members = interest.comparison_members(spark.createDataFrame(asked, "comparison_id long, keywords array<string>"))
    want, n = set(), {(w, c): k for w, c, _, k in used}
    for i, terms in asked:
        peak = max(k for (w, _), k in n.items() if w in terms)
        for code, name in places:
            found = [(-((n[w, code] * 200 + peak) // (2 * peak)), pos, w) for pos, w in enumerate(terms) if (w, code) in n]
            if found:
                value, _, word = min(found)
                want.add((i, code, name, word, -value))
    for chunk, block in ((4000, 250), (7, 5), (1, 1)):
        monkeypatch.setattr(interest, "CHUNK", chunk)
        monkeypatch.setattr(interest, "BLOCK", block)
        got = interest.many_region_winners(counts, members)
        assert {tuple(r) for r in got.collect()} == want
        last = got._jdf.queryExecution().optimizedPlan().toString().splitlines()[0]
        assert "FlatMapCoGroupsInArrow" in last


def test_index_rounds_halves_up_without_decimals(spark):
    pairs = spark.range(1, 130).select(F.col("id").alias("peak"), F.explode(F.sequence(F.lit(0).cast("long"), "id")).alias("n"))
    pairs = pairs.union(spark.createDataFrame([(0, 0), (3, None), (None, 3)], "peak long, n long"))
    got = pairs.select("peak", "n", interest._index(F.col("n"), F.col("peak")).alias("v"))
    for peak, n, value in got.collect():
        want = 0 if not peak else None if n is None else (200 * n + peak) // (2 * peak)
        assert value == want, (peak, n)
    assert "round(" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_region_winners_shuffle_packed_chunks_and_blocks(spark, monkeypatch):
    """One row per comparison and block, or per count and chunk, is not shuffled: each cell gets one packed row of both."""
    words = [f"word {i}" for i in range(40)]
    counts = spark.createDataFrame([(w, f"g{p}", f"G{p}", 1 + (i * p) % 7) for i, w in enumerate(words) for p in range(30)], "keyword string, geo_code string, geo_name string, n long")
    members = spark.createDataFrame([(c, words[(c * k) % 40], k) for c in range(600) for k in (1, 2)], "comparison_id long, keyword string, pos int").filter("comparison_id % 40 <> 0")
    monkeypatch.setattr(interest, "CHUNK", 100)
    monkeypatch.setattr(interest, "BLOCK", 5)
    got = interest.many_region_winners(counts, members)
    sides = got._jdf.queryExecution().optimizedPlan().children()
    dealt = [sides.apply(i) for i in range(sides.size())]
    assert got.count() == 585 * 30
    assert all("FlatMapGroupsInArrow" in side.toString() and "binary" in side.schema().simpleString() for side in dealt)
