"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable, for every node of ``edges (a, b)``.

    Rounds of large-star and small-star: every node tells its neighbours the smallest
    node it knows, until nothing changes; long chains halve with each round.
    Each round is written to the shared folder, so lost executors re-read it.
    """
    spark = edges.sparkSession
    pairs = materialize(spark, edges.select("a", "b").filter("a <> b").distinct(), "edges")
    before = None
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("n"), F.least("a", "low").alias("low"))
        large = both.filter("b > a").join(low, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        down = large.filter("a <> b").distinct()
        least = down.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("n"), "low")
        small = down.join(least, F.col("a") == F.col("n")).select("b", "low", "a")
        star = small.select(F.col("b").alias("a"), F.col("low").alias("b")).union(small.select("a", F.col("low").alias("b")))
        pairs = materialize(spark, star.filter("a <> b").distinct(), "edges")
        state = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            break
        before = state
    named = pairs.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return named.union(pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
