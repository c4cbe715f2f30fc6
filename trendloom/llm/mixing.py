"""Mixing sources to target weights: capped water-filling and seeded repetitions.

Sources share ``share`` of all words by weight.  No source may be repeated more than
``max_epochs`` times: it is clamped there and what it cannot take is shared again
by weight among the others, until no source is above its cap.

Every document of a source is taken ``floor(target / size)`` times, and once more
if its seeded hash lies below the source's cut.  The cut is the hash at which the
remaining words are reached, so each source ends within one document of its target.
The cut is found in two steps (sums per hash bucket, then order within the one
bucket that holds it), so a source with a third of all rows is no single task.

Defined results: a null source is a source, ordered last; null and empty texts have
size 0 and take 0 words; rows that agree in ``doc_id`` and text share their hash and are
taken alike, others with one id (or none) are not; with no words at all every target is 0.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 1024


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _content(text: str = "text") -> Column:
    """What tells rows without id, or with one id, apart."""
    return F.xxhash64(F.col(text).cast("string"))


def _hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "doc_id", "content")


def cycled_weights(sizes: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``source, source_size, weight``: weights repeat in code point order, the null source last."""
    spark = sizes.sparkSession
    parts = materialize(
        spark,
        sizes.repartitionByRange(F.col("source").asc_nulls_last())
        .sortWithinPartitions(F.col("source").asc_nulls_last())
        .withColumn("at", F.monotonically_increasing_id()),
        "sources",
    )
    # Partition numbers are the high bits of the generated ids; each starts at 0.
    part = F.shiftright("at", 33)
    counts = parts.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    place = F.pmod(F.coalesce("before", F.lit(0)) + F.col("at").bitwiseAND((1 << 33) - 1), F.lit(len(cycle)))
    return parts.join(before, part == F.col("part")).select(
        "source", "source_size", F.element_at(F.array(*map(F.lit, cycle)), (place + 1).cast("int")).cast("double").alias("weight")
    )


def fill(sources: DataFrame, share: float = 1.0, max_epochs: float = 3.0) -> DataFrame:
    """Adds ``target``: ``min(max_epochs * size, level * weight)`` with the level that uses up the share.

    The level is found by clamping and sharing again; each round is one aggregation
    that brings one row to the driver.
    """
    cap = max_epochs * F.col("source_size")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while total:
        free = cap > level * F.col("weight")
        clamped, weight = sources.agg(F.sum(F.when(~free, cap)), F.sum(F.when(free, F.col("weight")))).first()
        if not weight:
            break
        raised = (share * total - (clamped or 0.0)) / weight
        if raised <= level * (1 + 1e-12):
            break
        level = raised
    return sources.withColumn("target", F.least(cap.cast("double"), F.lit(level) * F.col("weight")))


def plan(sized: DataFrame, share: float = 1.0, max_epochs: float = 3.0, seed: int = 17) -> DataFrame:
    """One row per source: ``source, source_size, target, whole, cut``; sized has ``doc_id, source, size, content``."""
    spark = sized.sparkSession
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ratio = F.col("target") / F.col("source_size")
    targets = materialize(
        spark,
        fill(materialize(spark, cycled_weights(sizes), "weights"), share, max_epochs)
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(ratio + 1e-12)).otherwise(F.lit(0)).cast("long"))
        .withColumn("rest", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0))),
        "targets",
    )
    h = _hash(seed)
    hashed = sized.select("source", "size", h.alias("h"), F.floor(h / (2.0**64 / BUCKETS)).alias("bucket"))
    buckets = hashed.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("bucket")
    edge = (
        buckets.withColumn("upto", F.sum("words").over(before)).alias("b")
        .join(targets.select("source", "rest").alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
        .filter((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("words") <= F.col("rest")))
        .select(F.col("b.source").alias("e_source"), F.col("bucket").alias("e_bucket"),
                (F.col("rest") - F.col("upto") + F.col("words")).alias("room"))
    )
    # Within the bucket at the edge, documents go in while half of each still fits.
    inner = Window.partitionBy("source", "bucket").orderBy("h").rangeBetween(Window.unboundedPreceding, 0)
    cuts = (
        hashed.join(edge, F.col("source").eqNullSafe(F.col("e_source")) & (F.col("bucket") == F.col("e_bucket")))
        .withColumn("run", F.sum("size").over(inner))
        .groupBy(F.col("source").alias("c_source"), F.col("bucket").alias("c_bucket"))
        .agg(F.max(F.when(F.col("run") - F.col("size") / 2 <= F.col("room"), F.col("h"))).alias("cut"))
    )
    start = (F.col("c_bucket") * (2.0**64 / BUCKETS)).cast("long") - 1
    return materialize(
        spark,
        targets.join(cuts, F.col("source").eqNullSafe(F.col("c_source")), "left").select(
            "source", "source_size", "target", "whole",
            F.when(F.col("c_bucket").isNull() | (F.col("rest") <= 0), F.lit(-(2**63)))
            .otherwise(F.coalesce("cut", start)).alias("cut"),
        ),
        "mix",
    )


def _copies(seed: int) -> Column:
    return F.col("whole") + (_hash(seed) <= F.col("cut")).cast("long")


def mix(docs: DataFrame, share: float = 1.0, max_epochs: float = 3.0, seed: int = 17) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken``."""
    sized = materialize(
        docs.sparkSession,
        docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), n_words().alias("size"), _content().alias("content")),
        "sizes",
    )
    p = plan(sized, share, max_epochs, seed).withColumnRenamed("source", "p_source")
    return sized.join(p, F.col("source").eqNullSafe(F.col("p_source"))).select(
        "doc_id", "source", "size", "source_size", "target", _copies(seed).alias("copies"),
        (_copies(seed) * F.col("size")).alias("taken"),
    )


def sample(docs: DataFrame, share: float = 1.0, max_epochs: float = 3.0, seed: int = 17) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its columns.

    Documents stay where they are read: only the plan of one row per source is joined,
    and Spark broadcasts it if its size allows.
    """
    sized = docs.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string"), n_words().alias("size"), _content().alias("content")
    )
    p = plan(materialize(docs.sparkSession, sized, "sizes"), share, max_epochs, seed)
    p = p.select(F.col("source").alias("_p_source"), F.col("whole").alias("_p_whole"), F.col("cut").alias("_p_cut"))
    copies = F.col("_p_whole") + (F.xxhash64(F.lit(seed), docs["doc_id"].cast("long"), _content()) <= F.col("_p_cut")).cast("long")
    return (
        docs.join(p, docs["source"].cast("string").eqNullSafe(F.col("_p_source")))
        .withColumn("_p_copy", F.explode(F.sequence(F.lit(1), F.greatest(copies, F.lit(1)))))
        .filter(F.col("_p_copy") <= copies)
        .select(*[docs[f"`{c}`"] for c in docs.columns])
    )
