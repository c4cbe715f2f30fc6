"""Related queries of requested keywords, from baskets of co-used keywords."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.payloads import LINK_ORIGIN

BREAKOUT = "Breakout"

#: Keywords of one basket, and seeds of one basket, that meet in one task.
PART = 10_000


def cells(used: DataFrame, seeded: DataFrame, part: int = PART) -> tuple[DataFrame, DataFrame]:
    """``used`` and ``seeded`` with the cells of their basket in which they meet.

    A basket of n keywords and m seeds is a grid of ceil(n / part) lines and
    ceil(m / part) columns: a keyword goes to all cells of its line, a seed to
    all of its column, so each pair meets once.  Nearly all baskets are one cell;
    only the larger ones are listed with their sizes.
    """
    heavy = used.groupBy("basket").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > part)
    sizes = heavy.join(seeded.groupBy("basket").agg(F.count(F.lit(1)).alias("_m")), "basket").select(
        "basket", *[F.ceil(F.col(n) / part).cast("int").alias(n) for n in ("_n", "_m")]
    )

    def placed(rows: DataFrame, word: str, own: str, other: str) -> DataFrame:
        one = F.lit(1)
        line = F.pmod(F.xxhash64(word), F.coalesce(F.col(own), one)).cast("int")
        every = F.sequence(F.lit(0), F.coalesce(F.col(other), one) - 1)
        marked = rows.join(sizes, "basket", "left").withColumns({own: line, other: every})
        return marked.withColumn(other, F.explode(other))

    return placed(used, "keyword", "_n", "_m"), placed(seeded, "seed", "_m", "_n")


def related_queries(
    uses: DataFrame,
    seeds: Sequence[str] | DataFrame,
    recent_from,
    previous_from,
    limit: int = 25,
    part: int = PART,
) -> DataFrame:
    """Top and rising companions of each seed in ``uses(basket, keyword, ts)``.

    *top*: share of the seed's strongest companion in percent.  *rising*: growth
    from ``[previous_from, recent_from)`` to the time from ``recent_from`` on;
    a companion without earlier use is a ``Breakout`` with value 0 and comes
    first.  ``limit`` is the length of the two lists.

    ``seeds`` are keywords, or a table with them in its first column.  Only
    baskets with a seed are looked at: they are picked before anything is
    counted, and a basket row is repeated once per seed in its basket.  A basket
    of more than ``part`` keywords is counted in parts, see :func:`cells`.
    """
    if isinstance(seeds, DataFrame):
        wanted = uses.join(seeds.select(F.col(seeds.columns[0]).alias("_seed")).distinct(), F.col("keyword") == F.col("_seed"), "left_semi")
    elif not seeds:
        raise ValueError("pass at least one seed")
    else:
        wanted = uses.where(F.col("keyword").isin(list(seeds)))
    recent = F.col("ts") >= recent_from
    before = (F.col("ts") >= previous_from) & ~recent
    seeded = wanted.select("basket", F.col("keyword").alias("seed")).distinct()
    near = uses.join(seeded.select(F.col("basket").alias("_near")).distinct(), F.col("basket") == F.col("_near"), "left_semi")
    # one row per basket and keyword, whatever the number of repeats
    used = near.groupBy("basket", "keyword").agg(
        F.bool_or(recent).alias("is_recent"), F.bool_or(before).alias("was_before")
    )
    left, right = cells(used, seeded, part)
    companions = (
        left.join(right, ["basket", "_n", "_m"])
        .where(F.col("keyword") != F.col("seed"))
        .groupBy("seed", F.col("keyword").alias("query"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if("is_recent").alias("now"),
            F.count_if("was_before").alias("prior"),
        )
    )
    # Candidates of both lists in one pass.  The top list is ordered by count, so
    # its first row is the peak: the limit reaches below the window's shuffle and
    # the peak is read off what is left.
    growth = F.round((F.col("now") - F.col("prior")) * 100.0 / F.nullif(F.col("prior"), F.lit(0))).cast("bigint")
    none = F.lit(0).cast("bigint")
    top = F.struct(
        F.lit("top").alias("bucket"), F.lit(0).alias("breakout"), F.col("n").alias("score"), F.col("n").alias("weight")
    )
    rising = F.struct(
        F.lit("rising").alias("bucket"), (F.col("prior") == 0).cast("int").alias("breakout"),
        F.coalesce(growth, none).alias("score"), F.col("now").alias("weight"),
    )
    lists = F.filter(F.array(top, rising), lambda e: (e["bucket"] == "top") | (F.col("now") > F.col("prior")))
    order = Window.partitionBy("seed", "bucket").orderBy(F.desc("breakout"), F.desc("score"), F.desc("weight"), "query")
    ranked = (
        companions.select("seed", "query", F.inline(lists))
        .withColumn("pos", F.row_number().over(order))
        .where(F.col("pos") <= limit)
    )
    share = F.round(F.col("score") * 100.0 / F.first("score").over(order))
    value = F.when(F.col("bucket") == "top", share).otherwise(F.col("score")).cast("int")
    text = (
        F.when(F.col("breakout") == 1, F.lit(BREAKOUT))
        .when(F.col("bucket") == "rising", F.concat(F.lit("+"), F.format_number("value", 0), F.lit("%")))
        .otherwise(F.col("value").cast("string"))
    )
    return ranked.withColumn("value", value).select(
        F.col("seed").alias("keyword"),
        "bucket",
        "pos",
        "query",
        "value",
        text.alias("formatted_value"),
        F.concat(F.lit(LINK_ORIGIN + "/trends/explore?q="), F.col("query")).alias("link"),
    )
