"""Keyword interest on a 0-100 scale, computed from keyword events.

Everything starts from counts per (keyword, bucket): those combine before the
shuffle, and what follows is as small as keywords x buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

#: Comparisons and regions that one group of :func:`many_region_winners` holds at about, and regions it looks at in one go.
CHUNK, BLOCK, PART = 8000, 400, 25


def _index(n: Column, peak: Column) -> Column:
    """Share of the peak in percent; a zero peak gives 0."""
    share = n * F.lit(100.0) / peak
    whole = F.floor(share)  # halves go up; ``round`` would make a decimal of every row
    rounded = whole + F.when(share - whole >= 0.5, 1).otherwise(0)
    return F.when(peak > 0, rounded).otherwise(0).cast("int")


def _group_peak() -> Column:
    """Largest count of a comparison.

    The window is not partitioned: a comparison has five keywords at most, so
    it sees five rows per bucket or region, all counted before.  A second
    aggregation for the peak would read the events again.
    """
    return F.max("n").over(Window.partitionBy())


def bucket_counts(events: DataFrame, bucket: str = "day", start=None, end=None, as_of=None) -> DataFrame:
    """Counts of ``events(keyword, ts)`` per keyword and bucket, gaps filled with 0.

    All keywords share one time span: ``start`` to ``end`` as given (columns),
    else that of the data, which costs one more scan of ``ts`` alone.  A bucket
    is partial when it ends after ``as_of``, by default the newest event.

    A row fills the gap up to the next row of its keyword, so the zeros need
    neither a grid nor a join; the window sees one row per bucket with events.
    """
    if start is not None:
        events = events.where(F.col("ts") >= start)
    if end is not None:
        events = events.where(F.col("ts") <= end)
    newest = events.agg(F.struct(F.min("ts").alias("lo"), F.max("ts").alias("hi")).alias("span")).scalar()
    lo = F.date_trunc(bucket, newest["lo"] if start is None else start)
    hi = F.date_trunc(bucket, newest["hi"] if end is None else end)
    as_of = newest["hi"] if as_of is None else as_of
    step = F.expr(f"INTERVAL 1 {bucket}")

    counts = events.groupBy("keyword", F.date_trunc(bucket, "ts").alias("at")).agg(F.count(F.lit(1)).alias("count"))
    order = Window.partitionBy("keyword").orderBy("at")
    placed = counts.select(
        "keyword",
        "at",
        "count",
        F.when(F.lag("at").over(order).isNull(), lo).otherwise(F.col("at")).alias("first"),
        F.coalesce(F.lead("at").over(order) - step, hi).alias("last"),
    )
    return placed.select(
        "keyword", "at", "count", F.explode(F.sequence("first", "last", step)).alias("ts")
    ).select(
        "keyword",
        "ts",
        F.when(F.col("ts") == F.col("at"), F.col("count")).otherwise(F.lit(0).cast("bigint")).alias("n"),
        (F.col("ts") + step > as_of).alias("is_partial"),
    )


def interest_over_time(counts: DataFrame) -> DataFrame:
    """Each keyword against its own peak."""
    peak = F.max("n").over(Window.partitionBy("keyword"))
    return counts.select("keyword", "ts", _index(F.col("n"), peak).alias("value"), "is_partial")


def compare_keywords(counts: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """2 to 5 keywords against the one peak of the whole group."""
    if not 2 <= len(keywords) <= 5:
        raise ValueError(f"compare 2 to 5 keywords, got {len(keywords)}")
    picked = counts.where(F.col("keyword").isin(list(keywords)))
    return picked.select("keyword", "ts", _index(F.col("n"), _group_peak()).alias("value"), "is_partial")


def comparison_members(requests: DataFrame) -> DataFrame:
    """``comparison_id, keyword, pos``: the distinct keywords of ``requests (comparison_id, keywords)``, 2 to 5 each.

    Requests with fewer or more are left out here and listed by :func:`rejected_comparisons`.
    """
    named = _named_keywords(requests)
    return named.filter(_comparable()).select("comparison_id", F.posexplode("terms").alias("pos", "keyword")).select(
        "comparison_id", "keyword", (F.col("pos") + 1).alias("pos")
    )


def rejected_comparisons(requests: DataFrame) -> DataFrame:
    """``comparison_id, term_count`` of requests that do not name 2 to 5 keywords, or have no id."""
    return _named_keywords(requests).filter(~_comparable()).select("comparison_id", F.size("terms").alias("term_count"))


def _named_keywords(requests: DataFrame) -> DataFrame:
    terms = F.filter(F.array_distinct("keywords"), lambda k: k.isNotNull())
    return requests.select("comparison_id", F.coalesce(terms, F.array().cast("array<string>")).alias("terms"))


def _comparable() -> Column:
    return F.col("comparison_id").isNotNull() & F.size("terms").between(2, 5)


def _on_shared_scales(counts: DataFrame, members: DataFrame) -> DataFrame:
    """``counts`` once per comparison of their keyword, with ``value`` against the comparison's peak.

    Peaks come from one row per keyword, so counts are only joined once, after everything that
    depends on comparisons alone; a keyword that many comparisons name is a skewed join that adaptive execution splits.
    """
    tops = counts.groupBy("keyword").agg(F.max("n").alias("top"))
    peaks = members.join(tops, "keyword").groupBy("comparison_id").agg(F.max("top").alias("peak"))
    placed = members.join(peaks, "comparison_id")
    return counts.join(placed, "keyword").withColumn("value", _index(F.col("n"), F.col("peak")))


def compare_many(counts: DataFrame, members: DataFrame) -> DataFrame:
    """Any number of comparisons at once: ``comparison_id, pos, keyword, ts, value, is_partial``."""
    return _on_shared_scales(counts, members).select("comparison_id", "pos", "keyword", "ts", "value", "is_partial")


def many_winners(series: DataFrame) -> DataFrame:
    """Keywords of every comparison by falling average with their place, ties by keyword."""
    average = series.groupBy("comparison_id", "keyword").agg(F.round(F.avg("value")).cast("int").alias("average"))
    order = Window.partitionBy("comparison_id").orderBy(F.desc("average"), "keyword")  # five rows at most
    return average.select("*", F.row_number().over(order).alias("place"))


def many_region_winners(counts: DataFrame, members: DataFrame) -> DataFrame:
    """The strongest keyword of every comparison and region; on ties the one named first.

    The result has a row per comparison and region that knows one of its keywords, so it grows with their product.
    Comparisons are cut into chunks and regions into blocks, each packed into one compressed row: these are shuffled, once
    per block and once per chunk, and rows of the size of the result first arise inside the tasks that put them out.
    """
    spark, region = counts.sparkSession, ["geo_code", "geo_name"]
    counts = materialize(spark, counts.groupBy("keyword", *region).agg(F.max("n").alias("n")), "region-counts")
    tops = counts.groupBy("keyword").agg(F.max("n").alias("_top"))
    named = members.join(tops, "keyword").groupBy("comparison_id").agg(  # five keywords at most
        F.array_sort(F.collect_list(F.struct("pos", "keyword"))).alias("_terms"), F.max("_top").alias("_peak")
    )
    named = materialize(spark, named, "region-comparisons")
    chunks = named.count() // CHUNK + 1
    blocks = counts.select(*region).distinct().count() // BLOCK + 1
    asked = named.select(
        F.pmod(F.xxhash64("comparison_id"), F.lit(chunks)).alias("_chunk"),
        "comparison_id", F.col("_terms.keyword").alias("terms"), F.col("_peak").alias("peak"),
    ).groupBy("_chunk").applyInArrow(_packed_comparisons, "_chunk long, asked binary")
    known = counts.withColumn("_block", F.pmod(F.xxhash64(*region), F.lit(blocks)))
    known = known.groupBy("_block").applyInArrow(_packed_counts, "_block long, known binary")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    cell = ["_chunk", "_block"]
    pairs = (
        asked.withColumn("_block", every(blocks)).groupBy(*cell)
        .cogroup(known.withColumn("_chunk", every(chunks)).groupBy(*cell))
    )
    types = {f.name: f.dataType.simpleString() for f in [*members.schema.fields, *counts.schema.fields]}
    schema = f"comparison_id {types['comparison_id']}, geo_code {types['geo_code']}, geo_name {types['geo_name']}, top_keyword string, top_value int"
    return pairs.applyInArrow(_cell_winners, schema)


def _packed(key: str, name: str, rows: pa.Table, columns: dict) -> pa.Table:
    """One row of the group's key and all its columns, compressed."""
    whole, sink = pa.table(columns), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, whole.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(whole)
    return pa.table({key: rows[key].slice(0, 1), name: pa.array([sink.getvalue().to_pybytes()], pa.binary())})


def _unpacked(packed: pa.Table, name: str) -> pa.Table:
    return pa.ipc.open_stream(packed[name][0].as_buffer()).read_all().combine_chunks()


def _packed_comparisons(rows: pa.Table) -> pa.Table:
    """A chunk's comparisons by id; names as numbers in ``k0`` to ``k4``, beyond the last one NULL."""
    rows = rows.sort_by("comparison_id")
    terms = rows["terms"].combine_chunks()
    words = terms.flatten().dictionary_encode()
    size = pc.list_value_length(terms).to_numpy()
    first = np.cumsum(size) - size
    nth = lambda k: words.take(pa.array(np.minimum(first + k, len(words) - 1), mask=size <= k))
    return _packed("_chunk", "asked", rows, {c: rows[c] for c in ("comparison_id", "peak")} | {f"k{k}": nth(k) for k in range(5)})


def _packed_counts(rows: pa.Table) -> pa.Table:
    """Counts of a block's regions; sorted, so that regions repeat alike for each keyword."""
    names = ["keyword", "geo_code", "geo_name"]
    rows = rows.sort_by([(c, "ascending") for c in names])
    coded = {c: rows[c].combine_chunks().dictionary_encode(null_encoding="encode") for c in names}
    return _packed("_block", "known", rows, coded | {"n": rows["n"]})


def _cell_winners(asked: pa.Table, known: pa.Table) -> pa.Table:
    """Winners of a chunk's comparisons in a block's regions: ``CHUNK * BLOCK`` rows at about, ``PART`` regions at a time."""
    if not asked.num_rows or not known.num_rows:
        return pa.table({})
    asked, known = _unpacked(asked, "asked"), _unpacked(known, "known")
    code, name = known["geo_code"].chunk(0), known["geo_name"].chunk(0)
    both = code.indices.to_numpy().astype(np.int64) * (len(name.dictionary) + 1) + name.indices.to_numpy()
    places, first, place = np.unique(both, return_index=True, return_inverse=True)
    # words by their number in the chunk; the last row stands for names beyond the last one and words that nobody asks for
    terms = asked["k0"].chunk(0).dictionary
    number = pc.index_in(known["keyword"].chunk(0).dictionary, value_set=terms).fill_null(len(terms)).to_numpy()
    word = number[known["keyword"].chunk(0).indices.to_numpy()]
    held = np.flatnonzero(word < len(terms))
    held = held[np.argsort(place[held], kind="stable")]
    n, word, place = known["n"].to_numpy()[held], word[held], place[held]
    named = [pc.fill_null(asked[f"k{k}"].chunk(0).indices, len(terms)).to_numpy() for k in range(5)]
    peak = asked["peak"].to_numpy()[:, None]
    parts = [
        _part_winners(asked["comparison_id"], named, peak, terms, place[at] - low, n[at], word[at], *(c.take(pa.array(first[low : low + PART])) for c in (code, name)))
        for low in range(0, len(places), PART)
        for at in [slice(*np.searchsorted(place, [low, low + PART]))]
    ]
    return pa.concat_tables(parts)


def _part_winners(ids, named: list, peak, terms, place, n, word, codes: pa.Array, names: pa.Array) -> pa.Table:
    """Winners in the regions ``codes, names``, from counts ``n`` of each place and word."""
    known = np.full((len(terms) + 1, len(codes)), -1, np.int64)
    known[word, place] = n
    best = np.full((len(peak), len(codes)), -1, np.int32)
    best_word = np.zeros_like(best)
    for nth in named:
        own = known[nth]
        share = np.where(peak > 0, own * 100.0 / np.maximum(peak, 1), 0.0)
        value = np.floor(share)
        value = np.where(own < 0, -1, value + (share - value >= 0.5)).astype(np.int32)
        better = value > best
        best = np.where(better, value, best)
        best_word = np.where(better, nth[:, None], best_word)
    row, at = np.nonzero(best >= 0)
    plain = lambda c: c.dictionary_decode().take(pa.array(at))
    return pa.table({
        "comparison_id": ids.take(pa.array(row)).combine_chunks(), "geo_code": plain(codes), "geo_name": plain(names),
        "top_keyword": terms.take(pa.array(best_word[row, at])), "top_value": pa.array(best[row, at], pa.int32()),
    })


def averages(series: DataFrame) -> DataFrame:
    """Average per keyword on the scale of ``series``."""
    return series.groupBy("keyword").agg(F.round(F.avg("value")).cast("int").alias("average"))


def winners(average: DataFrame) -> DataFrame:
    """Keywords by falling average with their place, ties by keyword.

    Input is one row per compared keyword, five at most, hence the one window.
    """
    order = Window.orderBy(F.desc("average"), "keyword")
    return average.select("keyword", "average", F.row_number().over(order).alias("place"))


def comparison_table(series: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """One column per keyword: ``date, kw1..kwN, is_partial``, oldest first."""
    return (
        series.groupBy(F.col("ts").alias("date"), "is_partial")
        .pivot("keyword", list(keywords))
        .agg(F.max("value"))
        .select("date", *[F.col(f"`{k}`") for k in keywords], "is_partial")
        .orderBy("date")
    )


def series_table(series: DataFrame, keyword: str) -> DataFrame:
    """``date, value, is_partial`` of one keyword, oldest first."""
    return (
        series.where(F.col("keyword") == keyword)
        .select(F.col("ts").alias("date"), "value", "is_partial")
        .orderBy("date")
    )


def peaks(series: DataFrame) -> DataFrame:
    """First highest point per keyword."""
    return series.groupBy("keyword").agg(
        F.max("value").alias("peak_value"),
        F.max_by("ts", F.struct("value", -F.unix_micros(F.col("ts").cast("timestamp")))).alias("peak_at"),
        F.count(F.lit(1)).alias("point_count"),
        (~F.bool_or(F.col("value") != 0)).alias("is_empty"),
    )


def latest_points(series: DataFrame, n: int = 5) -> DataFrame:
    """The last ``n`` points per keyword."""
    order = Window.partitionBy("keyword").orderBy(F.desc("ts"))
    return (
        series.withColumn("back", F.row_number().over(order))
        .where(F.col("back") <= n)
        .select("keyword", "ts", "value", "is_partial", "back")
    )


def region_counts(events: DataFrame, users: DataFrame) -> DataFrame:
    """Counts per keyword and region from ``events(keyword, user)`` and
    ``users(user, geo_code, geo_name)``.

    Events are combined per (keyword, user) before they meet the users: a user
    with a third of all events is one row per keyword in the join.
    """
    per_user = events.groupBy("keyword", "user").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_user.join(users, "user")
        .groupBy("keyword", "geo_code", "geo_name")
        .agg(F.sum("n").alias("n"))
    )


def interest_by_region(counts: DataFrame) -> DataFrame:
    """Regions of each keyword against the keyword's strongest one."""
    peak = F.max("n").over(Window.partitionBy("keyword"))
    return counts.select("keyword", "geo_code", "geo_name", _index(F.col("n"), peak).alias("value"))


def compare_regions(counts: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """Regions of 2 to 5 keywords on one scale with the winner of each region.

    On ties the keyword named first wins.  ``values`` holds five entries at most.
    """
    if not 2 <= len(keywords) <= 5:
        raise ValueError(f"compare 2 to 5 keywords, got {len(keywords)}")
    picked = counts.where(F.col("keyword").isin(list(keywords)))
    position = F.array_position(F.lit(list(keywords)), F.col("keyword")).cast("int")
    scaled = picked.select(
        "keyword", "geo_code", "geo_name", position.alias("pos"), _index(F.col("n"), _group_peak()).alias("value")
    )
    return scaled.groupBy("geo_code", "geo_name").agg(
        F.max_by("keyword", F.struct("value", -F.col("pos"))).alias("top_keyword"),
        F.max("value").alias("top_value"),
        F.map_from_entries(F.collect_list(F.struct("keyword", "value"))).alias("values"),
    )


def strongest_first(regions: DataFrame) -> DataFrame:
    return regions.orderBy("keyword", F.desc("value"), "geo_code")
