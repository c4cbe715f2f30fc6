"""Append-only history of snapshots: two partitioned Parquet tables.

``snapshots`` holds header and payload text per (source, geo, fetched_at), and
``trends`` holds the narrow keyword rows.  Both are partitioned by ``source``
and ``fetched_date`` (the UTC day, whatever the session's time zone), so filters
on source and time prune files, and
``trends`` files are sorted by ``keyword_key`` so a keyword look-up skips row
groups by their min/max.

Each append labels its rows with a batch.  A snapshot is there as soon as its
header is, and its trends are those with the header's label: rows of an append
that was cut short belong to no header and are not read.  Of several headers
with one key, as after two appends at once, the earliest batch counts.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.text import fold_ascii
from ..functions.times import as_instant
from ..schemas import LAYOUT_VERSION, SNAPSHOT_KEY, TRENDING_SOURCES
from .sequence import neighbours

SNAPSHOTS = (
    "source STRING, geo STRING, fetched_at TIMESTAMP, schema_version STRING, trend_count INT,"
    " payload_json STRING, layout_version INT, batch STRING, fetched_date DATE"
)
TRENDS = (
    "source STRING, geo STRING, fetched_at TIMESTAMP, keyword STRING, keyword_key STRING, rank INT,"
    " volume_text STRING, volume_min BIGINT, layout_version INT, batch STRING, fetched_date DATE"
)
_PARTITIONS = ["source", "fetched_date"]


def _path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def create(spark: SparkSession, root: str) -> None:
    """Create the two tables when missing; existing data stays."""
    for table, schema in (("snapshots", SNAPSHOTS), ("trends", TRENDS)):
        empty = spark.createDataFrame([], schema)
        empty.write.mode("append").partitionBy(*_PARTITIONS).parquet(_path(root, table))


def utc_day(instant: Column) -> Column:
    """The UTC day of an instant; ``to_date`` would give the day in the session's zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(instant) / 86_400_000_000).cast("int"))


def stored(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All stored rows of ``snapshots`` or ``trends``, whatever their layout and batch."""
    return spark.read.schema({"snapshots": SNAPSHOTS, "trends": TRENDS}[table]).parquet(_path(root, table))


def _counting(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Stored rows of the batch that counts for their snapshot, with its label.

    The batch is read from the narrow columns of the headers.  Filters on a
    keyword go below the join, filters on the key to both sides of it.
    """
    key = [*SNAPSHOT_KEY, "fetched_date"]
    first = guard_layout(stored(spark, root, "snapshots")).groupBy(*key).agg(F.min(_label()).alias("_first"))
    rows = guard_layout(stored(spark, root, table)).withColumn("_first", _label())
    return rows.join(first, [*key, "_first"], "left_semi").drop("_first")


def _label() -> Column:
    """The batch; rows from before the labels are one batch that came first."""
    return F.coalesce("batch", F.lit(""))


def snapshots(spark: SparkSession, root: str) -> DataFrame:
    """One row per snapshot; fails on rows of another layout."""
    return _counting(spark, root, "snapshots").drop("batch")


def trends(spark: SparkSession, root: str) -> DataFrame:
    """One row per keyword of a snapshot; fails on rows of another layout."""
    return _counting(spark, root, "trends").drop("batch")


# --- building -----------------------------------------------------------------


def keyword_rows(envelopes: DataFrame) -> DataFrame:
    """Keyword rows of envelopes of any kind.

    A trending envelope lists its ``trends``; a comparison its ``keywords`` and
    a single explore answer its ``keyword``, both without rank and volume.
    Absent columns count as absent fields; an envelope with none gives no rows.
    """
    entry = "array<struct<keyword:string,rank:int,volume_text:string,volume_min:bigint>>"

    def bare(keyword: Column) -> Column:
        return F.struct(
            keyword.alias("keyword"),
            F.lit(None).cast("int").alias("rank"),
            F.lit(None).cast("string").alias("volume_text"),
            F.lit(None).cast("bigint").alias("volume_min"),
        )

    sources = []
    if "trends" in envelopes.columns:
        sources.append(
            F.transform(
                "trends",
                lambda t: F.struct(
                    F.coalesce(t["keyword"], F.lit("")).alias("keyword"),
                    t["rank"].cast("int").alias("rank"),
                    t["volume_text"].alias("volume_text"),
                    t["volume_min"].cast("bigint").alias("volume_min"),
                ),
            )
        )
    if "keywords" in envelopes.columns:
        sources.append(F.transform("keywords", bare))
    if "keyword" in envelopes.columns:
        sources.append(F.when(F.col("keyword").isNotNull(), F.array(bare(F.col("keyword")))))
    entries = F.coalesce(*[s.cast(entry) for s in sources])
    return envelopes.select(*SNAPSHOT_KEY, F.inline(entries))


def incomplete(envelopes: DataFrame) -> DataFrame:
    """Envelopes that cannot be stored, with a ``reason``: a part of their key is NULL."""
    reason = F.concat_ws(", ", *[F.when(F.col(k).isNull(), F.lit(f"no {k}")) for k in SNAPSHOT_KEY])
    return envelopes.withColumn("reason", reason).where(F.col("reason") != "")


def _one_per_key(envelopes: DataFrame) -> DataFrame:
    """One of the staged envelopes per key; of differing duplicates the choice is fixed.

    Keys that come twice are found by the keys alone; only their envelopes are sorted and compared.  That
    aggregate combines before the shuffle, so a key that fills a third of the batch still sends one row per task.
    """
    key = list(SNAPSHOT_KEY)
    twice = envelopes.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(*key)
    if twice.isEmpty():
        return envelopes
    rest = [c for c in envelopes.columns if c not in key]
    single = envelopes.join(twice, key, "left_anti")
    kept = (
        envelopes.join(twice, key, "left_semi")
        .groupBy(*key)
        .agg(F.min_by(F.struct(*rest), F.struct(F.xxhash64("payload_json"), "payload_json")).alias("_kept"))
        .select(*key, "_kept.*")
    )
    return single.unionByName(kept)


def _missing(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows whose snapshot key is not stored yet.

    Only the stored partitions of the batch's own dates are read: the list of
    distinct dates is bounded by the calendar, which makes its broadcast safe
    and lets Spark prune the partitions from it at run time.  Stored keys are
    made distinct before the shuffle.
    """
    dates = rows.select("source", "fetched_date").distinct()
    near = existing.join(F.broadcast(dates), ["source", "fetched_date"], "left_semi")
    return rows.join(near.select(*SNAPSHOT_KEY).distinct(), SNAPSHOT_KEY, "left_anti")


def _write(rows: DataFrame, path: str, sort: Sequence[str] = ()) -> None:
    # rebalance: adaptive execution splits a hot date and merges small ones
    rows = rows.hint("rebalance", *_PARTITIONS)
    if sort:
        rows = rows.sortWithinPartitions(*_PARTITIONS, *sort)
    rows.write.mode("append").partitionBy(*_PARTITIONS).parquet(path)


def append(spark: SparkSession, root: str, envelopes: DataFrame) -> None:
    """Append envelopes; a key that is stored already is left alone.

    ``envelopes`` need ``source, geo, fetched_at, schema_version, payload_json``
    and the columns of :func:`keyword_rows`; those with an :func:`incomplete` key
    are left out.  The trends are written before the headers that make them
    count, so a run that was cut short anywhere is made good by running it again,
    and of two that run together one counts for a key.  The batch is staged once:
    both tables read the same narrow columns from there instead of running the
    ingest again.
    """
    run = uuid.uuid4().hex[:12]
    label = F.lit(f"{time.time_ns():020d}-{run}")
    staging = f"{_path(root, '_staging')}/append-{run}"
    whole = envelopes.dropna(subset=list(SNAPSHOT_KEY))
    whole.withColumn("fetched_date", utc_day(F.col("fetched_at"))).write.parquet(staging)
    schema = T.StructType([*envelopes.schema.fields, T.StructField("fetched_date", T.DateType())])
    staged = _one_per_key(spark.read.schema(schema).parquet(staging))
    batch = _missing(staged, snapshots(spark, root))
    stamps = {"layout_version": F.lit(LAYOUT_VERSION), "batch": label, "fetched_date": utc_day(F.col("fetched_at"))}
    rows = keyword_rows(batch).withColumn("keyword_key", fold_ascii(F.col("keyword"))).withColumns(stamps)
    _write(rows, _path(root, "trends"), sort=["keyword_key"])

    counts = [F.size(c) for c in ("trends", "keywords") if c in batch.columns]
    counts = [F.when(size >= 0, size) for size in counts]
    if "keyword" in batch.columns:
        counts.append(F.when(F.col("keyword").isNotNull(), 1))
    headers = batch.select(
        *SNAPSHOT_KEY,
        F.col("schema_version").cast("string"),
        F.coalesce(*counts, F.lit(0)).cast("int").alias("trend_count"),
        "payload_json",
        *[value.alias(name) for name, value in stamps.items()],
    )
    _write(headers, _path(root, "snapshots"))
    _delete(spark, staging)


# --- reading ------------------------------------------------------------------


def matching(
    rows: DataFrame,
    geo: str | None = None,
    source: str | Sequence[str] | None = None,
    start=None,
    end=None,
) -> DataFrame:
    """Rows of a geo, of one or several sources, between inclusive time bounds.

    The bounds are also put on the partition date, which prunes files.
    """
    if geo is not None:
        rows = rows.where(F.col("geo") == geo)
    if source is not None:
        sources = [source] if isinstance(source, str) else list(source)
        if not sources or not all(isinstance(s, str) for s in sources):
            raise ValueError(f"pass one source name or a list of at least one, not {source!r}")
        rows = rows.where(F.col("source").isin(sources))
    dated = "fetched_date" in rows.columns
    for bound, lower in ((start, True), (end, False)):
        if bound is None:
            continue
        if isinstance(bound, str) and not bound.strip():
            raise ValueError("a time bound must not be blank")
        instant = as_instant(bound)
        rows = rows.where(F.col("fetched_at") >= instant if lower else F.col("fetched_at") <= instant)
        if dated:
            day = utc_day(instant)
            rows = rows.where(F.col("fetched_date") >= day if lower else F.col("fetched_date") <= day)
    return rows


def _snapshot_key(*tables: DataFrame) -> list[str]:
    """The snapshot key; with the partition date where all tables carry it, so
    that a join on it can prune partitions at run time."""
    dated = all("fetched_date" in t.columns for t in tables)
    return [*SNAPSHOT_KEY, "fetched_date"] if dated else list(SNAPSHOT_KEY)


def _key_of(rows: DataFrame) -> Column:
    return F.col("keyword_key") if "keyword_key" in rows.columns else fold_ascii(F.col("keyword"))


def read_snapshots(
    headers: DataFrame,
    rows: DataFrame,
    geo: str | None = None,
    source: str | Sequence[str] | None = None,
    start=None,
    end=None,
    keyword: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Snapshots newest first, optionally only those that contain a keyword.

    The keyword matches exactly but for ASCII case and is not trimmed.  Ties in
    time are broken by (source, geo).  ``limit`` counts snapshots.
    """
    found = matching(headers, geo, source, start, end)
    if keyword is not None:
        hits = matching(rows, geo, source, start, end).where(_key_of(rows) == fold_ascii(F.lit(keyword)))
        key = _snapshot_key(found, hits)
        found = found.join(hits.select(*key), key, "left_semi")
    found = found.orderBy(F.desc("fetched_at"), "source", "geo")
    return found if limit is None else found.limit(limit)


def keyword_history(
    rows: DataFrame,
    keyword: str,
    geo: str | None = None,
    start=None,
    end=None,
    source: str | Sequence[str] | None = None,
) -> DataFrame:
    """Every appearance of a keyword, oldest first; the keyword is trimmed.

    The narrow table answers alone: its rows carry the snapshot key.
    """
    if not isinstance(keyword, str) or not keyword.strip():
        raise ValueError(f"a history needs a keyword with some text, not {keyword!r}")
    return (
        matching(rows, geo, source, start, end)
        .where(_key_of(rows) == fold_ascii(F.lit(keyword.strip())))
        .select("fetched_at", "geo", "source", "rank", "volume_min")
        .orderBy("fetched_at", "source", "geo", "rank")
    )


def compact_history(
    headers: DataFrame,
    rows: DataFrame,
    geo: str | None = None,
    keyword: str | None = None,
    start=None,
    end=None,
    limit: int = 10,
) -> tuple[DataFrame, DataFrame | None]:
    """The newest trending snapshots in compact form, and a keyword's timeline.

    Explore answers are left out: they were asked for, they did not trend.
    """
    if not 1 <= limit <= 100:
        raise ValueError(f"a compact history shows 1 to 100 snapshots, not {limit}")
    newest = read_snapshots(headers, rows, geo, TRENDING_SOURCES, start, end, keyword, limit)
    # at most 100 snapshot keys by the check above
    key = _snapshot_key(newest, rows)
    entries = rows.join(F.broadcast(newest.select(*key, "trend_count")), key).select(
        *SNAPSHOT_KEY, "trend_count", "keyword", "rank", "volume_min"
    )
    timeline = keyword_history(rows, keyword, geo, start, end, TRENDING_SOURCES) if keyword else None
    return entries.orderBy(F.desc("fetched_at"), "source", "geo", "rank"), timeline


def archive_stats(headers: DataFrame, rows: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """One row: snapshot and trend counts, time range, geos, sources, stored answers.

    Counts are combined per (source, geo) first; the lists hold the distinct
    codes only.
    """
    per_path = headers.groupBy("source", "geo").agg(
        F.count(F.lit(1)).alias("n"), F.min("fetched_at").alias("lo"), F.max("fetched_at").alias("hi")
    )
    stats = per_path.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("snapshot_count"),
        F.array_sort(F.collect_set("geo")).alias("geos"),
        F.array_sort(F.collect_set("source")).alias("sources"),
        F.min("lo").alias("first_fetched_at"),
        F.max("hi").alias("last_fetched_at"),
    )
    trend_rows = rows.agg(F.count(F.lit(1)).alias("n"))
    stored = F.lit(0).cast("bigint") if answers is None else answers.agg(F.count(F.lit(1)).alias("n")).scalar()
    return stats.select(
        "snapshot_count",
        trend_rows.scalar().alias("trend_row_count"),
        "geos",
        "sources",
        "first_fetched_at",
        "last_fetched_at",
        stored.alias("answer_count"),
    )


def keyword_movement(rows: DataFrame, geo: str | None = None, bucket: str = "day") -> DataFrame:
    """Per keyword and snapshot: first time seen and the step from the last rank.

    The previous appearance is looked up per time bucket, so a keyword that is
    in every snapshot does not become one long task.
    """
    best = matching(rows, geo).groupBy("source", "geo", "keyword", "fetched_at").agg(F.min("rank").alias("rank"))
    return neighbours(best, ["source", "geo", "keyword"], "fetched_at", bucket, carry=["rank"]).select(
        "source", "geo", "keyword", "fetched_at", F.col("first_at").alias("first_seen_at"), "prev_at", "rank", "prev_rank",
        (F.col("prev_rank") - F.col("rank")).alias("moved_up"),
    )


def incompatible_layout(headers: DataFrame, supported: int = LAYOUT_VERSION) -> DataFrame:
    """Layout versions in the data that this code must not read, with counts."""
    return (
        headers.groupBy("layout_version")
        .agg(F.count(F.lit(1)).alias("snapshot_count"))
        .where(~F.col("layout_version").eqNullSafe(F.lit(supported)))
    )


def guard_layout(rows: DataFrame, supported: int = LAYOUT_VERSION) -> DataFrame:
    """``rows`` unchanged; the job fails on the first row of another layout.

    The check is a filter, so it runs whatever columns are asked for.
    """
    ok = F.col("layout_version").eqNullSafe(F.lit(supported))
    found = F.coalesce(F.col("layout_version").cast("string"), F.lit("NULL"))
    refused = F.raise_error(F.concat(F.lit("unsupported archive layout "), found)).cast("boolean")
    return rows.where(F.when(ok, True).otherwise(refused))


# --- pruning ------------------------------------------------------------------


def _doomed(before, geo: str | None, source: str | None) -> Column:
    gone = F.col("fetched_at") < as_instant(before)
    if geo is not None:
        gone = gone & (F.col("geo") == geo)
    if source is not None:
        gone = gone & (F.col("source") == source)
    return gone


def prune_counts(headers: DataFrame, before, geo: str | None = None, source: str | None = None) -> DataFrame:
    """How many snapshots a prune deletes and keeps (one row)."""
    gone = _doomed(before, geo, source)
    return headers.agg(F.count_if(gone).alias("deleted"), F.count_if(~gone).alias("kept"))


def surviving(rows: DataFrame, before, geo: str | None = None, source: str | None = None) -> DataFrame:
    """Rows that a prune keeps: not strictly older, or of another geo or source."""
    return rows.where(~_doomed(before, geo, source))


def prune(spark: SparkSession, root: str, before, geo: str | None = None, source: str | None = None) -> int:
    """Delete snapshots strictly older than ``before`` with their trend rows.

    Only partitions that can hold such rows are touched.  Survivors of these
    partitions are staged first, then swapped in by a dynamic partition
    overwrite, then partitions without survivors are dropped: no path is
    overwritten while it is read, and an interrupted prune can be repeated.
    Returns the number of deleted snapshots.
    """
    deleted = prune_counts(snapshots(spark, root), before, geo, source).first()["deleted"]
    last_day = utc_day(as_instant(before))
    run = uuid.uuid4().hex[:12]
    for table, schema in (("trends", TRENDS), ("snapshots", SNAPSHOTS)):
        path = _path(root, table)
        touched = _counting(spark, root, table).where(F.col("fetched_date") <= last_day)
        if source is not None:
            touched = touched.where(F.col("source") == source)
        # partitions of interest: one row per (source, date) with losses
        gone = _doomed(before, geo, source)
        parts = touched.groupBy(*_PARTITIONS).agg(
            F.count_if(gone).alias("lost"), F.count_if(~gone).alias("left")
        ).where(F.col("lost") > 0)
        plan = parts.collect()  # one row per affected partition directory, not per record
        partial = [p for p in plan if p["left"] > 0]
        if partial:
            keep = spark.createDataFrame(
                [(p["source"], p["fetched_date"]) for p in partial], "source STRING, fetched_date DATE"
            )
            staging = f"{_path(root, '_staging')}/prune-{run}/{table}"
            survivors = touched.join(F.broadcast(keep), _PARTITIONS, "left_semi").where(~gone)
            _write_staged(survivors, staging)
            (
                spark.read.schema(schema)
                .parquet(staging)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(*_PARTITIONS)
                .parquet(path)
            )
        for p in plan:
            if p["left"] == 0:
                _delete(spark, f"{path}/source={p['source']}/fetched_date={p['fetched_date']}")
    _delete(spark, f"{_path(root, '_staging')}/prune-{run}")
    return deleted


def _write_staged(rows: DataFrame, path: str) -> None:
    rows.hint("rebalance", *_PARTITIONS).write.mode("overwrite").partitionBy(*_PARTITIONS).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
