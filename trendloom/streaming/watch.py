"""Change detection on a stream of snapshots.

Every micro-batch is one set-wise diff: its snapshots and the last stored one of every
(source, geo) go through the same aggregation as a whole history, so a busy geo spreads
over its keywords and no task holds a geo.

A snapshot counts if it is newer than all of its geo that landed in earlier files;
otherwise it is late, and is set aside and counted.  Only the order in which files
landed decides, not how many of them make up a micro-batch, so every limit of files or bytes per
trigger finds the same changes.  (Files with one modification time, to the
millisecond, have no order; land one geo's snapshots in different milliseconds.)

Tables of a watch, below its folder:

* ``state/v=<batch>``: last snapshot per (source, geo), whole.  A batch reads the newest version
  before its own and writes its own last, so a repeated batch finds the same;
* ``late/batch=<batch>``: headers of late snapshots.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators.changes import diff_history, filter_changes, same_key
from ..schemas import SNAPSHOT_KEY

_GEO = ["source", "geo"]
_STATE = "source STRING, geo STRING, fetched_at TIMESTAMP, keyword STRING, rank INT, volume_min BIGINT"
_LATE = "source STRING, geo STRING, fetched_at TIMESTAMP, newest_at TIMESTAMP, batch BIGINT"
#: Column in which a stream carries when its file landed.
ARRIVED = "landed_at"


def written(spark: SparkSession, path: str, prefix: str = "v=") -> list[int]:
    """Numbers of the complete versions (or batches) below ``path``."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    done = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName().startswith(prefix)]
    return sorted(int(p.getName()[len(prefix):]) for p in done if files.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def _drop_version(spark: SparkSession, path: str, version: int) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/v={version}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _place(snapshots: DataFrame, last: DataFrame) -> DataFrame:
    """Adds ``newest_at``: the newest time of the geo in the state and in files that landed before."""
    per_file = snapshots.groupBy(*_GEO, ARRIVED).agg(F.max("fetched_at").alias("hi"))
    # One row per geo and file of the batch, all of which the driver has listed before.
    before = Window.partitionBy(*_GEO).orderBy(ARRIVED).rowsBetween(Window.unboundedPreceding, -1)
    upto = per_file.select(*_GEO, ARRIVED, F.max("hi").over(before).alias("upto"))
    known = last.groupBy(*_GEO).agg(F.max("fetched_at").alias("stored"))
    placed = same_key(same_key(snapshots, upto, [*_GEO, ARRIVED]), known, _GEO, "left")
    return placed.withColumn("newest_at", F.greatest("upto", "stored")).drop("upto", "stored")


@dataclass(frozen=True)
class Watch:
    """A ``foreachBatch`` writer that diffs landed snapshots; ``on_changes`` gets each batch's changes.

    ``snapshots`` rows have ``source, geo, fetched_at, trends, landed_at``; the first snapshot of a
    geo is its baseline.  ``on_changes`` may see a batch again after a failure, with the
    same number and the same changes.
    """

    folder: str
    on_changes: Callable[[DataFrame, int], None]
    min_volume: int | None = None
    events: Sequence[str] | None = None
    keywords: Sequence[str] | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, state = batch.sparkSession, f"{self.folder}/state"
        earlier = [v for v in written(spark, state) if v < batch_id]
        last = spark.read.schema(_STATE).parquet(f"{state}/v={earlier[-1]}") if earlier else spark.createDataFrame([], _STATE)
        batch = batch.persist()
        try:
            batch.count()  # read and parsed once; both of its readers below would do it at one time, on different executors
            placed = _place(batch, last)
            newer = F.col("newest_at").isNull() | (F.col("fetched_at") > F.col("newest_at"))
            newer = F.coalesce(newer & F.col("fetched_at").isNotNull(), F.lit(False))  # without time: set aside, too
            # Of one snapshot that a file holds twice, one stays.
            fresh = placed.filter(newer).groupBy(*SNAPSHOT_KEY).agg(
                F.min_by("trends", F.xxhash64(F.to_json("trends"))).alias("trends")
            )
            fresh = fresh.persist()
            empty = F.array(F.struct(*[F.lit(None).cast(t).alias(c) for c, t in (("keyword", "string"), ("rank", "int"), ("volume_min", "bigint"))]))
            # A snapshot without trends keeps one row, so that its time is not lost.
            rows = fresh.select(*SNAPSHOT_KEY, F.inline(F.when(F.size("trends") > 0, F.col("trends")).otherwise(empty)))
            both = last.unionByName(rows.select(*last.columns))
            changes = diff_history(both, both.select(*SNAPSHOT_KEY).distinct())
            self.on_changes(filter_changes(changes, self.min_volume, self.events, self.keywords), batch_id)
            late = placed.filter(~newer).select(*SNAPSHOT_KEY, "newest_at")
            late.write.mode("overwrite").parquet(f"{self.folder}/late/batch={batch_id}")
            newest = both.groupBy(*_GEO).agg(F.max("fetched_at").alias("fetched_at"))
            same_key(both, newest, SNAPSHOT_KEY, "left_semi").write.mode("overwrite").parquet(f"{state}/v={batch_id}")
            for version in earlier[:-1]:
                _drop_version(spark, state, version)
            fresh.unpersist()
        finally:
            batch.unpersist()


def start_watch(snapshots: DataFrame, watch: Watch, checkpoint: str, interval: str | None = None):
    """Run a watch: every ``interval``, or over what has landed and then stop."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        snapshots.writeStream.option("checkpointLocation", checkpoint).foreachBatch(watch).trigger(**trigger).start()
    )


def baseline(spark: SparkSession, folder: str) -> DataFrame:
    """What the next snapshots are compared with: ``source, geo, fetched_at, keyword, rank, volume_min``."""
    versions = written(spark, f"{folder}/state")
    if not versions:
        return spark.createDataFrame([], _STATE)
    rows = spark.read.schema(_STATE).parquet(f"{folder}/state/v={versions[-1]}")
    return rows.filter(F.col("keyword").isNotNull() & (F.col("keyword") != ""))


def late_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots that landed too late, with the newest time that their geo had by then."""
    return spark.read.schema(_LATE).parquet(f"{folder}/late").drop("batch")
