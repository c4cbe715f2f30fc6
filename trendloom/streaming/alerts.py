"""Alerts from found changes: tables of changes, alert records and their delivery.

Changes of a watch go to a folder (``changes_folder``).  From there a second stream
(``stream_changes``) writes alert records through Spark's JSON-lines file sink, or delivers them
to a receiver; both keep their own checkpoint, so a restart goes on where the last one ended.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..schemas import CHANGES
from ..sinks.files import as_records
from .watch import written

_DELIVERED = "record STRING, delivered BOOLEAN, tries INT"
#: Name under which a delivery stream reports its counts.
OBSERVED = "delivery"


def alert_folder(path: str) -> Callable[[DataFrame, int], None]:
    """A batch writer for ``foreachBatch``: JSON lines in ``path/batch=<id>``.

    A repeated batch overwrites its own folder, so a retry never doubles alerts.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        as_records(batch).write.mode("overwrite").text(f"{path.rstrip('/')}/batch={batch_id}")

    return write


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("record STRING, batch BIGINT").text(path)


def changes_folder(path: str) -> Callable[[DataFrame, int], None]:
    """A receiver of a watch's changes: Parquet in ``path/batch=<id>``.

    A batch that is complete is not written again: its changes are the same, and a stream may have read them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id not in written(batch.sparkSession, path, "batch="):
            batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    return write


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHANGES).parquet(path).drop("batch")


def stream_changes(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Changes of :func:`changes_folder` as a stream."""
    reader = spark.readStream.schema(CHANGES)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{path.rstrip('/')}/batch=*")


def _started(rows: DataFrame, kind: str, path: str, checkpoint: str, interval: str | None):
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    writer = rows.writeStream.format(kind).option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def start_alerts(changes: DataFrame, path: str, checkpoint: str, interval: str | None = None):
    """Write alert records as JSON lines; readers see the files that the sink's log commits, each once."""
    return _started(as_records(changes), "text", path, checkpoint, interval)


def alert_records(spark: SparkSession, path: str) -> DataFrame:
    """The committed records of :func:`start_alerts`."""
    return spark.read.schema("record STRING").text(path)


def _sender(send: Callable[[str], bool], attempts: int):
    def attempt(record: str) -> tuple[bool, int]:
        for n in range(1, attempts + 1):
            try:
                if send(record):
                    return True, n
            except Exception:  # noqa: BLE001 - whatever a receiver raises is a failed try
                pass
        return False, attempts

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            results = [attempt(r) for r in batch["record"]]
            yield batch.assign(delivered=[r[0] for r in results], tries=[r[1] for r in results])

    return run


def deliver(changes: DataFrame, send: Callable[[str], bool], attempts: int = 1) -> DataFrame:
    """Call ``send(record)`` for every change on the executors, up to ``attempts`` times.

    Returns ``record, delivered, tries``.  A ``send`` that raises or returns something
    false counts as not delivered and never fails the job.  Run one action on
    the result: each action sends again.
    """
    return as_records(changes).mapInPandas(_sender(send, attempts), _DELIVERED)


def start_delivery(
    changes: DataFrame, send: Callable[[str], bool], path: str, checkpoint: str, attempts: int = 3, interval: str | None = None
):
    """Deliver a stream of changes and log every record with its outcome in ``path``.

    Sending happens on the executors; a task that Spark repeats sends again (at least once), while the log
    holds every record once.  Counts of each micro-batch are observed as ``delivery``.
    """
    sent = deliver(changes, send, attempts).observe(
        OBSERVED,
        F.count_if("delivered").alias("delivered"), F.count_if(~F.col("delivered")).alias("failed"), F.sum("tries").alias("tries"),
    )
    return _started(sent, "json", path, checkpoint, interval)


class DeliveryCounts(StreamingQueryListener):
    """Adds up the observed counts of delivery streams while they run; register it with ``spark.streams.addListener``."""

    def __init__(self):
        self.totals: Counter = Counter()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        counts = event.progress.observedMetrics.get(OBSERVED)
        if counts is not None:
            self.totals.update({k: v or 0 for k, v in counts.asDict().items()})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def delivery_log(spark: SparkSession, path: str) -> DataFrame:
    """Every record of :func:`start_delivery` with its outcome, over all restarts."""
    return spark.read.schema(_DELIVERED).json(path)


def delivery_report(delivered: DataFrame) -> DataFrame:
    """One row: delivered and failed counts."""
    return delivered.agg(
        F.count_if("delivered").alias("delivered_count"), F.count_if(~F.col("delivered")).alias("failed_count")
    )
