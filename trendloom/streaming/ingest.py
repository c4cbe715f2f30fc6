"""Streams into the archive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..operators import archive
from ..schemas import SNAPSHOT_KEY
from .watch import ARRIVED


def archive_batches(root: str) -> Callable[[DataFrame, int], None]:
    """A batch writer for ``foreachBatch`` that appends envelopes to an archive.

    The append skips stored keys, so a replayed batch changes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        archive.append(batch.sparkSession, root, batch)

    return write


def deduplicated(envelopes: DataFrame, within: str = "7 days") -> DataFrame:
    """Envelopes without those whose key landed before, up to ``within`` earlier, in any micro-batch.

    Time is that of landing (``landed_at``), so snapshots of the past are no late rows; keys are
    forgotten after ``within`` and then caught by the append's own look at the archive.
    """
    return envelopes.withWatermark(ARRIVED, within).dropDuplicatesWithinWatermark(SNAPSHOT_KEY).drop(ARRIVED)


def start_archive(envelopes: DataFrame, root: str, checkpoint: str, within: str = "7 days", interval: str | None = None):
    """Append a stream of envelopes with ``landed_at`` to an archive, each key once."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    writer = deduplicated(envelopes, within).writeStream.option("checkpointLocation", checkpoint)
    return writer.foreachBatch(archive_batches(root)).trigger(**trigger).start()
