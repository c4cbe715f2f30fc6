"""Trend tables, history, changes and interest as Spark jobs."""

import sys

from pyspark import cloudpickle

from .operators import answers, archive, changes, envelopes, interest, normalize, quality, ranking, related, reports, reuse
from .session import RECOMMENDED, recommended_builder, shared_folder
from .sinks import files as sinks
from .sources import dims, explore, export, feed, landing
from .streaming import alerts, ingest, watch

# Python code that runs in tasks is sent along, so executors need no copy of
# this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "RECOMMENDED", "alerts", "answers", "archive", "changes", "dims", "envelopes", "explore", "export", "feed",
    "ingest", "interest", "landing", "normalize", "quality", "ranking", "recommended_builder", "related", "reports",
    "reuse", "shared_folder", "sinks", "watch",
]
