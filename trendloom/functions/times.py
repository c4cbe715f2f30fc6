"""Time text to instants.

All results are TIMESTAMP instants.  The offset is always part of the parsed
text, so the session time zone never changes a result.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import squeeze

_FEED = r"^(?i:Mon|Tue|Wed|Thu|Fri|Sat|Sun),\s*(.+)$"
_SHORT_OFFSET = r" UTC([+-])(\d)(:?\d\d)?$"  # one digit of hours; "$10" is group 1, then a zero


def feed_timestamp(col: Column) -> Column:
    """``Tue, 4 Nov 2025 03:00:00 -0800``; NULL when the text has another form."""
    # Spark refuses EEE when parsing, so the weekday is checked and cut by regexp.
    return F.try_to_timestamp(F.regexp_extract(col, _FEED, 1), F.lit("d MMM yyyy H:m:s [XX][XXX]"))


def export_timestamp(col: Column) -> Column:
    """``August 15, 2026 at 7:10:00 AM UTC+3``; NULL when it cannot be read.

    The offset is brought to a form that the parser reads itself.  Every part
    is used once or in an always evaluated place: a regexp inside a branch
    would run again for each mention.
    """
    text = F.regexp_replace(squeeze(col), _SHORT_OFFSET, " UTC$10$2$3")
    text = F.concat(text, F.when(text.endswith(" UTC"), "Z").otherwise(""))
    zone = "h:mm:ss a 'UTC'[XXX][XX][X]"
    return F.coalesce(
        F.try_to_timestamp(text, F.lit(f"MMMM d, yyyy 'at' {zone}")),
        F.try_to_timestamp(text, F.lit(f"MMM d, yyyy 'at' {zone}")),
    )


def epoch_timestamp(col: Column) -> Column:
    """Unix seconds as text to an instant; NULL when it is not a whole number."""
    return F.timestamp_seconds(col.try_cast("bigint"))


def as_instant(bound) -> Column:
    """A time bound (datetime, date or ISO text) as an instant.

    Divergence on purpose: the bounds are compared as instants, never as text,
    so data and bound may carry different offsets.  A date-only bound is that
    day's midnight, which excludes the rest of the day from an ``end`` bound.
    """
    return bound if isinstance(bound, Column) else F.lit(bound).cast("timestamp")
