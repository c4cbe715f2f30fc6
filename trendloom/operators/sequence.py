"""Order-based lookups that do not funnel one key through one task.

A window over a key puts all rows of that key into one task.  Here the key is
first cut into pieces; windows run per (key, piece), and what crosses a border
comes from one summary row per (key, piece).  The only window over a whole key
sees those summaries: as many rows as the key has pieces.

A piece is a time bucket, or with ``bucket=None`` a range of the whole table in
the order of key and time.  Buckets need no extra pass but follow the calendar;
ranges follow the rows, so a key with all its rows in one hour is cut as well.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

_BUCKET = "_bucket"


def cut_in_ranges(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``rows`` with ``_bucket``, the number of their range by key and order.

    Ranges hold about equally many rows; rows that are equal in key and order
    share one.  The numbers are written with the rows: a second sampling of the
    borders, as after a lost executor, could give others.
    """
    cut = rows.repartitionByRange(*keys, *order).withColumn(_BUCKET, F.spark_partition_id())
    return materialize(rows.sparkSession, cut, "ranges")


def _in_pieces(
    rows: DataFrame, keys: Sequence[str], order: Sequence[Column], ts: str, bucket: str | None
) -> DataFrame:
    if bucket is None:
        return cut_in_ranges(rows, keys, order)
    return rows.withColumn(_BUCKET, F.date_trunc(bucket, ts))


def _join_summary(rows: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with their key's summary; NULL keys and NULL times are keys like any other."""
    renamed = summary.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = [rows[k].eqNullSafe(renamed[f"_of_{k}"]) for k in keys]
    return rows.join(renamed, reduce(and_, same)).drop(*[f"_of_{k}" for k in keys])


def neighbours(
    rows: DataFrame, keys: Sequence[str], ts: str, bucket: str | None = "day", carry: Sequence[str] = ()
) -> DataFrame:
    """Add ``prev_at``, ``next_at`` and ``first_at``: times of the same key.

    For each column in ``carry``, ``prev_<column>`` is its value in the previous
    row.  ``ts`` must be unique within a key.  Rows with a NULL in the key belong
    together; rows without time come before all others.
    """
    marked = _in_pieces(rows, keys, [F.col(ts)], ts, bucket)
    over_buckets = Window.partitionBy(*keys).orderBy(_BUCKET)
    whole_key = over_buckets.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    borders = (
        marked.groupBy(*keys, _BUCKET)
        .agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"), *[F.max_by(c, ts).alias(f"_end_{c}") for c in carry])
        .select(
            *keys,
            _BUCKET,
            F.lag("_hi").over(over_buckets).alias("_before"),
            F.lead("_lo").over(over_buckets).alias("_after"),
            F.min("_lo").over(whole_key).alias("first_at"),
            *[F.lag(f"_end_{c}").over(over_buckets).alias(f"_in_{c}") for c in carry],
        )
    )
    inside = Window.partitionBy(*keys, _BUCKET).orderBy(ts)
    stepped = marked.select(
        "*",
        F.lag(ts).over(inside).alias("_prev"),
        F.lead(ts).over(inside).alias("_next"),
        *[F.lag(c).over(inside).alias(f"_own_{c}") for c in carry],
    )
    return _join_summary(stepped, borders, [*keys, _BUCKET]).select(
        *rows.columns,
        F.coalesce("_prev", "_before").alias("prev_at"),
        F.coalesce("_next", "_after").alias("next_at"),
        "first_at",
        # the first row of a bucket has no row before it there
        *[F.when(F.col("_prev").isNull(), F.col(f"_in_{c}")).otherwise(F.col(f"_own_{c}")).alias(f"prev_{c}") for c in carry],
    )


def last_known(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    ts: str,
    values: Mapping[str, Column],
    bucket: str | None = "hour",
) -> DataFrame:
    """Add, per name in ``values``, the last non-NULL value up to this row.

    ``order`` must be total within a key and start with ``ts``.  Each value
    expression is NULL on rows that do not set it.
    """
    marked = _in_pieces(rows, keys, order, ts, bucket)
    for name, expression in values.items():
        marked = marked.withColumn(f"_set_{name}", expression)
    sort_key = F.struct(*order)
    earlier = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        marked.groupBy(*keys, _BUCKET)
        .agg(
            *[
                F.max_by(f"_set_{n}", F.when(F.col(f"_set_{n}").isNotNull(), sort_key)).alias(f"_end_{n}")
                for n in values
            ]
        )
        .select(
            *keys,
            _BUCKET,
            *[F.last(f"_end_{n}", ignorenulls=True).over(earlier).alias(f"_in_{n}") for n in values],
        )
    )
    inside = (
        Window.partitionBy(*keys, _BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    own = marked.select("*", *[F.last(f"_set_{n}", ignorenulls=True).over(inside).alias(f"_own_{n}") for n in values])
    return _join_summary(own, carried, [*keys, _BUCKET]).select(
        *rows.columns, *[F.coalesce(f"_own_{n}", f"_in_{n}").alias(n) for n in values]
    )
