"""Checks of requests and of delivered data.

Request checks split a request table into accepted and rejected rows with a
reason instead of raising on the first bad one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import strip
from ..functions.times import export_timestamp
from ..schemas import EXPORT_COLUMNS
from ..sources.dims import GPROPS, PERIOD_HOURS

MAX_SUGGESTIONS = 5


def check_codes(
    requests: DataFrame,
    dim: DataFrame,
    column: str = "geo",
    upper: bool = True,
    prefix: int = 1,
) -> DataFrame:
    """Requests with ``code``, ``name``, ``is_valid`` and ``suggestions``.

    Codes compare after case folding.  A rejected code suggests up to five
    known codes with the same first letters, in the order of the dimension.

    ``dim(pos, code, name)`` must be a closed code list.  It is combined to one
    row per prefix; whether the two look-ups are broadcast is left to the size
    Spark sees.
    """
    fold = F.upper if upper else F.lower
    known = dim.select(F.col("code").alias("_code"), "name")
    near = dim.groupBy(F.substring("code", 1, prefix).alias("_prefix")).agg(
        F.slice(F.transform(F.array_sort(F.collect_list(F.struct("pos", "code"))), lambda e: e["code"]), 1, MAX_SUGGESTIONS)
        .alias("_near")
    )
    folded = requests.withColumn("code", fold(F.col(column)))
    long_enough = F.length("code") >= prefix
    return (
        folded.join(known, folded["code"] == known["_code"], "left")
        .join(near, F.when(F.col("_code").isNull() & long_enough, F.substring("code", 1, prefix)) == near["_prefix"], "left")
        .select(
            *requests.columns,
            "code",
            "name",
            F.col("_code").isNotNull().alias("is_valid"),
            F.coalesce("_near", F.array().cast("array<string>")).alias("suggestions"),
        )
    )


def check_categories(requests: DataFrame, dim: DataFrame, column: str = "category") -> DataFrame:
    """As :func:`check_codes` in lower case; suggestions share three letters."""
    return check_codes(requests, dim, column, upper=False, prefix=3)


def hours_ok(hours: Column) -> Column:
    return F.coalesce(hours.isin(list(PERIOD_HOURS)), F.lit(False))


def check_comparisons(requests: DataFrame) -> DataFrame:
    """Comparison requests with cleaned ``terms``, property and a ``reason``.

    Terms must be 2 to 5, non-empty, free of commas and distinct ignoring case;
    ``web`` reads as the empty property; a ttl must be positive.  ``reason`` is
    the first failed check, NULL for accepted requests.
    """
    terms = F.transform("keywords", strip)
    size = F.size("terms")
    gprop = F.when(F.col("gprop") == "web", "").otherwise(F.col("gprop"))
    ttl = F.col("ttl_seconds") if "ttl_seconds" in requests.columns else F.lit(None).cast("double")
    reason = (
        F.when(F.exists("terms", lambda t: F.coalesce(t, F.lit("")) == ""), "empty keyword")
        .when(F.exists("terms", lambda t: F.contains(t, F.lit(","))), "comma in keyword")
        .when(~size.between(2, 5), "needs 2 to 5 keywords")
        .when(F.size(F.array_distinct(F.transform("terms", F.lower))) < size, "duplicate keyword")
        .when(~F.coalesce(F.col("gprop").isin(list(GPROPS)), F.lit(False)), "unknown property")
        .when(ttl <= 0, "ttl must be positive")
    )
    return (
        requests.withColumn("terms", terms)
        .withColumn("gprop", gprop)
        .withColumn("reason", reason)
        .withColumn("is_valid", F.col("reason").isNull())
    )


# --- delivered data -----------------------------------------------------------


def _every(report: DataFrame, delivered: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """A report that also has what was delivered without any row: counts 0, not passed."""
    if delivered is None:
        return report
    named = delivered.select(*[F.col(k).alias(f"_of_{k}") for k in keys]).distinct()
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    empty = {name: F.lit(False) if kind == "boolean" else F.lit(0).cast(kind) for name, kind in report.dtypes if name not in keys}
    return named.join(report, same, "left").select(
        *[F.col(f"_of_{k}").alias(k) for k in keys], *[F.coalesce(name, value).alias(name) for name, value in empty.items()]
    )


def feed_quality(raw: DataFrame, snapshots: DataFrame | None = None) -> DataFrame:
    """Per feed snapshot: do volumes and dates parse, as they did when landed?

    A snapshot passes with one row or more, at least 90 % volumes above 0 and
    every date readable.  ``snapshots`` names all delivered ones, so that an
    empty feed fails instead of being left out.
    """
    n = F.count(F.lit(1))
    volumes = F.count_if(F.col("traffic_min") > 0)
    dates = F.count_if(F.col("published").isNotNull())
    report = raw.groupBy("geo", "fetched_at").agg(
        n.alias("row_count"),
        volumes.alias("volumes_ok"),
        dates.alias("dates_ok"),
        ((volumes * 10 >= n * 9) & (dates == n)).alias("passes"),
    )
    return _every(report, snapshots, ["geo", "fetched_at"])


def export_quality(raw: DataFrame, minimum: int = 100, snapshots: DataFrame | None = None) -> DataFrame:
    """Per export snapshot: enough rows, and every time text that is there parses."""
    started, ended = F.col("Started"), F.col("Ended")
    has_start, has_end = F.length(started) > 0, F.length(ended) > 0
    checked = raw.select(
        "geo",
        "fetched_at",
        F.coalesce(has_start, F.lit(False)).alias("s"),
        (F.coalesce(has_start, F.lit(False)) & export_timestamp(started).isNull()).alias("bad_s"),
        (F.coalesce(has_end, F.lit(False)) & export_timestamp(ended).isNull()).alias("bad_e"),
    )
    n, starts = F.count(F.lit(1)), F.count_if("s")
    bad_starts, bad_ends = F.count_if("bad_s"), F.count_if("bad_e")
    report = checked.groupBy("geo", "fetched_at").agg(
        n.alias("row_count"),
        starts.alias("started_count"),
        bad_starts.alias("bad_started"),
        bad_ends.alias("bad_ended"),
        ((n >= minimum) & (starts >= minimum) & (bad_starts == 0) & (bad_ends == 0)).alias("passes"),
    )
    return _every(report, snapshots, ["geo", "fetched_at"])


def missing_export_headers(columns) -> list[str]:
    """Expected export headers that a file does not have."""
    return [c for c in EXPORT_COLUMNS if c not in set(columns)]


def interest_quality(points: DataFrame, minimum: int = 40, answers: DataFrame | None = None) -> DataFrame:
    """Per answer: enough points, values within 0-100, dates there and in order.

    ``answers (answer_id, keyword)`` names all delivered ones, here and in the checks below.
    """
    n = F.count(F.lit(1))
    in_range = F.count_if(F.col("value").between(0, 100))
    dated = F.count_if(F.col("ts").isNotNull())
    ordered = F.coalesce(F.min_by("ts", "pos") < F.max_by("ts", "pos"), F.lit(False))
    report = points.groupBy("answer_id", "keyword").agg(
        n.alias("point_count"),
        in_range.alias("values_ok"),
        dated.alias("dates_ok"),
        ordered.alias("is_chronological"),
        ((n >= minimum) & (in_range == n) & (dated == n) & ordered).alias("passes"),
    )
    return _every(report, answers, ["answer_id", "keyword"])


def region_quality(regions: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """Per answer: at least one region, each with a code and a value within 0-100."""
    n = F.count(F.lit(1))
    good = F.count_if((F.length("geo_code") > 0) & F.col("value").between(0, 100))
    report = regions.groupBy("answer_id", "keyword").agg(
        n.alias("region_count"), good.alias("regions_ok"), ((n > 0) & (good == n)).alias("passes")
    )
    return _every(report, answers, ["answer_id", "keyword"])


def related_quality(related: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """Per answer: the top list must not be empty."""
    top = F.count_if(F.col("bucket") == "top")
    report = related.groupBy("answer_id", "keyword").agg(
        top.alias("top_count"),
        F.count_if(F.col("bucket") == "rising").alias("rising_count"),
        (top > 0).alias("passes"),
    )
    return _every(report, answers, ["answer_id", "keyword"])
