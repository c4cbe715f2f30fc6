"""Reports over raw and normalized trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import strip
from ..schemas import SNAPSHOT_KEY
from ..sources.dims import PERIOD_HOURS, SORT_OPTIONS

# Volume limits of the bands, outlets that count as verification,
# words that classify a headline.
HIGH_VOLUME = 500
MODERATE_VOLUME = 200
TRUSTED_SOURCES = ("CNN", "BBC", "Reuters", "AP", "NPR", "Bloomberg")
BREAKING_WORD = "breaking"
UPDATE_WORD = "update"


def traffic_distribution(raw: DataFrame) -> DataFrame:
    return raw.groupBy("traffic").agg(F.count(F.lit(1)).alias("trend_count"))


def coverage(raw: DataFrame, many: int = 3) -> DataFrame:
    """Mean and largest article count, number of trends with ``many`` or more."""
    articles = F.size("news_articles")
    return raw.agg(
        F.avg(articles).alias("mean_articles"),
        F.max(articles).alias("max_articles"),
        F.count_if(articles >= many).alias("well_covered"),
    )


def high_traffic(raw: DataFrame, minimum: int = MODERATE_VOLUME, n: int = 5) -> DataFrame:
    """The ``n`` largest trends of at least ``minimum`` searches."""
    return (
        raw.where(F.col("traffic_min") >= minimum)
        .select("geo", "fetched_at", "trend", "traffic", "traffic_min",
                F.try_element_at("news_articles", F.lit(1))["headline"].alias("top_article_headline"))
        .orderBy(F.desc("traffic_min"), "geo", "fetched_at", "trend")
        .limit(n)
    )


def traffic_band(volume: Column) -> Column:
    return F.when(volume >= HIGH_VOLUME, "high").when(volume >= MODERATE_VOLUME, "moderate").otherwise("low")


def story_report(raw: DataFrame, trusted: Sequence[str] = TRUSTED_SOURCES, top: int | None = None) -> DataFrame:
    """Band, verification and story angle per trend.

    The band needs a ``+`` in the volume text.  Verified means that one of the
    first five articles comes from a trusted outlet; the angle looks at the
    first three headlines.  Both are NULL for a trend without articles.
    """
    if top is not None:
        raw = raw.where(F.col("rank") <= top)
    covered = F.size("news_articles") > 0
    sources = F.array_distinct(F.transform(F.slice("news_articles", 1, 5), lambda a: a["source"]))
    confirmed = F.array_sort(F.array_intersect(sources, F.lit(list(trusted))))
    heads = F.transform(F.slice("news_articles", 1, 3), lambda a: F.lower(F.coalesce(a["headline"], F.lit(""))))

    def mentions(word: str) -> Column:
        return F.exists(heads, lambda h: F.contains(h, F.lit(word)))

    angle = F.when(mentions(BREAKING_WORD), "breaking").when(mentions(UPDATE_WORD), "developing").otherwise("feature")
    return raw.select(
        "geo",
        "fetched_at",
        "rank",
        "trend",
        F.when(F.contains("traffic", F.lit("+")), traffic_band(F.col("traffic_min"))).alias("traffic_band"),
        F.when(covered, F.size(sources)).alias("source_count"),
        F.when(covered, F.array_join(confirmed, ",")).alias("confirmed_by"),
        F.when(covered, F.size(confirmed) > 0).alias("is_verified"),
        F.when(covered, angle).alias("story_angle"),
        F.coalesce(F.length("image.url") > 0, F.lit(False)).alias("has_image"),
    )


def filter_export(
    rows: DataFrame,
    hours: int = 24,
    category: str = "all",
    active_only: bool = False,
    as_of=None,
) -> DataFrame:
    """Normalized export trends started in the last ``hours`` before ``as_of``.

    ``as_of`` defaults to each row's own ``fetched_at``.  Other categories than
    ``all`` need a ``category`` column, as :func:`sources.export` provides.
    """
    if hours not in PERIOD_HOURS:
        raise ValueError(f"hours must be one of {PERIOD_HOURS}, got {hours}")
    until = F.col("fetched_at") if as_of is None else as_of
    since = until - F.make_dt_interval(hours=F.lit(hours))
    kept = rows.where((F.col("started_at") >= since) & (F.col("started_at") <= until))
    if category.lower() != "all":
        kept = kept.where(F.col("category") == category.lower())
    return kept.where("is_active") if active_only else kept


def _sort_order(by: str) -> list[Column]:
    if by not in SORT_OPTIONS:
        raise ValueError(f"sort must be one of {SORT_OPTIONS}, got {by!r}")
    order = {
        "relevance": F.col("rank").asc(),
        "title": F.col("keyword").asc(),
        "volume": F.desc("volume_min"),
        "recency": F.desc_nulls_last("started_at"),
    }[by]
    return [order, F.col("rank").asc()]


def sort_trends(trends: DataFrame, by: str = "relevance") -> DataFrame:
    """Trends of each snapshot by relevance, title, volume or recency."""
    return trends.orderBy("source", "geo", "fetched_at", *_sort_order(by))


def sort_places(trends: DataFrame, options: Sequence[str] = SORT_OPTIONS, keys: Sequence[str] = SNAPSHOT_KEY) -> DataFrame:
    """Trends with ``by_<option>``: their place in the snapshot under each sort.

    All options share one shuffle by snapshot; ties go by rank.  Exports of one
    geo and second that differ in category are told apart by naming it in ``keys``.
    """
    return trends.select(
        "*", *[F.row_number().over(Window.partitionBy(*keys).orderBy(*_sort_order(o))).alias(f"by_{o}") for o in options]
    )


def top_export_rows(raw: DataFrame, n: int = 10, terms: int = 3) -> DataFrame:
    """The first ``n`` rows of each export with their first breakdown terms."""
    first = F.slice(F.split(F.coalesce("`Trend breakdown`", F.lit("")), ","), 1, terms)
    return raw.where(F.col("rank") <= n).select(
        "geo",
        "fetched_at",
        "rank",
        F.col("Trends").alias("keyword"),
        F.col("`Search volume`").alias("volume_text"),
        F.array_join(F.filter(F.transform(first, strip), lambda t: F.length(t) > 0), "|").alias("terms"),
    )
