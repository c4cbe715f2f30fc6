"""Reuse of stored explore answers.

A request is served by the newest stored answer with the same keywords, geo,
timeframe, category and property that is not older than the request's ttl.
The exact set of widgets is tried first, then the larger sets in the order
(related + regions), (related), (regions).  Keywords compare in lower case;
for a comparison their order counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .sequence import last_known

#: What has to be equal for an answer to serve a request.
ANSWER_KEY = ["kind", "keywords_lc", "geo", "timeframe", "category", "gprop"]

# Default ttls and the horizon after which stored answers go.
SHORT_TTL_SECONDS = 3600.0
LONG_TTL_SECONDS = 86400.0
RETENTION_SECONDS = 30 * 86400

# Fixed order in which stored widget sets are tried: (related, regions).
_WIDGETS = {"tt": (True, True), "tf": (True, False), "ft": (False, True), "ff": (False, False)}


def default_ttl(timeframe: Column) -> Column:
    """One hour for ``now ...`` timeframes, a day for all others."""
    return F.when(F.lower(F.trim(timeframe)).startswith("now "), SHORT_TTL_SECONDS).otherwise(LONG_TTL_SECONDS)


def keyword_key(keywords: Column) -> Column:
    return F.transform(keywords, F.lower)


def match_answers(requests: DataFrame, answers: DataFrame, bucket: str | None = None) -> DataFrame:
    """Every request with the stored answer that serves it, or NULLs.

    ``requests``: ``request_id``, the key columns with ``keywords``,
    ``want_related``, ``want_geo``, ``asked_at`` and optional ``ttl_seconds``.
    ``answers``: ``answer_id``, the key columns with ``keywords_lc``,
    ``has_related``, ``has_geo``, ``stored_at``.

    Requests and answers are put on one time line per key, and each request
    reads off the last answer of each widget set: rows stay linear in the
    input where a join would pair every request with every answer of its key.
    The lines are cut into ranges of equal size, or into time buckets by name.
    """
    flags = {name: (F.col("has_related") == r) & (F.col("has_geo") == g) for name, (r, g) in _WIDGETS.items()}
    stored = answers.select(
        *ANSWER_KEY,
        F.col("stored_at").alias("at"),
        F.lit(0).alias("is_request"),
        F.lit(None).cast("string").alias("request_id"),
        "answer_id",
        "has_related",
        "has_geo",
        *[F.lit(None).cast("boolean").alias(c) for c in ("want_related", "want_geo")],
        F.lit(None).cast("double").alias("ttl_seconds"),
    )
    ttl = default_ttl(F.col("timeframe"))
    if "ttl_seconds" in requests.columns:
        ttl = F.coalesce(F.col("ttl_seconds"), ttl)
    asked = requests.withColumn("keywords_lc", keyword_key(F.col("keywords"))).select(
        *ANSWER_KEY,
        F.col("asked_at").alias("at"),
        F.lit(1).alias("is_request"),
        F.col("request_id").cast("string").alias("request_id"),
        F.lit(None).cast(answers.schema["answer_id"].dataType).alias("answer_id"),
        *[F.lit(None).cast("boolean").alias(c) for c in ("has_related", "has_geo")],
        "want_related",
        "want_geo",
        ttl.cast("double").alias("ttl_seconds"),
    )
    # answers of the same instant sort before requests, so equality counts as stored
    order = [F.col("at"), F.col("is_request"), F.col("answer_id"), F.col("request_id")]
    entry = F.struct(F.col("at").alias("stored_at"), F.col("answer_id"))
    line = last_known(
        stored.unionByName(asked),
        ANSWER_KEY,
        order,
        "at",
        {name: F.when((F.col("is_request") == 0) & flag, entry) for name, flag in flags.items()},
        bucket,
    ).where(F.col("is_request") == 1)

    oldest = F.unix_micros("at") - (F.col("ttl_seconds") * 1_000_000).cast("bigint")

    def candidate(name: str) -> Column:
        related, geo = _WIDGETS[name]
        fresh = F.unix_micros(F.col(name)["stored_at"]) >= oldest
        exact = (F.col("want_related") == related) & (F.col("want_geo") == geo)
        wider = (F.lit(related) | ~F.col("want_related")) & (F.lit(geo) | ~F.col("want_geo"))
        # a stored comparison serves the same request only
        covers = exact | (wider & (F.col("kind") == "explore"))
        return F.when(
            covers & fresh,
            F.struct(
                F.col(name)["answer_id"].alias("answer_id"),
                F.col(name)["stored_at"].alias("stored_at"),
                exact.alias("is_exact"),
                (F.lit(related) & ~F.col("want_related")).alias("drops_related"),
                (F.lit(geo) & ~F.col("want_geo")).alias("drops_geo"),
            ),
        )

    options = {name: candidate(name) for name in _WIDGETS}
    exact_first = F.coalesce(*[F.when(c["is_exact"], c) for c in options.values()])
    return line.withColumn("hit", F.coalesce(exact_first, *[options[n] for n in ("tt", "tf", "ft")])).select(
        "request_id",
        *ANSWER_KEY,
        F.col("at").alias("asked_at"),
        "want_related",
        "want_geo",
        F.col("hit").isNotNull().alias("is_hit"),
        "hit.*",
    )


def reuse_stats(matches: DataFrame, answers: DataFrame) -> DataFrame:
    """One row: hits, misses, number of stored answers, hit rate in percent."""
    counted = matches.agg(
        F.count_if("is_hit").alias("hits"), F.count_if(~F.col("is_hit")).alias("misses")
    )
    total = F.col("hits") + F.col("misses")
    rate = F.when(total > 0, F.col("hits") * 100.0 / total).otherwise(F.lit(0.0))
    return counted.select(
        "hits",
        "misses",
        answers.agg(F.count(F.lit(1))).scalar().alias("size"),
        F.round(rate, 1).alias("hit_rate"),
    )


def compact_answers(answers: DataFrame, now: Column) -> DataFrame:
    """The newest answer per key and widget set, none older than 30 days.

    The horizon is fixed on purpose: the ttl belongs to each request, and a
    short one must not remove what a longer one may still use.
    """
    key = [*ANSWER_KEY, "has_related", "has_geo"]
    rest = [c for c in answers.columns if c not in key]
    fresh = F.col("stored_at") >= now - F.make_dt_interval(secs=F.lit(RETENTION_SECONDS))
    return (
        answers.where(fresh)
        .groupBy(*key)
        .agg(F.max_by(F.struct(*rest), F.struct("stored_at", "answer_id")).alias("_kept"))
        .select(*key, "_kept.*")
        .select(answers.columns)
    )
