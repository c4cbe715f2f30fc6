"""Secret scans: three fixed patterns, and character Markov models, with DataFrame functions only.

The patterns (assigned values, access keys, long hex strings) give the base spans.  The
method adds tokens that read more like random strings than like ordinary identifiers:
two first-order Markov models of characters are trained on labelled samples, and a
token's score is the mean log-likelihood ratio of its transitions, so that length alone
makes no token a secret.

Samples: values found by the patterns and seeded random strings of five alphabets (so that
no alphabet is unknown because no pattern asks for it) are labelled as secret; other tokens
of a bounded number of documents and seeded names, times and numbers are labelled as
ordinary.  The bounds are parameters (``MAX_SECRETS`` values, ``SEEDS`` made samples of each
form, ``SAMPLE_DOCS`` documents, chosen by hash); a caller may pass its own labelled table.
The model itself is a table of ``len(ALPHABET)`` squared weights, a constant of the plan.

Positions come from gaps: the pieces between the matches of a pattern and the matches
themselves have lengths that add up, per document and pattern, over small rows.

Defined results: null and empty texts have no spans; positions are code points, the end
exclusive; an added span that overlaps a base span is left out; rows that share id and
text have one result each; other columns are ignored.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import materialize

# Kinds in their order, with their patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ["assign", "access", "hex", "random"]

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-"
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
TOKEN = r"[A-Za-z0-9+/_=-]{8,}"
MAX_SECRETS = 20_000
SAMPLE_DOCS = 2_000
SEEDS = 2_000
# Words of made identifiers.
NAME_WORDS = (
    "access account action address agent archive array backup batch block buffer build bytes cache client cluster code column"
    " config connection content context control count create current data database date default device directory document"
    " driver element engine error event exception factory field file filter format function group handler header history host"
    " image index input instance interface item label language length library limit list load local logger manager map master"
    " message method model module name network node number object option order output package page parameter parent parser"
    " path pattern payload pool port process profile project property proxy public query queue random range record region"
    " remote report request resource response result return root sample schema script search segment sequence server service"
    " session setting shared signal size source stack start state status storage stream string structure system table target"
    " task template test text thread time timeout token total trace transaction type unit update user utility value vector"
    " version view virtual widget window worker write"
).split()
#: Natural log of the likelihood ratio per transition: held-out random strings reach 2 to 7, names and numbers stay below 0.
MIN_SCORE = 1.5
#: Weight of the single-character model in each character's transitions.
BACKOFF = 8.0


def _row() -> Column:
    return F.concat_ws("-", F.col("doc_id").cast("string"), F.xxhash64("text").cast("string"))


def _found(kind: int, pattern: str, least: int, group: int = 0) -> Column:
    """All matches of one kind in order: length of the gap before, length, value, and whether it counts."""
    text = F.col("text")
    pairs = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("all"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    matches = F.transform(
        F.filter(pairs, lambda m: m["all"].isNotNull()),
        lambda m, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), F.length(m["gap"]).alias("gap"), F.length(m["all"]).alias("len"),
            m["value"].alias("value"), (F.length(m["value"]) >= least).alias("ok"),
        ),
    )
    return F.when(text.rlike(pattern), matches)


def _matches(docs: DataFrame) -> DataFrame:
    """Small rows of all matches and candidates; the hex pattern can ask for its length at once, as runs are whole."""
    kinds = [_found(0, ASSIGN, 6, 2), _found(1, ACCESS, 20), _found(2, HEX[:-1] + "{24,}", 24), _found(3, CANDIDATE, 16)]
    some = F.flatten(F.array(*[F.coalesce(k, F.expr("filter(array(struct(0 AS kind, 0 AS i, 0 AS gap, 0 AS len, '' AS value, false AS ok)), x -> false)")) for k in kinds]))
    return docs.select(_row().alias("row"), F.explode(some).alias("m")).select("row", "m.*")


def random_strings(spark: SparkSession, seeds: int = SEEDS) -> DataFrame:
    """``token``: 40 characters of each seed's digest in lower and upper hex digits, base 64, letters and digits, capitals and digits."""
    digest = F.sha2(F.col("id").cast("string"), 256)
    base64 = F.base64(F.unhex(digest))
    letters = F.translate(base64, "+/=", "")
    forms = F.array(*[F.substring(x, 1, 40) for x in (digest, F.upper(digest), base64, letters, F.upper(letters))])
    return spark.range(seeds).select(F.explode(forms).alias("token"))


def made_names(spark: SparkSession, seeds: int = SEEDS) -> DataFrame:
    """``token``: names of four words in five styles, times with a word, and numbers, by the seed's digest."""
    words = F.array(*map(F.lit, NAME_WORDS))
    number = lambda i: F.conv(F.substring("digest", 8 * i + 1, 7), 16, 10).cast("long")
    word = [F.element_at(words, (number(i) % len(NAME_WORDS) + 1).cast("int")) for i in range(4)]
    title = F.concat(*map(F.initcap, word))
    # Dates and times are digits of the same number, so that no calendar or time zone decides.
    two = lambda i, n, low=0: F.lpad((number(i) % n + low).cast("string"), 2, "0")
    time = F.concat(F.lit("20"), two(4, 30), F.lit("-"), two(5, 12, 1), F.lit("-"), two(6, 28, 1), F.lit("T"), two(7, 24), F.lit("-"), two(0, 60))
    forms = F.array(
        F.concat_ws("_", *word), F.concat_ws("-", *word), F.concat_ws("/", *word), title, F.upper(F.concat_ws("_", *word)),
        F.concat_ws("_", time, word[0], (number(1) % 10_000).cast("string")),
        F.concat(number(2).cast("string"), number(3).cast("string")),
    )
    digests = spark.range(seeds).select(F.sha2(F.concat(F.lit("name"), F.col("id").cast("string")), 256).alias("digest"))
    return digests.select(F.explode(forms).alias("token"))


def labelled_samples(docs: DataFrame, matches: DataFrame) -> DataFrame:
    """``token, secret``: pattern values and random strings; made names, and other tokens of a bounded number of documents."""
    secrets = (
        matches.filter("kind < 3 and ok").select(F.col("value").alias("token")).distinct()
        .orderBy(F.xxhash64("token"), "token").limit(MAX_SECRETS)
    )
    ids = docs.select("doc_id").filter("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    other = docs.join(ids.select(F.col("doc_id").alias("s_id")).distinct(), F.col("doc_id") == F.col("s_id"), "left_semi").select(
        F.explode(F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0))).alias("token")
    )
    ordinary = other.join(secrets, "token", "left_anti")
    known = secrets.union(random_strings(docs.sparkSession))
    names = ordinary.union(made_names(docs.sparkSession))
    return known.select("token", F.lit(1).alias("secret")).union(names.select("token", F.lit(0).alias("secret")))


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios of all transitions, in alphabet order; rare transitions lean on single characters."""
    n = len(ALPHABET)
    pairs = samples.select("secret", "token", F.explode(F.expr("sequence(1, length(token) - 1)")).alias("i")).select(
        "secret",
        F.instr(F.lit(ALPHABET), F.substr("token", F.col("i"), F.lit(1))).alias("a"),
        F.instr(F.lit(ALPHABET), F.substr("token", F.col("i") + 1, F.lit(1))).alias("b"),
    )
    counts = pairs.filter("a > 0 and b > 0").groupBy("secret", "a", "b").agg(F.count("*").alias("n")).collect()
    logs = []
    for label in (1, 0):
        table = [[0.0] * n for _ in range(n)]
        for r in counts:
            if r.secret == label:
                table[r.a - 1][r.b - 1] = float(r.n)
        total = sum(map(sum, table)) + 0.5 * n
        single = [(sum(row[b] for row in table) + 0.5) / total for b in range(n)]
        logs.append([
            math.log((row[b] + BACKOFF * single[b]) / (sum(row) + BACKOFF)) for row in table for b in range(n)
        ])
    return [x - y for x, y in zip(*logs)]


def score(token: Column, weights: list[float]) -> Column:
    """How much likelier a token's transitions are in random strings (natural log, mean per transition)."""
    table = F.from_json(F.lit(json.dumps([round(w, 6) for w in weights])), "array<double>")
    at = lambda i: F.instr(F.lit(ALPHABET), F.substr(token, i, F.lit(1)))
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(token) - 1), F.lit(0.0),
        lambda acc, i: acc + F.coalesce(F.get(table, (at(i) - 1) * len(ALPHABET) + at(i + 1) - 1), F.lit(0.0)),
    )
    return total / (F.length(token) - 1)


def scan(docs: DataFrame, samples: DataFrame | None = None, min_score: float = MIN_SCORE) -> DataFrame:
    """One row per document: counts per kind, base spans and all spans as ``kind:start:end`` lists."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    matches = materialize(spark, _matches(docs), "matches").distinct()
    weights = train(samples if samples is not None else labelled_samples(docs, materialize(spark, matches, "samples")))
    run = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        matches.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(run))
        .withColumn("start", F.col("end") - F.col("len"))
        .filter(F.col("ok") & ((F.col("kind") < 3) | (score(F.col("value"), weights) >= min_score)))
        .select("row", "kind", "start", "end")
    )
    base = F.col("kind") < 3
    earlier = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(1, Window.unboundedFollowing)
    spans = (
        placed.withColumn("reach", F.max(F.when(base, F.col("end"))).over(earlier))
        .withColumn("next", F.min(F.when(base, F.col("start"))).over(later))
        .filter(base | ~(F.coalesce(F.col("reach") > F.col("start"), F.lit(False)) | F.coalesce(F.col("next") < F.col("end"), F.lit(False))))
    )
    count = lambda k: F.sum((F.col("kind") == k).cast("long"))
    joined = lambda col: F.concat_ws(",", F.transform(F.array_sort(col), lambda s: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))
    span = F.struct("start", "kind", "end")
    per = spans.groupBy(F.col("row").alias("r")).agg(
        *[count(k).alias(f"n_{KINDS[k]}") for k in range(4)], joined(F.collect_list(F.when(base, span))).alias("base_spans"),
        joined(F.collect_list(span)).alias("spans"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return docs.select("doc_id", _row().alias("row")).join(per, F.col("row") == F.col("r"), "left").select(
        "doc_id", *[zero(f"n_{k}") for k in KINDS], text("base_spans"), text("spans")
    )
