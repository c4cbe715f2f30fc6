"""URL filter: rules first, then naive Bayes over the words that host and path are made of.

Names in urls are words written together.  A unigram model of the words on all pages
(outside tags) and of the hyphenated parts of hosts splits every run of letters by
Viterbi: each substring that is a word of the model meets its count by a join, and the best
chain of words is found run by run.  Runs are taken once each, however many urls hold them.

A multinomial naive Bayes model then scores host and path words.  It is fitted on labelled
urls.  Block: those that a rule blocks, without the words that the rule itself looks at, and
those whose host has one of ``seeds`` as a word.  Allow: all others.  Fitting takes at most
``sample`` labelled urls per class, the first by hash, with at most ``MAX_WORDS`` words each; so
the model is bounded and travels with the tasks.  Both classes weigh the same.  A url without a
rule is blocked if its log-odds reach ``margin``.

Urls are judged once per distinct host and path, numbers in paths set to 0.

Defined results: a null url or one without ``://`` has an empty host and path, fits no rule
and is allowed; runs of more than ``LONGEST`` letters are one word; rows that share an id are judged
one by one; without labelled urls of both classes the method allows.  Null ids stay null.  Other
columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from . import cells, counting

#: Letters of a DNS name; longer runs are no written-together words.
LONGEST = 63
LONGEST_WORD = 20
SAMPLE = 20_000
MAX_WORDS = 64
#: Blocked where the block class is nine times as likely.
MARGIN = math.log(9)
SEEDS = ("adult", "ads", "bets", "casino", "gambling", "pills", "poker", "porn", "spam", "track", "viagra", "xxx")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LETTERS = bytes(b for b in range(128) if not chr(b).isalpha()) + bytes(range(128, 256))


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"),
)


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a url."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Name and verdict of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<name: string, verdict: string, host: string, path: string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):  # a longer rule is asked before the shorter ones
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        fields = (("name", r.name), ("verdict", r.verdict), ("host", r.host), ("path", r.path))
        out = F.when(fits, F.struct(*[F.lit(v).alias(k) for k, v in fields])).otherwise(out)
    return out


def _page_words(batches):
    held = counting.Held()
    for batch in batches:
        for t in cells.texts_of(batch.column("html"), counting.CHUNK):
            # A byte is inside a tag if the last angle bracket before it in its text opens one.
            at = np.arange(len(t.data))
            opened = np.maximum.accumulate(np.where(t.data == 60, at, -1)) if len(at) else at
            closed = np.maximum.accumulate(np.where(t.data == 62, at, -1)) if len(at) else at
            starts, ends, text, one = t.words(_LETTERS, lower=True)
            seen = ~((opened[starts] > closed[starts]) & (opened[starts] >= t.at[text])) & (ends - starts <= LONGEST_WORD)
            starts, ends, one = starts[seen], ends[seen], one[seen]
            two = cells.span_hashes(counting.SECOND_LOWER[t.data], starts, ends)
            first, n = counting.distinct(one, two)
            raw = counting.lowered(t.data).tobytes()
            for a, b, k in zip(starts[first].tolist(), ends[first].tolist(), n.tolist()):
                held.counts[raw[a:b]] += k
            if held.over:
                yield _word_rows(held)
    if held.counts:
        yield _word_rows(held)


def _word_rows(held: counting.Held) -> pa.RecordBatch:
    rows = held.take()
    return pa.RecordBatch.from_arrays([counting.text_column([w for w, _ in rows]), pa.array([n for _, n in rows], pa.int64())], ["word", "n"])


def _runs(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit("[a-z]+"), F.lit(0))


def page_words(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """``word, n``: words of all pages outside tags, and of host names that hyphens split."""
    html = pages.select(F.col("html").cast("string")).mapInArrow(_page_words, "word string, n long")
    labels = hosts.select("urls", F.explode(F.split("host", r"\.")).alias("label")).filter(F.contains("label", F.lit("-")))
    split = labels.select(F.explode(_runs(F.col("label"))).alias("word"), F.col("urls").alias("n"))
    return html.union(split).groupBy("word").agg(F.sum("n").alias("n")).filter(F.length("word") <= LONGEST_WORD)


def _cheapest(size: int, total: float, known: dict[tuple[int, int], int]) -> list[int]:
    """Ends of the words into which a run of letters falls with the highest product of word probabilities.

    An unknown word of k letters counts as 10 / (total * 10**k); ties go to the longer last word.
    """
    best, back = [0.0] + [-math.inf] * size, [0] * (size + 1)
    for end in range(1, size + 1):
        for start in range(max(0, end - LONGEST_WORD), end):
            n = known.get((start, end - start))
            p = math.log(n / total) if n else math.log(10 / total) - (end - start) * math.log(10)
            if best[start] + p > best[end]:
                best[end], back[end] = best[start] + p, start
    out, end = [], size
    while end:
        out.append(end)
        end = back[end]
    return out[::-1]


def _split(total: float):
    def run(batches):
        for batch in batches:
            words = []
            for run, hits in zip(batch.column("run").to_pylist(), batch.column("hits").to_pylist()):
                ends = _cheapest(len(run), total, {(h["start"], h["size"]): h["n"] for h in hits or ()})
                words.append([run[a:b] for a, b in zip([0, *ends], ends)])
            yield pa.RecordBatch.from_arrays([batch.column("run"), pa.array(words, pa.list_(pa.string()))], ["run", "words"])

    return run


def segment(runs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``run, words`` for distinct runs of letters; their substrings meet the vocabulary by a join."""
    total = float(vocabulary.agg(F.sum("n")).first()[0] or 1)
    size = F.length("run")
    inner = runs.filter(size <= LONGEST).select("run", F.explode(F.sequence(F.lit(0), size - 1)).alias("start"))
    room = F.least(F.length("run") - F.col("start"), F.lit(LONGEST_WORD))
    subs = inner.select("run", "start", F.explode(F.sequence(F.lit(1), room)).alias("size")).withColumn(
        "word", F.substring("run", F.col("start") + 1, F.col("size"))
    )
    hits = subs.join(vocabulary, "word").groupBy("run").agg(F.collect_list(F.struct("start", "size", "n")).alias("hits"))
    short = runs.filter(size <= LONGEST).join(hits, "run", "left").mapInArrow(_split(total), "run string, words array<string>")
    return short.union(runs.filter(size > LONGEST).select("run", F.array("run")))


def bags(names: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``host, path, words``: words of distinct hosts and paths in order, marked by where they stand."""
    runs = names.select(
        "host", "path",
        F.posexplode(F.concat(
            F.transform(_runs(F.col("host")), lambda r: F.struct(F.lit("h").alias("kind"), r.alias("run"))),
            F.transform(_runs(F.col("path")), lambda r: F.struct(F.lit("p").alias("kind"), r.alias("run"))),
        )).alias("place", "r"),
    ).select("host", "path", "place", "r.kind", "r.run")
    words = segment(runs.select("run").distinct(), vocabulary)
    marked = runs.join(words, "run").select(
        "host", "path", "place", F.transform("words", lambda w: F.concat("kind", F.lit(":"), w)).alias("words")
    )
    held = marked.groupBy("host", "path").agg(F.sort_array(F.collect_list(F.struct("place", "words"))).alias("w"))
    return held.select("host", "path", F.flatten(F.col("w.words")).alias("words"))


@dataclass(frozen=True)
class Model:
    """Log-odds (block to allow) of a word; words never seen in fitting add nothing."""

    odds: dict[str, float]

    def score(self, words: Sequence[str]) -> float:
        return math.fsum(self.odds.get(w, 0.0) for w in words)


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Multinomial naive Bayes with add-one smoothing from ``words, block``, bounded by ``sample`` urls per class."""
    usable = labelled.filter(F.size("words").between(1, MAX_WORDS))
    few = [usable.filter(side).orderBy(F.xxhash64("words"), "words").limit(sample) for side in (F.col("block"), ~F.col("block"))]
    counted = few[0].union(few[1]).select("block", F.explode("words").alias("word")).groupBy("word").agg(
        F.count_if("block").alias("b"), F.count_if(~F.col("block")).alias("a")
    )
    rows = sorted((r.word, r.b, r.a) for r in counted.collect())  # at most 2 * sample * MAX_WORDS words
    block, allow = (sum(r[i] for r in rows) + len(rows) for i in (1, 2))
    if not any(r[1] for r in rows) or not any(r[2] for r in rows):
        return Model({})
    return Model({w: math.log((b + 1) / block) - math.log((a + 1) / allow) for w, b, a in rows})


def _score(model: Model):
    def run(batches):
        for batch in batches:
            scores = [model.score(w or ()) for w in batch.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), batch.column("path"), pa.array(scores, pa.float64())], ["k_host", "k_path", "score"]
            )

    return run


def _without_rule(rule: Column) -> Column:
    """``words`` without the ones the rule looks at."""
    used = F.concat(
        F.transform(_runs(rule["host"]), lambda r: F.concat(F.lit("h:"), r)),
        F.transform(_runs(rule["path"]), lambda r: F.concat(F.lit("p:"), r)),
    )
    return F.array_except("words", used)


def judge(
    pages: DataFrame, rules: Sequence[Rule] = RULES, seeds: Sequence[str] = SEEDS, sample: int = SAMPLE, margin: float = MARGIN
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, score`` (score: log-odds to block)."""
    spark = pages.sparkSession
    host, path = parts(F.col("url").cast("string"))
    named = pages.select(F.col("page_id").cast("long"), host.alias("host"), path.alias("path"))
    shape = F.regexp_replace("path", r"[0-9]+", "0")
    names = materialize(spark, named.groupBy("host", shape.alias("path")).agg(F.count("*").alias("urls")), "names")
    vocabulary = materialize(spark, page_words(pages, names), "page-words")
    found = materialize(spark, bags(names, vocabulary), "bags")
    seeded = F.arrays_overlap("words", F.array(*[F.lit(f"h:{s}") for s in seeds])) if seeds else F.lit(False)
    ruled = found.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("seeded", seeded)
    labelled = ruled.select(
        F.when(F.col("rule").isNull(), F.col("words")).otherwise(_without_rule(F.col("rule"))).alias("words"),
        F.coalesce(F.col("seeded") | (F.col("rule.verdict") == "block"), F.lit(False)).alias("block"),
    )
    model = fit(labelled, sample)
    scores = found.mapInArrow(_score(model), "k_host string, k_path string, score double")
    keyed = named.withColumn("shape", shape).join(scores, (F.col("host") == F.col("k_host")) & (F.col("shape") == F.col("k_path")), "left")
    rule, score = rule_of(F.col("host"), F.col("path"), rules), F.coalesce("score", F.lit(0.0))
    return keyed.select(
        "page_id", "host", "path", rule["name"].alias("rule"),
        F.coalesce(rule["verdict"], F.when(score >= margin, "block").otherwise("allow")).alias("verdict"), score.alias("score"),
    )
