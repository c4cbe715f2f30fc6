"""Quality rules: counts within a document, and lines that a whole host repeats.

Base counts come from one pass over the text.  The method's verdict is about
cross-document lines: every normalised line (lower-cased A-Z, words joined by one
space) is hashed, its distinct documents are counted per host, and common lines are
taken out: those in more than ``max_docs`` documents, however large the host is, and
in small hosts also those in ``share_docs`` documents or more that are more than
``max_share`` of the host's.  Documents with the same set of lines are copies of one document
and count once, so copies alone make no line common: they are for a
near-duplicate stage, which keeps one.  A document of which less than ``min_left`` of the
words, or less than ``min_words`` words, are left is rejected as depleted.

Documents are counted by (host, line, content), so a line that every document has spreads over
its documents and combines before its second shuffle.  The common lines of a host are at most its
lines / ``share_docs``; beyond what can be broadcast they are joined by a shuffle.

Defined results: null and empty texts have no words and fail the base rules; a
null host is a host of its own; rows that share a ``doc_id`` are judged one by
one.  Very long texts are read whole.  Other columns of the input are ignored.  An
empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from . import cells

SCHEMA = (
    "doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " lines array<long>, line_words array<long>"
)
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    min_words: int = 50
    max_repeat_percent: int = 50
    max_docs: int = 10
    max_share: float = 0.10
    share_docs: int = 5
    min_left: float = 0.30


def _scan(batches):
    symbol = np.zeros(256, bool)
    symbol[np.frombuffer(SYMBOLS, np.uint8)] = True
    for batch in batches:
        for t in cells.texts_of(batch.column("text")):
            starts, ends, text, raw = t.words(cells.SPACES, lower=False)
            lowered = t.words(cells.SPACES, lower=True)[3]
            # Characters are the bytes that do not continue one.
            chars = np.concatenate([[0], np.cumsum((t.data & 0xC0) != 0x80)])
            word_chars = np.bincount(text, chars[ends] - chars[starts], t.n).astype(np.int64)
            symbols = np.concatenate([[0], np.cumsum(symbol[t.data])])[t.at]

            windows = cells.window_hashes(raw, 3)
            own = text[: len(windows)] == text[2:] if len(windows) else np.zeros(0, bool)
            twice = np.zeros(len(text) + 2, bool)
            where = np.flatnonzero(own)
            hit = where[cells.repeated(cells.mix(windows[where] + text[where].astype(np.uint64)))]
            for j in range(3):
                twice[hit + j] = True

            breaks = np.flatnonzero(t.data == 10)
            line = np.searchsorted(breaks, starts)
            new = np.ones(len(starts), bool)
            new[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
            first = np.flatnonzero(new)
            after = np.append(first[1:], len(starts))
            l_text, l_no = text[first], line[first]
            edge = np.concatenate([[-1], breaks, [len(t.data)]])
            l_start = np.maximum(edge[l_no] + 1, t.at[l_text])
            l_end = np.minimum(edge[l_no + 1], t.at[l_text + 1])
            same = cells.mix(t.hashes(l_start, l_end) + l_text.astype(np.uint64))
            _, kinds = np.unique(same, return_index=True)
            dup_lines = t.count(l_text) - t.count(l_text[kinds])

            # Normalised lines, each once per document with all its words.
            norm = cells.span_hashes(lowered, first, after)
            order = np.lexsort((norm, l_text))
            norm, l_text, size = norm[order], l_text[order], (after - first)[order]
            head = np.ones(len(norm), bool)
            head[1:] = (norm[1:] != norm[:-1]) | (l_text[1:] != l_text[:-1])
            at = np.flatnonzero(head)
            size = np.add.reduceat(size, at) if len(at) else size
            bounds = t.bounds(l_text[at])
            rows = slice(t.lo, t.lo + t.n)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id")[rows], batch.column("host")[rows],
                    pa.array(t.count(text)), pa.array(word_chars), pa.array(np.diff(symbols).astype(np.int64)),
                    pa.array(dup_lines), pa.array(t.count(text[twice[: len(text)]])),
                    cells.lists(cells.signed(norm[at]), bounds, pa.int64()), cells.lists(size, bounds, pa.int64()),
                ],
                ["doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines", "line_words"],
            )


def judge(docs: DataFrame, limits: Limits = Limits(), host: str = "source") -> DataFrame:
    """One row per document: counts, ``base_failed``, words left after line removal, ``kept``."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.col(host).cast("string").alias("host"))
    stats = materialize(
        spark, rows.mapInArrow(_scan, SCHEMA).withColumn("row", F.monotonically_increasing_id()), "quality"
    )
    content = F.xxhash64("lines").alias("content")  # lines are distinct and in a fixed order
    hosts = stats.select("host", content).groupBy("host").agg(F.count_distinct("content").alias("host_docs"))
    lines = stats.select("row", "host", content, F.explode(F.arrays_zip("lines", "line_words")).alias("l")).select(
        "row", "host", "content", F.col("l.lines").alias("line"), F.col("l.line_words").alias("words")
    )
    common = materialize(
        spark,
        lines.groupBy("host", "line").agg(F.count_distinct("content").alias("docs"))
        .filter((F.col("docs") > limits.max_docs) | (F.col("docs") >= limits.share_docs)).alias("c")
        .join(hosts.alias("h"), F.col("c.host").eqNullSafe(F.col("h.host")))
        .filter((F.col("docs") > limits.max_docs) | (F.col("docs") > limits.max_share * F.col("host_docs")))
        .select(F.col("c.host").alias("c_host"), F.col("line").alias("c_line")),
        "common-lines",
    )
    removed = (
        lines.join(common, F.col("host").eqNullSafe(F.col("c_host")) & (F.col("line") == F.col("c_line")), "left_semi")
        .groupBy(F.col("row").alias("r"))
        .agg(F.sum("words").alias("common_words"), F.count("*").alias("n_common_lines"))
    )
    n = F.col("n_words")
    return (
        stats.drop("lines", "line_words").join(removed, F.col("row") == F.col("r"), "left")
        .withColumn("n_common_lines", F.coalesce("n_common_lines", F.lit(0)))
        .withColumn("words_left", n - F.coalesce("common_words", F.lit(0)))
        .withColumn("base_failed", (n < limits.min_words) | (100 * F.col("n_repeat_words") > limits.max_repeat_percent * n))
        .withColumn("depleted", (F.col("words_left") < limits.min_left * n) | (F.col("words_left") < limits.min_words))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            "n_common_lines", "words_left", "kept",
        )
    )


def keep_good(docs: DataFrame, limits: Limits = Limits(), host: str = "source") -> DataFrame:
    """The documents that the rules keep, with all their columns.

    A verdict depends on text and host only, so rows are told apart by these (64-bit hash): rows without id and
    rows that share one are each judged by themselves.
    """
    key = F.xxhash64(F.col("text").cast("string"), F.col(host).cast("string"))
    keyed = docs.select(key.alias("doc_id"), "text", F.col(host).alias("host"))
    bad = judge(keyed, limits, "host").filter(~F.col("kept")).select(F.col("doc_id").alias("_bad_key")).distinct()
    return docs.join(bad, key == F.col("_bad_key"), "left_anti")
