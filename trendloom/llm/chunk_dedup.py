"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes (each step shifts the hash and adds a number for the
byte, so it knows the last 32 bytes).  A chunk ends where the hash is larger than at all
of the ``reach`` positions on either side.  Such an end depends on its surroundings only:
after an insertion the same chunks come back within a few dozen bytes, and chunks are
longer than ``reach`` bytes.  Where a text gives no end for ``MAX`` bytes (one letter
repeated), chunks end every ``MAX`` bytes.  Ends move to the next character start.

A chunk is removed if a document with a smaller id has a chunk of the same 128-bit
digest, or if the document itself had it before.

Only the smallest id per digest is sought, which combines before the shuffle, so a chunk
of every document costs one row per task; the answer has one row per digest, and Spark's
skew join may split the documents' side.

Defined results: null and empty texts have no chunks; rows that share an id are one
document, so they take nothing from each other; a null id counts as larger than every
id; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from . import cells

REACH = 24
MAX = 1024
LAST = np.iinfo(np.int64).max
_GEAR = (cells.seeds(256, 51) >> np.uint64(32)).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash at every byte, by doubling the number of bytes it knows."""
    h, known = _GEAR[data], 1
    while known < 32:
        more = h.copy()
        more[known:] += h[:-known] << np.uint32(known)
        h, known = more, known * 2
    return h


def _largest(h: np.ndarray, reach: int) -> np.ndarray:
    """The largest of the ``reach`` values before each position; short at the front."""
    out = np.zeros(len(h), h.dtype)
    window, width = h, 1
    while width < reach:
        step = min(width, reach - width)
        window = np.maximum(window[:-step], window[step:]) if len(window) > step else window[:0]
        width += step
    out[reach:] = window[: max(0, len(h) - reach)]
    return out


def chunk_ends(t: cells.Texts, reach: int = REACH) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and ends of all chunks; every text's last chunk ends with it."""
    n = len(t.data)
    h = gear(t.data)
    inside = t.text_of(np.arange(n)) if n else np.zeros(0, np.int64)
    offset, rest = np.arange(n) - t.at[inside], t.at[inside + 1] - np.arange(n) - 1
    # The rolling hash and both sides must lie within the text.
    ok = (offset >= reach + 31) & (rest >= reach)
    ok &= (h > _largest(h, reach)) & (h > _largest(h[::-1], reach)[::-1])
    ends = np.flatnonzero(ok) + 1
    lead = (t.data & 0xC0) != 0x80
    for _ in range(3):
        ends = ends + ~lead[np.minimum(ends, n - 1)] if n else ends
    ends = np.union1d(ends, t.at[1:][np.diff(t.at) > 0])
    start = np.concatenate([[0], ends[:-1]])
    long = np.flatnonzero(ends - start > MAX)
    if len(long):
        more = np.concatenate([np.arange(start[i] + MAX, ends[i], MAX) for i in long])
        for _ in range(3):
            more = more + ~lead[more]
        ends = np.union1d(ends, more)
    return t.text_of(ends - 1), ends


def _digests(t: cells.Texts, reach: int):
    text, ends = chunk_ends(t, reach)
    start = np.concatenate([[0], ends[:-1]])
    high = t.hashes(start, ends)
    low = cells.span_hashes(cells.seeds(256, 61)[t.data], start, ends) + (ends - start).astype(np.uint64)
    return text, start, ends, high, low


def _scan(reach: int):
    def run(batches):
        for batch in batches:
            for t in cells.texts_of(batch.column("text")):
                text, _, _, high, low = _digests(t, reach)
                order = np.lexsort((low, high, text))
                text, high, low = text[order], high[order], low[order]
                new = np.ones(len(text), bool)
                new[1:] = (text[1:] != text[:-1]) | (high[1:] != high[:-1]) | (low[1:] != low[:-1])
                bounds = t.bounds(text[new])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[t.lo : t.lo + t.n], cells.lists(cells.signed(high[new]), bounds, pa.int64()),
                     cells.lists(cells.signed(low[new]), bounds, pa.int64())],
                    ["id", "high", "low"],
                )

    return run


def _cut(reach: int):
    def run(batches):
        for batch in batches:
            for t in cells.texts_of(batch.column("text")):
                text, start, ends, high, low = _digests(t, reach)
                gone = np.ones(len(text), bool)
                key = cells.mix(high ^ cells.mix(low + text.astype(np.uint64)))
                gone[np.unique(key, return_index=True)[1]] = False  # repeats within the text
                for i, found in enumerate(batch.column("found")[t.lo : t.lo + t.n]):
                    if found.is_valid and len(found.values):
                        own = slice(*np.searchsorted(text, [i, i + 1]))
                        gone[own] |= np.isin(high[own], found.values.to_numpy(zero_copy_only=False).view(np.uint64))
                removed = np.repeat(gone, ends - start)
                head = gone.copy()
                head[1:] &= ~gone[:-1] | (text[1:] != text[:-1])
                size = ends - start
                total = np.bincount(text, size * gone, t.n).astype(np.int64)
                left = np.concatenate([[0], np.cumsum(np.diff(t.at) - total)]).astype(np.int32)
                kept = pa.Array.from_buffers(
                    pa.string(), t.n, [None, pa.py_buffer(left.tobytes()), pa.py_buffer(t.data[~removed].tobytes())]
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[t.lo : t.lo + t.n], pa.array(np.diff(t.at)), pa.array(t.count(text)),
                     pa.array(t.count(text[gone])), pa.array(total), pa.array(t.count(text[head])), kept],
                    ["doc_id", "n_bytes", "n_chunks", "n_removed_chunks", "n_removed", "n_spans", "kept"],
                )

    return run


def remove_chunks(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per document: counts of bytes, chunks, removed ones and runs, and ``kept`` (the remaining text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    known = docs.select(F.coalesce("doc_id", F.lit(int(LAST))).alias("doc_id"), "text")
    table = materialize(spark, known.mapInArrow(_scan(reach), "id long, high array<long>, low array<long>"), "chunks")
    chunks = table.select("id", F.explode(F.arrays_zip("high", "low")).alias("c")).select("id", "c.high", "c.low")
    shared = (
        chunks.groupBy("high", "low").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last")
        .select(F.col("high").alias("s_high"), F.col("low").alias("s_low"), "first")
    )
    found = (
        chunks.join(shared.hint("merge"), (F.col("high") == F.col("s_high")) & (F.col("low") == F.col("s_low")))
        .filter("first < id").groupBy(F.col("id").alias("f_id")).agg(F.collect_set("high").alias("found"))
    )
    # A document's found chunks are at most its own; no side of these joins is small by nature.
    both = docs.join(found.hint("merge"), F.coalesce("doc_id", F.lit(int(LAST))) == F.col("f_id"), "left")
    return both.select("doc_id", "text", "found").mapInArrow(
        _cut(reach),
        "doc_id long, n_bytes long, n_chunks long, n_removed_chunks long, n_removed long, n_spans long, kept string",
    )
