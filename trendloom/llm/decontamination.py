"""Benchmark decontamination by a prefix-filtered join of item windows.

A window is ``width`` consecutive words of an item (a shorter item is one window).
The words of a window are ordered by rarity; a text that holds the window also holds
its rarest word at the same distance, so that word (the necessary prefix for full
containment) is what windows are joined on, together with its position, the window's
length and the hash of all its words, which confirms containment.

Documents are read once.  A task drops windows whose words or prefix cannot be any
item's by two filters of fixed size (``SLOTS`` counters, ``BITS`` bits): they only
save work, the join decides.  Nothing that grows with the benchmark or the corpus is
broadcast by this code.

Defined results: null and empty texts have no words and no hits; an item without
words is no item; rows that share a ``doc_id`` are judged one by one; items with one
``item_id`` are one item; a null ``item_id`` is not listed nor counted, but its
words count as hit.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from . import cells

WIDTH = 10
SLOTS = 1 << 16
BITS = 1 << 20


def _words(t: cells.Texts):
    _, _, text, words = t.words(cells.NON_ALNUM, lower=True)
    return text, words


def _prefixes(words: np.ndarray, width: int, counts: np.ndarray) -> np.ndarray:
    """The rarest word of every window, with its count in front: order and key in one."""
    rank = (np.minimum(counts[words & np.uint64(SLOTS - 1)], 0xFFFF).astype(np.uint64) << np.uint64(48)) | (
        words >> np.uint64(16)
    )
    n = len(words) - width + 1
    best = rank[:n].copy()
    for j in range(1, width):
        np.minimum(best, rank[j : j + n], out=best)
    return best


def _place(words: np.ndarray, at: np.ndarray, width: int, counts: np.ndarray, best: np.ndarray) -> np.ndarray:
    """Where in its window the rarest word stands first."""
    place = np.full(len(at), -1)
    for j in range(width):
        w = words[at + j]
        rank = (np.minimum(counts[w & np.uint64(SLOTS - 1)], 0xFFFF).astype(np.uint64) << np.uint64(48)) | (w >> np.uint64(16))
        place[(place < 0) & (rank == best)] = j
    return place


def _item_words(batches):
    for batch in batches:
        for t in cells.texts_of(batch.column("text")):
            text, words = _words(t)
            bounds = t.bounds(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id")[t.lo : t.lo + t.n], cells.lists(cells.signed(words), bounds, pa.int64())],
                ["item_id", "words"],
            )


def _item_windows(counts: np.ndarray, width: int):
    def run(batches):
        for batch in batches:
            rows = {"item_id": [], "width": [], "window": [], "prefix": [], "place": []}
            for item, words in zip(batch.column("item_id").to_pylist(), batch.column("words")):
                words = words.values.to_numpy(zero_copy_only=False).view(np.uint64)
                w = min(width, len(words))
                best = _prefixes(words, w, counts)
                hashes, first = np.unique(cells.window_hashes(words, w), return_index=True)
                rows["item_id"] += [item] * len(first)
                rows["width"] += [w] * len(first)
                rows["window"] += cells.signed(hashes).tolist()
                rows["prefix"] += cells.signed(best[first]).tolist()
                rows["place"] += _place(words, first, w, counts, best[first]).tolist()
            yield pa.RecordBatch.from_pydict(
                rows,
                pa.schema([("item_id", pa.string()), ("width", pa.int32()), ("window", pa.int64()),
                           ("prefix", pa.int64()), ("place", pa.int32())]),
            )

    return run


def _bits(slots) -> np.ndarray:
    out = np.zeros(BITS, bool)
    out[slots] = True
    return np.packbits(out)


def _candidates(counts: np.ndarray, known: np.ndarray, prefixes: np.ndarray, widths: list[int]):
    def run(batches):
        has_word, has_prefix = (np.unpackbits(x).astype(bool) for x in (known, prefixes))
        mask = np.uint64(BITS - 1)
        for batch in batches:
            for t in cells.texts_of(batch.column("text")):
                text, words = _words(t)
                seen = has_word[words & mask]
                found = []
                for w in widths:
                    n = len(words) - w + 1
                    if n <= 0:
                        continue
                    # Runs of known words: a window is one if as many were counted at its ends.
                    total = np.concatenate([[0], np.cumsum(seen)])
                    at = np.flatnonzero((total[w:] - total[:-w] == w) & (text[:n] == text[w - 1 :]))
                    if not len(at):
                        continue
                    best = _prefixes(words, w, counts)[at]
                    ok = has_prefix[cells.mix(best) & mask]
                    at, best = at[ok], best[ok]
                    place = _place(words, at, w, counts, best)
                    found.append((text[at], at, np.full(len(at), w), cells.window_hashes(words, w)[at], best, place))
                parts = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 6
                order = np.argsort(parts[0], kind="stable")
                parts = [x[order] for x in parts]
                first = t.bounds(text)
                parts[1] = parts[1] - first[parts[0]] if len(parts[0]) else parts[1]
                bounds = t.bounds(parts[0])
                kinds = {"at": pa.int32(), "width": pa.int32(), "window": pa.int64(), "prefix": pa.int64(), "place": pa.int32()}
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[t.lo : t.lo + t.n], pa.array(t.count(text))]
                    + [
                        cells.lists(cells.signed(x) if x.dtype == np.uint64 else x, bounds, k)
                        for x, k in zip(parts[1:], kinds.values())
                    ],
                    ["doc_id", "n_words", *kinds],
                )

    return run


def _hit_words(ats, widths):
    """Words under at least one window: each window adds what lies beyond the ones before it."""
    pairs = F.array_sort(F.collect_set(F.struct(ats.alias("at"), widths.alias("width"))))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def add(acc, x):
        end = x["at"] + x["width"]
        new = F.greatest(end - F.greatest(x["at"], acc["end"]), F.lit(0))
        return F.struct((acc["n"] + new).alias("n"), F.greatest(acc["end"], end).alias("end"))

    return F.aggregate(pairs, start, add, lambda acc: acc["n"].cast("long"))


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, item_ids, contaminated``."""
    spark = docs.sparkSession
    items = materialize(
        spark,
        benchmark.select(F.col("item_id").cast("string"), "text")
        .mapInArrow(_item_words, "item_id string, words array<long>").filter(F.size("words") > 0),
        "items",
    )
    word = items.select("item_id", F.explode(F.array_distinct("words")).alias("word"))
    slots = word.groupBy(F.col("word").bitwiseAND(SLOTS - 1).alias("slot")).agg(F.count("*").alias("n")).collect()
    counts = np.zeros(SLOTS, np.int64)
    counts[[r[0] for r in slots]] = [r[1] for r in slots]
    windows = materialize(
        spark,
        items.mapInArrow(
            _item_windows(counts, width), "item_id string, width int, window long, prefix long, place int"
        ),
        "windows",
    )
    known = [r[0] for r in word.select(F.col("word").bitwiseAND(BITS - 1)).distinct().collect()]
    widths = sorted(r[0] for r in windows.select("width").distinct().collect())
    prefix_slots = windows.select("prefix").mapInArrow(_prefix_slots, "slot long").distinct().collect()
    scan = _candidates(counts, _bits(known), _bits([r[0] for r in prefix_slots]), widths)
    found = materialize(
        spark,
        docs.select(F.col("doc_id").cast("long"), "text")
        .mapInArrow(
            scan,
            "doc_id long, n_words long, at array<int>, width array<int>, window array<long>, prefix array<long>, place array<int>",
        )
        .withColumn("row", F.monotonically_increasing_id()),
        "candidates",
    )
    keys = ["width", "window", "prefix", "place"]
    candidates = found.select("row", F.explode(F.arrays_zip("at", *keys)).alias("c")).select("row", "c.*")
    hits = candidates.join(windows, keys).groupBy(F.col("row").alias("r")).agg(
        _hit_words(F.col("at"), F.col("width")).alias("n_hit"), F.array_sort(F.collect_set("item_id")).alias("item_ids")
    )
    return (
        found.select("row", "doc_id", "n_words").join(hits, F.col("row") == F.col("r"), "left")
        .select(
            "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )


def _prefix_slots(batches):
    for batch in batches:
        prefix = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(cells.signed(cells.mix(prefix) & np.uint64(BITS - 1)))], ["slot"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Documents without any item window, with all their columns.

    A verdict depends on the text only, so rows are told apart by its 64-bit hash: rows without id and rows that
    share one are each judged by themselves.
    """
    key = F.xxhash64(docs["text"].cast("string"))
    keyed = docs.select(key.alias("doc_id"), "text")
    bad = contamination(keyed, benchmark, width).filter("contaminated").select(F.col("doc_id").alias("_bad_key")).distinct()
    return docs.join(bad, key == F.col("_bad_key"), "left_anti")
