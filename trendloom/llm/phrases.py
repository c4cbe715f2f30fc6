"""Phrase collocations from a weighted de Bruijn graph of words.

Texts are cut into pieces and words.  A first pass counts words and pairs of neighbours by
their 64-bit hash, further ones triples of frequent pairs and so on below ``width`` words; those
that occur ``min_count`` times are kept as Bloom filters of fixed size.  A phrase over a rarer
one can be no candidate, so a gram ends before it, and a rarer word alone only adds to the
number of words.  The filters only save work: what they let through is counted exactly.

The last pass aggregates the longest grams: an edge of ``width`` words joins the nodes of
its first and its last ``width - 1`` words, and where a piece (or what can be frequent) ends
sooner, the shorter rest is counted as a piece's end.  All shorter counts come from these rows: a
phrase occurs as often as edges leave it (node flow) plus the piece ends that start with
it.  Counts combine inside tasks before the shuffle; the last pass has few tasks of several input splits each, as
most frequent grams stand in every split.

Cuts are scored with exact decimals.  A candidate inside a longer one that is as frequent is
dropped; as counts never grow with length, it is enough to look one word further.
Frequent edges along nodes with one edge in and one out are compacted to paths (``paths``),
which give the whole passage that a longest candidate belongs to.

Defined results: null and empty texts have no words; a null lang is ``und``; repeated rows
each count.  Other columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from . import cells, counting

WIDTH = 5
MIN_COUNT = 100
TOP = 2000
#: Bits of the filter of frequent pairs, and hashes per pair.
BITS = 1 << 24
PROBES = 3
#: Distinct words and pairs that a task holds before it passes them on.
PAIRS = 1 << 19
#: Bytes of whole texts looked at in one go, and distinct grams that a task holds.
CHUNK = 1 << 19
GRAMS = 200_000
#: Input splits that a task of the last pass looks at; a gram counts once per task before the shuffle.
SPLITS = 4
#: Words of a path's row.
SEGMENT = 1000

BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
_BREAK = np.zeros(256, bool)
_BREAK[np.frombuffer(BREAKS, np.uint8)] = True
_SCRAMBLE = cells.seeds(2, 13)


class Words:
    """Words of a chunk of texts, with the pairs that stand in one piece."""

    def __init__(self, t: cells.Texts, langs: list[str]):
        self.starts, self.ends, text, words = t.words(b" \t" + BREAKS, lower=True)
        codes = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(langs)}
        self.lang = np.array([codes[x] for x in langs], np.uint64)[text]
        self.text, self.data = text, t.data
        self.one = cells.mix(words + self.lang)
        breaks = np.concatenate([[0], np.cumsum(_BREAK[t.data])])
        #: Whether the next word follows in the same piece.
        self.joined = np.zeros(len(text), bool)
        if len(text):
            self.joined[:-1] = (text[1:] == text[:-1]) & (breaks[self.starts[1:]] == breaks[self.ends[:-1]])
        self.pair = _both(self.one)


def _both(keys: np.ndarray) -> np.ndarray:
    """A key for each key and the next one."""
    out = np.zeros(len(keys), np.uint64)
    out[:-1] = cells.mix(keys[:-1] * _SCRAMBLE[0] + keys[1:] * _SCRAMBLE[1])
    return out


def _langs(batch: pa.RecordBatch) -> list[str]:
    return ["und" if x is None else x for x in batch.column("lang").to_pylist()]


def _frequent_at(w: Words, filters: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """For 2 words and more: whether so many that may be frequent start here, and the keys of one word more."""
    keys, flags = w.pair, []
    for bits in filters:
        flag = flags[-1] & np.append(flags[-1][1:], False) if flags else w.joined
        flags.append(flag & _held_in(bits, keys))
        keys = _both(keys)
    return flags, keys


def _key_counts(filters: list[np.ndarray]):
    """Counts of words and pairs, or with filters of one word more than the last of them holds."""

    def merged(keys, counts):
        order = np.argsort(key := np.concatenate(keys))
        key, n = key[order], np.concatenate(counts)[order]
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        return key[head], np.add.reduceat(n, head)

    def run(batches):
        keys, counts, size = [], [], 0
        for batch in batches:
            langs = _langs(batch)
            for t in cells.texts_of(batch.column("text"), CHUNK):
                w = Words(t, langs[t.lo : t.lo + t.n])
                flags, some = _frequent_at(w, filters)
                if flags:
                    some = some[flags[-1] & np.append(flags[-1][1:], False)]
                else:
                    some = np.concatenate([w.one, some[w.joined]])
                key, n = np.unique(some, return_counts=True)
                keys.append(key)
                counts.append(n)
                size += len(key)
                if size > PAIRS:
                    key, n = merged(keys, counts)
                    if len(key) > PAIRS // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(cells.signed(key)), pa.array(n)], ["pair", "n"])
                        key, n = key[:0], n[:0]
                    keys, counts, size = [key], [n], len(key)
        if size:
            key, n = merged(keys, counts)
            yield pa.RecordBatch.from_arrays([pa.array(cells.signed(key)), pa.array(n)], ["pair", "n"])

    return run


def _probes(pair: np.ndarray) -> list[np.ndarray]:
    return [cells.mix(pair + np.uint64(j)) & np.uint64(BITS - 1) for j in range(PROBES)]


def _slots(batches):
    for batch in batches:
        pair = batch.column("pair").to_numpy(zero_copy_only=False).view(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(_probes(pair)).astype(np.int64))], ["slot"])


def _held_in(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    table = table.view(np.uint64)
    out = np.ones(len(keys), bool)
    for slot in _probes(keys):
        out &= (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) > 0
    return out


def frequent(docs: DataFrame, min_count: int, filters: list[np.ndarray]) -> np.ndarray:
    """A Bloom filter of ``BITS`` bits that holds every word and pair of words with ``min_count`` occurrences or more.

    With the ``filters`` for 2 to k words: one that holds all of k + 1 words.
    """
    keys = docs.mapInArrow(_key_counts(filters), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    slots = keys.filter(F.col("n") >= min_count).select("pair").mapInArrow(_slots, "slot long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("slot").bitwiseAND(63).cast("int"))
    held = slots.groupBy(F.shiftright("slot", 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(BITS // 64, np.int64)  # as many rows at most
    out[held.column("at").to_numpy()] = held.column("bits").to_numpy()
    return out


def _grams(filters: list[np.ndarray], width: int):
    def run(batches):
        held, rare = counting.Held(), Counter()
        for batch in batches:
            langs = _langs(batch)
            for t in cells.texts_of(batch.column("text"), CHUNK):
                own = langs[t.lo : t.lo + t.n]
                w = Words(t, own)
                n = len(w.text)
                flags, _ = _frequent_at(w, filters)
                size = 1 + sum(f.astype(np.int64) for f in flags)
                # Where the longest filtered ones follow each other, a gram goes on.
                ends = np.flatnonzero(~flags[-1])
                left = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n) if n else size
                size = np.minimum(np.where(left > 0, left + len(filters), size), width)
                two = cells.mix(cells.span_hashes(counting.SECOND_LOWER[t.data], w.starts, w.ends) + w.lang)
                usual = flags[0] | _held_in(filters[0], w.one)
                for text, c in zip(*(x.tolist() for x in np.unique(w.text[~usual], return_counts=True))):
                    rare[own[text]] += c
                at = np.flatnonzero(usual)
                key = [cells.span_hashes(x, at, at + size[at]) + size[at].astype(np.uint64) for x in (w.one, two)]
                first, counts = counting.distinct(*key)
                first = at[first]
                raw = counting.lowered(t.data).tobytes()
                starts, stops, text = w.starts.tolist(), w.ends.tolist(), w.text
                for i, k, c in zip(first.tolist(), size[first].tolist(), counts.tolist()):
                    gram = b" ".join([raw[starts[j] : stops[j]] for j in range(i, i + k)])
                    held.counts[own[text[i]], gram, k] += c
                if len(held.counts) > GRAMS:
                    yield _gram_rows(held.take())
        yield _gram_rows(held.take() + [((lang, b"", 0), n) for lang, n in rare.items()])

    return run


def _gram_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k, _ in rows], pa.string()), counting.text_column([k[1] for k, _ in rows]),
         pa.array([k[2] for k, _ in rows], pa.int32()), pa.array([n for _, n in rows], pa.int64())],
        ["lang", "gram", "size", "w"],
    )


def _shares(rows: DataFrame) -> DataFrame:
    """The same rows in fewer tasks, ``SPLITS`` input splits each, but in two tasks per core at least."""
    return rows.coalesce(max(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-rows.rdd.getNumPartitions() // SPLITS)))


def longest_grams(docs: DataFrame, min_count: int = MIN_COUNT, width: int = WIDTH) -> DataFrame:
    """``lang, gram, size, w``: edges of ``width`` words, and shorter rests where a piece or a chain of frequent pairs ends.

    Every word starts exactly one row's occurrence; rare words that start nothing else are summed up as size 0.
    """
    rows = docs.select(F.col("text").cast("string"), F.col("lang").cast("string"))
    filters: list[np.ndarray] = []
    for _ in range(2, max(3, width)):
        filters.append(frequent(rows, min_count, filters))
    counted = _shares(rows).mapInArrow(_grams(filters, width), "lang string, gram string, size int, w long")
    return counted.groupBy("lang", "gram", "size").agg(F.sum("w").alias("w"))


def _first(text: str, n: Column) -> Column:
    """The first ``n`` words, or the last ``-n``."""
    return F.call_function("substring_index", F.col(text), F.lit(" "), n.cast("int"))


def flow(grams: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``lang, phrase, size, f`` of all phrases with ``min_count`` occurrences, from what starts with them."""
    starts = grams.filter(F.col("size") > 0).select("lang", "gram", "w", F.explode(F.sequence(F.lit(1), "size")).alias("size"))
    return (
        starts.groupBy("lang", _first("gram", F.col("size")).alias("phrase"), "size")
        .agg(F.sum("w").alias("f")).filter(F.col("f") >= min_count)
    )


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(19,0)")


def collocations(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates with their lowest cut: ``lang, phrase, size, a, l, r, n, score``; inner ones are dropped."""
    several = counts.filter(F.col("size") > 1)
    inner = several.filter(F.col("size") > 2)
    shorter = lambda keep: _first("phrase", keep * (F.col("size") - 1)).alias("phrase")
    sides = several.select("lang", "phrase", "size", F.col("f").alias("a"), F.lit(None).cast("long").alias("over"))
    for keep in (1, -1):
        sides = sides.union(inner.select("lang", shorter(keep), F.col("size") - 1, F.lit(None).cast("long"), F.col("f")))
    open_ = (
        sides.groupBy("lang", "phrase", "size").agg(F.max("a").alias("a"), F.max("over").alias("over"))
        .filter(F.col("over").isNull() | (F.col("over") < F.col("a"))).drop("over")
    )
    cut = open_.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cut = cut.withColumn("left", _first("phrase", F.col("k"))).withColumn(
        "right", _first("phrase", F.col("k") - F.col("size"))
    )
    part = lambda name, value: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(value))
    scored = (
        cut.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
        .join(totals.withColumnRenamed("lang", "t_lang"), F.col("lang") == F.col("t_lang"))
        .withColumns({f"_{c}": _exact(c) for c in ("a", "l", "r", "n")})
        .withColumn("score", F.expr("(cast(1000 as decimal(4, 0)) * _a * _n) div (_l * _r)"))
    )
    least = F.min(F.struct("score", "k", "l", "r")).alias("c")
    return scored.groupBy("lang", "phrase", "size").agg(F.any_value("a").alias("a"), F.any_value("n").alias("n"), least).select(
        "lang", "phrase", "size", "a", "c.l", "c.r", "n", "c.score"
    )


def paths(edges: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Frequent edges compacted along nodes with one edge in and one out: ``lang, gram, head, place, path``.

    Edges find the first edge of their path by doubling links.  Edges on a closed
    ring have none and stay alone.  ``place`` counts edges from the head; ``path`` is the text of the
    edge's segment of at most ``segment`` edges.
    """
    spark = edges.sparkSession
    last = F.element_at(F.split("gram", " "), -1)
    ends = materialize(
        spark,
        edges.select(
            "lang", "gram", _first("gram", F.col("size") - 1).alias("out_of"),
            _first("gram", 1 - F.col("size")).alias("into"),
        ),
        "edges",
    )
    out = ends.groupBy("lang", F.col("out_of").alias("node")).agg(F.count("*").alias("c"), F.min("gram").alias("gram"))
    into = ends.groupBy("lang", F.col("into").alias("node")).agg(F.count("*").alias("c"), F.min("gram").alias("before"))
    unary = into.filter("c = 1").drop("c").join(out.filter("c = 1").drop("c"), ["lang", "node"]).filter(F.col("gram") != F.col("before"))
    state = materialize(
        spark,
        ends.select("lang", "gram").join(unary.select("lang", "gram", "before"), ["lang", "gram"], "left").select(
            "lang", "gram", F.coalesce("before", "gram").alias("head"), F.col("before").isNotNull().cast("long").alias("place")
        ),
        "links",
    )
    total, rounds = state.count(), 0
    while 1 << rounds <= total:
        far = state.select("lang", F.col("gram").alias("head"), F.col("head").alias("then"), F.col("place").alias("more"))
        moved = materialize(spark, state.join(far, ["lang", "head"]).select("lang", "gram", "then", "place", "more"), "links")
        state = moved.select("lang", "gram", F.col("then").alias("head"), (F.col("place") + F.col("more")).alias("place"))
        rounds += 1
        if moved.filter(F.col("more") > 0).isEmpty():
            break
    ring = F.col("place") >= total  # walked round a ring
    done = state.select("lang", "gram", F.when(ring, F.col("gram")).otherwise(F.col("head")).alias("head"),
                        F.when(ring, F.lit(0)).otherwise(F.col("place")).alias("place"))
    done = done.withColumn("part", F.floor(F.col("place") / segment))
    steps = F.sort_array(F.collect_list(F.struct("place", last.alias("word"), "gram")))
    joined = done.groupBy("lang", "head", "part").agg(steps.alias("steps")).select(
        "lang", "head", "part",
        F.concat_ws(" ", F.col("steps")[0]["gram"], F.transform(F.slice("steps", 2, segment), lambda x: x["word"])).alias("path"),
    )
    return done.join(joined, ["lang", "head", "part"]).select("lang", "gram", "head", "place", "path")


def mine(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, width: int = WIDTH) -> DataFrame:
    """The best phrases of every lang: ``lang, rank, phrase, a, l, r, n, score, path``."""
    spark = docs.sparkSession
    grams = materialize(spark, longest_grams(docs, min_count, width), "grams")
    counts = materialize(spark, flow(grams, min_count), "phrases")
    totals = grams.groupBy("lang").agg(F.sum("w").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = collocations(counts, totals).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    whole = paths(counts.filter(F.col("size") == width).select("lang", F.col("phrase").alias("gram"), "size"))
    whole = whole.select("lang", F.col("gram").alias("phrase"), "path")
    return best.join(whole, ["lang", "phrase"], "left").select(
        "lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", F.col("score").cast("long"), "path"
    )
