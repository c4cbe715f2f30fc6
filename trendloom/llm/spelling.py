"""Spelling variants: words one edit apart, found by dynamic programming over the sorted vocabulary.

Words are counted inside the tasks that read the texts, then by Spark.  Two words whose
edit matrix ends at one share everything outside the piece of the shorter word in which
they first differ.  So every word goes to a few buckets, each named by a length, a piece
of that length and what the word holds before and behind the piece: first halves and
second halves, and where a bucket holds more than ``LIMIT`` words, halves of these, down
to single letters.  Such a bucket of one letter has at most a few thousand words, so every
bucket is bounded, and each pair is found in exactly one: that of the piece where the two
words first differ.

A bucket is a sorted list.  The scan goes down its columns: neighbours with a common prefix
(adjacent LCP beyond the depth) are one range with one banded row of the edit matrix per
asking word, which all words of the range reuse; a range whose row has no cell of at most
one is skipped whole.  Only counts and the best partner leave a task, never the pairs.

Roots are found by doubling links, at most as often as a chain's length doubles; counts at
least double from a word to its form, so chains are short.

Defined results: null and empty texts have no words; a null id counts as an empty text in
the checksum; rows that share an id each count; very long runs are words like all others.
Other columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from . import cells, counting

MIN_LENGTH = 5
MIN_COUNT = 3
EVERY = 97
#: Words in a bucket beyond which it is cut; one letter between fixed ends allows fewer.
LIMIT = 10_000
#: Rows of the edit matrix held at once, and words scanned together.
ROWS = 1 << 21
WORDS = 20_000

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1)
_SHORT = 64


def _checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of every span, continued from the checksum ``before`` it."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    size, at = size[order], starts[order]
    state = before[order] ^ np.uint32(0xFFFFFFFF)
    long = int(np.searchsorted(-size, -_SHORT, "left"))  # those of _SHORT bytes and more come one by one
    for j in range(int(size[long]) if long < len(size) else 0):
        n = int(np.searchsorted(-size, -j, "left"))
        part = state[long:n]
        state[long:n] = _CRC[(part ^ data[at[long:n] + j]) & np.uint32(0xFF)] ^ (part >> np.uint32(8))
    state ^= np.uint32(0xFFFFFFFF)
    for i in range(long):
        state[i] = zlib.crc32(data[at[i] : at[i] + size[i]].tobytes(), int(before[order[i]]))
    out = np.empty_like(state)
    out[order] = state
    return out


def _runs(t: cells.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and code points of maximal runs of letters (A-Z, a-z and U+00C0 to U+00FF)."""
    lead = t.data == 0xC3  # the first of the two bytes of U+00C0 to U+00FF
    tail = np.zeros_like(lead)
    tail[1:] = lead[:-1]
    inside = _LETTER[t.data] | lead | tail
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begin = t.at[:-1][t.at[:-1] < t.at[1:]]
    first[begin] = inside[begin]
    last = inside.copy()
    last[:-1] &= first[1:] | ~inside[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    tails = np.concatenate([[0], np.cumsum(tail)])
    return starts, ends, ends - starts - (tails[ends] - tails[starts])


def _count(every: int, min_length: int):
    def run(batches):
        held = counting.Held()
        for batch in batches:
            ids = ["" if x is None else str(x) for x in batch.column("doc_id").to_pylist()]
            for t in cells.texts_of(batch.column("text"), counting.CHUNK):
                starts, ends, points = _runs(t)
                text, low = t.text_of(starts), counting.lowered(t.data)
                prefix = np.array([zlib.crc32(f"{x}:".encode()) for x in ids[t.lo : t.lo + t.n]], np.uint32)
                crc = _checksums(low, starts, ends, prefix[text])
                cut = crc % np.uint32(every) == 0
                for a, b, h, n in zip(*(x[cut].tolist() for x in (starts, ends, crc, points))):
                    if n > min_length:
                        word = low[a:b].tobytes().decode()
                        held.counts[(word[: h % n] + word[h % n + 1 :]).encode()] += 1
                whole = ~cut & (points >= min_length)
                starts, ends = starts[whole], ends[whole]
                one = cells.span_hashes(cells._LOWER[t.data], starts, ends)
                two = cells.span_hashes(counting.SECOND_LOWER[t.data], starts, ends)
                at, n = counting.distinct(one, two)
                raw = low.tobytes()
                for a, b, k in zip(starts[at].tolist(), ends[at].tolist(), n.tolist()):
                    held.counts[raw[a:b]] += k
                if held.over:
                    yield _counted(held)
        if held.counts:
            yield _counted(held)

    return run


def _counted(held: counting.Held) -> pa.RecordBatch:
    rows = held.take()
    return pa.RecordBatch.from_arrays(
        [counting.text_column([w for w, _ in rows]), pa.array([n for _, n in rows], pa.int64())], ["word", "n"]
    )


def vocabulary(docs: DataFrame, min_count: int = MIN_COUNT, min_length: int = MIN_LENGTH, every: int = EVERY) -> DataFrame:
    """``word, n``: runs of letters in lower case, one in ``every`` of them (by checksum) short of a letter."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counted = rows.mapInArrow(_count(every, min_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _key(m: Column, s: Column, e: Column) -> Column:
    """What a word has before and behind the piece [s, e) of a word of ``m`` letters."""
    word, behind = F.col("word"), m - e
    left = F.substring(word, F.lit(1), s)
    right = F.substring(word, F.length(word) - behind + 1, behind)
    return F.xxhash64(m, s, e, left, right)


def _pieces(rows: DataFrame, cuts: Column) -> DataFrame:
    """One row per word and piece: ``word, n, m, s, e, key``."""
    out = rows.select("word", "n", F.explode(cuts).alias("c")).select("word", "n", "c.m", "c.s", "c.e")
    return out.withColumn("key", _key(F.col("m"), F.col("s"), F.col("e")))


def _piece(m: Column, s: Column, e: Column) -> Column:
    return F.struct(m.cast("int").alias("m"), s.cast("int").alias("s"), e.cast("int").alias("e"))


def _halves(m: Column) -> list[Column]:
    half = F.floor(m / 2)
    return [_piece(m, F.lit(0), half), _piece(m, half, m)]


def buckets(words: DataFrame, min_length: int = MIN_LENGTH, limit: int = LIMIT) -> list[DataFrame]:
    """Rows of all buckets; none holds more than ``limit`` words unless its piece is one letter."""
    spark = words.sparkSession
    size = F.length("word")
    cuts = F.concat(F.array(*_halves(size)), F.when(size > min_length, F.array(*_halves(size - 1))).otherwise(F.array()))
    rows, out = materialize(spark, _pieces(words, cuts), "pieces"), []
    while True:
        crowded = rows.filter(F.col("e") - F.col("s") > 1).groupBy("key").agg(F.count("*").alias("c")).filter(F.col("c") > limit)
        crowded = materialize(spark, crowded.select(F.col("key").alias("k")), "crowded")
        if crowded.isEmpty():
            return [*out, rows]
        out.append(rows.join(crowded, F.col("key") == F.col("k"), "left_anti"))
        mid = F.floor((F.col("s") + F.col("e")) / 2)
        halves = F.array(_piece(F.col("m"), F.col("s"), mid), _piece(F.col("m"), mid, F.col("e")))
        rows = materialize(spark, _pieces(rows.join(crowded, F.col("key") == F.col("k"), "left_semi"), halves), "pieces")


class SortedList:
    """Words of some buckets, ordered by bucket and word, as code points with their adjacent LCPs."""

    def __init__(self, bucket: np.ndarray, words: list[str]):
        self.size = np.array([len(w) for w in words], np.int64)
        # Two zeros behind each word stand for letters that it does not have.
        self.at = np.concatenate([[0], np.cumsum(self.size + 2)])[:-1]
        self.points = np.frombuffer("\0\0".join([*words, ""]).encode("utf-32-le"), np.uint32)
        n = len(words)
        self.lcp = np.full(n, -1, np.int64)
        same = np.flatnonzero(bucket[1:] == bucket[:-1]) + 1
        self.lcp[same] = 0
        depth = 0
        while len(same):
            more = self.size[same] > depth
            more &= self.size[same - 1] > depth
            same = same[more]
            same = same[self.points[self.at[same] + depth] == self.points[self.at[same - 1] + depth]]
            depth += 1
            self.lcp[same] = depth
        self._heads: dict[int, np.ndarray] = {}

    def heads(self, depth: int) -> np.ndarray:
        """First words of the ranges that share ``depth`` letters."""
        if depth not in self._heads:
            self._heads[depth] = np.flatnonzero((self.lcp < depth) & (self.size >= depth))
        return self._heads[depth]

    def children(self, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ranges one letter deeper, with where those of each range begin and how many they are."""
        own, deeper = self.heads(depth), self.heads(depth + 1)
        parent = np.searchsorted(own, deeper, "right") - 1
        count = np.bincount(parent, minlength=len(own))
        return deeper, np.cumsum(count) - count, count


def near_pairs(words: SortedList, rows: int = ROWS):
    """Yields ``asking, found, first difference`` of all words of one bucket that are one edit apart.

    A state holds, for asking words and ranges of the list, the cells of the edit matrix
    left of, on and right of the diagonal; at most about ``rows`` are expanded at once.
    """
    n = len(words.size)
    root = np.searchsorted(words.heads(0), np.arange(n), "right") - 1
    todo = [(0, np.arange(n), root, np.full(n, 3, np.uint8), np.zeros(n, np.uint8), np.ones(n, np.uint8), np.zeros(n, np.int64))]
    while todo:
        depth, q, v, left, on, right, lcp = todo.pop()
        deeper, begin, count = words.children(depth)
        times = count[v] * (words.size[q] >= depth)
        total = int(times.sum())
        if total > rows and len(q) > 1:
            half = len(q) // 2
            for part in (slice(half, None), slice(None, half)):
                todo.append((depth, *(x[part] for x in (q, v, left, on, right, lcp))))
            continue
        if not total:
            continue
        own = np.repeat(np.arange(len(q)), times)
        child = np.arange(total) - np.repeat(np.cumsum(times) - times, times) + begin[v][own]
        q, a, b, c, lcp = q[own], left[own], on[own], right[own], lcp[own]
        head = deeper[child]
        letter, asked = words.points[words.at[head] + depth], words.at[q] + depth
        a = np.minimum(a + (words.points[asked - (depth > 0)] != letter), b + 1)
        new = np.minimum(np.minimum(b + (words.points[asked] != letter), c + 1), a + 1)
        c = np.minimum(c + (words.points[asked + 1] != letter), new + 1)
        live = np.minimum(np.minimum(a, new), c) <= 1
        q, child, head, lcp = q[live], child[live], head[live], lcp[live]
        a, b, c = (np.minimum(x[live], 3).astype(np.uint8) for x in (a, new, c))
        depth += 1
        lcp[b == 0] = depth
        off = words.size[q] - depth
        cell = np.where(off == -1, a, np.where(off == 0, b, np.where(off == 1, c, 3)))
        hit = (words.size[head] == depth) & (cell == 1)
        if hit.any():
            yield q[hit], head[hit], lcp[hit]
        if len(q):
            todo.append((depth, q, child, a, b, c, lcp))


_BEST = "word string, n long, near long, best_n long, best string"


def _scan(rows: int, at_once: int):
    def found(table: pa.Table) -> pa.RecordBatch:
        bucket, n, m, s, e = (table.column(x).to_numpy() for x in ("key", "n", "m", "s", "e"))
        # A bucket of one word has no pairs.
        alone = np.ones(len(bucket), bool)
        alone[1:] &= bucket[1:] != bucket[:-1]
        alone[:-1] &= bucket[1:] != bucket[:-1]
        some = np.flatnonzero(~alone)
        names = table.column("word").take(pa.array(some)).to_pylist()
        bucket, n, m, s, e = (x[some] for x in (bucket, n, m, s, e))
        words = SortedList(bucket, names)
        q, w = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b, lcp in near_pairs(words, rows):
            own = np.minimum(words.size[a], words.size[b]) == m[a]
            own &= (lcp >= s[a]) & ((lcp < e[a]) | (e[a] == m[a]))
            q.append(a[own])
            w.append(b[own])
        q, w = np.concatenate(q), np.concatenate(w)
        order = np.lexsort((w, -n[w], q))
        q, w = q[order], w[order]
        head = np.flatnonzero(np.diff(q, prepend=-1))
        near = np.diff(np.append(head, len(q)))
        q, w = q[head], w[head]
        return pa.RecordBatch.from_arrays(
            [pa.array([names[i] for i in q], pa.string()), pa.array(n[q]), pa.array(near), pa.array(n[w]),
             pa.array([names[i] for i in w], pa.string())], ["word", "n", "near", "best_n", "best"],
        )

    def run(batches):
        waiting, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            size += batch.num_rows
            if size < at_once:
                continue
            table = pa.Table.from_batches(waiting).combine_chunks()
            key = table.column("key").to_numpy()
            whole = int(np.searchsorted(key, key[-1]))  # the last bucket may go on in the next batch
            if whole:
                yield found(table.slice(0, whole))
            waiting, size = table.slice(whole).to_batches(), len(table) - whole
        if size:
            yield found(pa.Table.from_batches(waiting).combine_chunks())

    return run


def roots(links: DataFrame) -> DataFrame:
    """``word, root``: where the links ``word, form`` end, by letting every link jump over the next one."""
    spark = links.sparkSession
    state = materialize(spark, links.select("word", F.col("form").alias("root")), "links")
    while True:
        after = state.select(F.col("word").alias("root"), F.col("root").alias("then"))
        step = materialize(spark, state.join(after, "root", "left").select("word", "root", "then"), "links")
        if step.filter(F.col("then").isNotNull()).isEmpty():
            return state
        state = step.select("word", F.coalesce("then", "root").alias("root"))


def variants(words: DataFrame, min_length: int = MIN_LENGTH, limit: int = LIMIT, rows: int = ROWS, at_once: int = WORDS) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for distinct ``word, n`` of at least ``min_length`` letters."""
    spark = words.sparkSession
    every = words.select("word", "n", F.lit(0).cast("long").alias("near"), F.lit(None).cast("long").alias("best_n"),
                         F.lit(None).cast("string").alias("best"))
    for part in buckets(words, min_length, limit):
        found = part.repartition("key").sortWithinPartitions("key", "word").mapInArrow(_scan(rows, at_once), _BEST)
        every = every.unionByName(found)
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), "best")))
    judged = every.groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), best.alias("b"))
    taken = -F.col("b.less") >= 2 * F.col("n")
    forms = materialize(
        spark,
        judged.select(
            "word", "n", "n_near", F.when(taken, F.col("b.best")).alias("form"), F.when(taken, -F.col("b.less")).alias("form_n")
        ),
        "forms",
    )
    ends = roots(forms.filter(F.col("form").isNotNull())).withColumnRenamed("word", "w")
    return forms.join(ends, F.col("word") == F.col("w"), "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )


def group_variants(docs: DataFrame) -> DataFrame:
    """Spelling variants of all words of ``docs (doc_id, text)``."""
    return variants(materialize(docs.sparkSession, vocabulary(docs), "vocabulary"))
