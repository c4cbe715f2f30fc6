"""Byte-level substring removal with range-partitioned, anchored suffixes.

A byte goes if a ``LENGTH``-byte string that covers it also starts in a document with a
smaller id.  Sorting a suffix for every byte would write many times the corpus, so
suffixes start at anchors only: in each window of ``LENGTH`` bytes the ``GRAM``-byte
string with the smallest hash (the leftmost of equals).  Equal windows have their
anchor at the same place, so nothing is lost.  Every window belongs to one anchor; the
windows of an anchor travel together as one short block of text.

Blocks are partitioned by ranges of the suffix's leading bytes, with splitters from a
bounded sample, and ranges are cut further by a hash of the anchor where the corpus
needs more buckets.  Suffixes with equal leading bytes never part, so no match crosses
a boundary.  A bucket sorts its windows by content and takes the smallest id of equal
neighbours.

Documents are packed into cells of some MB.  A cell sends each distinct block once, so a
passage that a third of all documents hold is sent once per cell, and gets back a
bit mask for each block of which a part is found in a smaller document.

Defined results: null and empty texts have no bytes; texts below ``LENGTH`` bytes lose
nothing; a null id counts as larger than every id; rows that share an id are one
document, so they take nothing from each other.  Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from . import cells

LENGTH = 50
GRAM = 12
SPAN = LENGTH - GRAM + 1
CELL_BYTES = 1 << 20
BUCKET_BYTES = 3 << 20
RANGES = 1024
SAMPLE_CELLS = 256
LAST = np.iinfo(np.int64).max
LEVEL = 6


def _zip(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=LEVEL).compress(np.ascontiguousarray(x).tobytes())


def _unzip(x: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), kind)


def _pack(batches):
    """Documents into cells: ids, lengths and bytes of some MB of whole texts."""
    for batch in batches:
        ids = batch.column("doc_id").fill_null(LAST).to_numpy(zero_copy_only=False)
        null = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
        for t in cells.texts_of(batch.column("text"), CELL_BYTES):
            own = slice(t.lo, t.lo + t.n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([len(t.data)], pa.int64()), pa.array([_zip(ids[own])], pa.binary()),
                    pa.array([_zip(null[own])], pa.binary()), pa.array([_zip(np.diff(t.at))], pa.binary()),
                    pa.array([_zip(t.data)], pa.binary()),
                ],
                ["n_bytes", "ids", "nulls", "sizes", "data"],
            )


class Cell:
    """A cell's documents and its distinct blocks, the same whenever they are taken."""

    def __init__(self, ids: bytes, sizes: bytes, data: bytes):
        self.ids = _unzip(ids, np.int64)
        self.data = _unzip(data, np.uint8)
        self.at = np.concatenate([[0], np.cumsum(_unzip(sizes, np.int64))])
        data, n = self.data, len(self.data)
        self.n_blocks, self.block_of = 0, np.zeros(0, np.int64)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if n < LENGTH:
            return
        up, down = cells.powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(cells._TABLE[data] * up[:n], out=sums[1:])
        gram = cells.mix((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])
        key = ((gram >> np.uint64(30)) << np.uint64(30)) | np.arange(len(gram), dtype=np.uint64)
        least, width = key, 1
        while width < SPAN:  # minimum over SPAN neighbours, by doubling
            step = min(width, SPAN - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        anchor = (least & np.uint64((1 << 30) - 1)).astype(np.int64)
        del key, least
        # Windows that lie within one document.
        room = np.maximum(np.diff(self.at) - LENGTH + 1, 0)
        text = np.repeat(np.arange(len(self.ids)), room)
        window = np.arange(len(text)) - np.repeat(np.cumsum(room) - room, room) + self.at[text]
        anchor = anchor[window]
        new = np.ones(len(window), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        head = np.flatnonzero(new)
        self.first = window[head]
        self.count = np.diff(np.append(head, len(window)))
        self.text = text[head]
        code = cells.mix((sums[self.first + self.count + LENGTH - 1] - sums[self.first]) * down[self.first])
        code += (anchor[head] - self.first).astype(np.uint64) + (self.count.astype(np.uint64) << np.uint64(32))
        _, self.kind, self.block_of = np.unique(code, return_index=True, return_inverse=True)
        self.n_blocks = len(self.kind)
        self.low = np.full(self.n_blocks, LAST)
        np.minimum.at(self.low, self.block_of, self.ids[self.text])
        at = anchor[head][self.kind]
        self.gram = gram[at]
        self.lead = np.zeros(self.n_blocks, np.uint64)
        for j in range(8):
            self.lead = (self.lead << np.uint64(8)) | data[at + j].astype(np.uint64)

    def blocks(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and joined bytes of some distinct blocks."""
        size = self.count[self.kind[chosen]] + LENGTH - 1
        start = self.first[self.kind[chosen]]
        where = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return size.astype(np.uint8), self.data[where]


def _cells_of(batch):
    cols = [batch.column(c).to_pylist() for c in ("ids", "sizes", "data")]
    for i, row in enumerate(zip(*cols)):
        yield i, Cell(*row)


def _leads(batches):
    for batch in batches:
        for _, cell in _cells_of(batch):
            if cell.n_blocks:
                some = cell.lead[np.argsort(cell.gram)[:64]]
                yield pa.RecordBatch.from_arrays([pa.array(cells.signed(some ^ np.uint64(1 << 63)))], ["lead"])


def _send(splitters: np.ndarray, parts: int):
    def run(batches):
        for batch in batches:
            names = batch.column("cell").to_pylist()
            for i, cell in _cells_of(batch):
                if not cell.n_blocks:
                    continue
                bucket = np.searchsorted(splitters, cell.lead, "right") * parts + (cell.gram % np.uint64(parts)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                rows = {"bucket": [], "cell": [], "numbers": [], "lows": [], "sizes": [], "data": []}
                for chosen in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                    size, data = cell.blocks(chosen)
                    for name, x in zip(rows, (int(bucket[chosen[0]]), names[i], _zip(chosen.astype(np.int32)),
                                              _zip(cell.low[chosen]), _zip(size), _zip(data))):
                        rows[name].append(x)
                yield pa.RecordBatch.from_pydict(rows, _SENT)

    return run


_SENT = pa.schema([("bucket", pa.int64()), ("cell", pa.int64()), *[(c, pa.binary()) for c in ("numbers", "lows", "sizes", "data")]])


def _window_codes(data: np.ndarray, size: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Content codes of all windows of all blocks, some MB of blocks at a time."""
    at, out = np.concatenate([[0], np.cumsum(size)]), []
    lo = 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + CELL_BYTES, "right")) - 1)
        part, n = data[at[lo] : at[hi]], count[lo:hi]
        start = np.repeat(at[lo:hi] - at[lo] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        up, down = cells.powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(cells._TABLE[part] * up[: len(part)], out=sums[1:])
        out.append(cells.mix((sums[start + LENGTH] - sums[start]) * down[start]))
        lo = hi
    return np.concatenate(out)


def _match(table: pa.Table) -> pa.Table:
    """Per cell the blocks with windows that a smaller document holds, and which windows these are."""
    read = lambda c, kind: [_unzip(x, kind) for x in table.column(c).to_pylist()]
    numbers, lows, sizes = read("numbers", np.int32), read("lows", np.int64), read("sizes", np.uint8)
    data = np.concatenate(read("data", np.uint8))
    held = [len(x) for x in numbers]
    numbers, lows, size = (np.concatenate(x) for x in (numbers, lows, sizes))
    size = size.astype(np.int64)
    count = size - LENGTH + 1
    block = np.repeat(np.arange(len(size), dtype=np.int32), count)
    offset = (np.arange(len(block)) - np.repeat(np.cumsum(count) - count, count)).astype(np.uint8)
    code = _window_codes(data, size, count)
    order = np.argsort(code)
    ordered = code[order]
    head = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    low = lows[block]
    least = np.minimum.reduceat(low[order], head)
    taken = np.zeros(len(code), bool)
    taken[order] = np.repeat(least, np.diff(np.append(head, len(code)))) < low[order]
    mask = np.zeros(len(size), np.uint64)
    np.bitwise_or.at(mask, block[taken], np.uint64(1) << offset[taken].astype(np.uint64))
    out = {"cell": [], "found": [], "masks": []}
    for cell, lo, n in zip(table.column("cell").to_pylist(), np.cumsum(held) - held, held):
        hit = lo + np.flatnonzero(mask[lo : lo + n])
        if len(hit):
            out["cell"].append(cell)
            out["found"].append(numbers[hit].tobytes())
            out["masks"].append(mask[hit].tobytes())
    return pa.Table.from_pydict(out, pa.schema([("cell", pa.int64()), ("found", pa.binary()), ("masks", pa.binary())]))


def _cut(batches):
    for batch in batches:
        answers = [batch.column(c).to_pylist() for c in ("nulls", "found", "masks")]
        for i, cell in _cells_of(batch):
            null, found, masks = (x[i] for x in answers)
            null = _unzip(null, bool)
            n = len(cell.data)
            gone = np.zeros(n + 1, np.int64)
            if cell.n_blocks:
                mask = np.zeros(cell.n_blocks, np.uint64)
                for f, m in zip(found or (), masks or ()):
                    mask[np.frombuffer(f, np.int32)] = np.frombuffer(m, np.uint64)
                own = mask[cell.block_of]
                # A later document of the cell loses the whole block.
                own[cell.ids[cell.text] > cell.low[cell.block_of]] = np.iinfo(np.uint64).max
                some = np.flatnonzero(own)
                for j in range(SPAN):
                    at = some[(cell.count[some] > j) & ((own[some] >> np.uint64(j)) & np.uint64(1) > 0)]
                    np.add.at(gone, cell.first[at] + j, 1)
                    np.add.at(gone, cell.first[at] + j + LENGTH, -1)
            removed = np.cumsum(gone)[:-1] > 0
            head = removed.copy()
            head[1:] &= ~removed[:-1]
            begin = cell.at[:-1][cell.at[:-1] < cell.at[1:]]
            head[begin] = removed[begin]
            total, spans = (np.concatenate([[0], np.cumsum(x)])[cell.at] for x in (removed, head))
            size = np.diff(cell.at)
            left = cell.data[~removed]
            ends = np.concatenate([[0], np.cumsum(size - np.diff(total))]).astype(np.int32)
            kept = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(left.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell.ids, mask=null), pa.array(size), pa.array(np.diff(total)), pa.array(np.diff(spans)), kept],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )


def remove_repeats(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes)."""
    spark = docs.sparkSession
    packed = materialize(
        spark,
        docs.select(F.col("doc_id").cast("long"), "text")
        .mapInArrow(_pack, "n_bytes long, ids binary, nulls binary, sizes binary, data binary")
        .withColumn("cell", F.monotonically_increasing_id()),
        "cells",
    )
    total = packed.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    # Splitters only balance the buckets, so a bounded sample of cells, chosen by hash, will do.
    chosen = packed.select("cell").orderBy(F.xxhash64("cell")).limit(SAMPLE_CELLS).withColumnRenamed("cell", "c")
    sample = packed.join(chosen, F.col("cell") == F.col("c"), "left_semi").select("ids", "sizes", "data")
    ranges = min(buckets, RANGES)
    leads = sorted((r[0] for r in sample.mapInArrow(_leads, "lead long").collect())) if ranges > 1 else []
    cuts = sorted({leads[len(leads) * i // ranges] for i in range(1, ranges)}) if leads else []
    splitters = np.array(cuts, np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    sent = packed.select("cell", "ids", "sizes", "data").mapInArrow(
        _send(splitters, math.ceil(buckets / (len(cuts) + 1))),
        "bucket long, cell long, numbers binary, lows binary, sizes binary, data binary",
    )
    matched = materialize(spark, sent.groupBy("bucket").applyInArrow(_match, "cell long, found binary, masks binary"), "matches")
    answers = matched.groupBy(F.col("cell").alias("c")).agg(
        F.collect_list(F.struct("found", "masks")).alias("a")
    ).select("c", F.col("a.found").alias("found"), F.col("a.masks").alias("masks"))
    # Cells grow with the corpus, and so do the answers: no side to broadcast.
    both = packed.join(answers.hint("merge"), F.col("cell") == F.col("c"), "left")
    return both.select("ids", "nulls", "sizes", "data", "found", "masks").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
