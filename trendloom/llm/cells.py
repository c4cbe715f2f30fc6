"""Words, lines and hashes of many texts at once, as numpy arrays inside tasks.

An Arrow batch is cut into chunks of about ``CHUNK`` bytes of whole texts (a longer
text is a chunk of its own), so memory follows the chunk and not the batch.
Hashes are 64 bits wide and the same in every task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 19
#: What separates words: white space only, or everything in ASCII but letters and digits.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
NON_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

_M1, _M2, _STEP = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, salt: int = 0) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt * 1_000_003)) * _STEP) | np.uint64(1)


_TABLE = seeds(256, 7)
_LOWER = _TABLE.copy()
_LOWER[65:91] = _TABLE[97:123]
_powers = {"n": 0}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, at least ``n`` of each."""
    if _powers["n"] < n:
        n = max(n, CHUNK + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            out = np.full(n, base, np.uint64)
            out[0] = 1
            _powers[name] = np.multiply.accumulate(out)
        _powers["n"] = n
    return _powers["up"], _powers["down"]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each ``values[start:end]``; values are 64-bit codes of the elements."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def window_hashes(codes: np.ndarray, width: int, salt: int = 1) -> np.ndarray:
    """Hash of every ``width`` consecutive codes, by the first one's position."""
    n = max(0, len(codes) - width + 1)
    out = np.zeros(n, np.uint64)
    for j, s in enumerate(seeds(width, salt)):
        out += codes[j : j + n] * s
    return mix(out)


class Texts:
    """Whole texts lying behind each other in ``data``; text i is ``data[at[i]:at[i + 1]]``."""

    def __init__(self, data: np.ndarray, at: np.ndarray, lo: int):
        self.data, self.at, self.lo, self.n = data, at, lo, len(at) - 1

    def words(self, separators: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends, text numbers and hashes of all words."""
        table = np.ones(256, bool)
        table[np.frombuffer(separators, np.uint8)] = False
        if lower:
            table[65:91] = table[97:123]
        inside = table[self.data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begin = self.at[:-1][self.at[:-1] < self.at[1:]]
        first[begin] = inside[begin]
        last = inside.copy()
        last[:-1] &= first[1:] | ~inside[1:]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        codes = (_LOWER if lower else _TABLE)[self.data]
        return starts, ends, self.text_of(starts), span_hashes(codes, starts, ends)

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.at, positions, "right") - 1

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return span_hashes(_TABLE[self.data], starts, ends)

    def count(self, numbers: np.ndarray) -> np.ndarray:
        return np.bincount(numbers, minlength=self.n).astype(np.int64)

    def bounds(self, numbers: np.ndarray) -> np.ndarray:
        """Where each text's part of a list that is ordered by text begins and ends."""
        return np.searchsorted(numbers, np.arange(self.n + 1))


def texts_of(column: pa.Array, limit: int = CHUNK):
    """The texts of an Arrow column in chunks; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    at = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(at, int(at[lo]) + limit, "right")) - 1)
        hi = min(hi, len(column))
        yield Texts(data[at[lo] : at[hi]], at[lo : hi + 1].astype(np.int64) - int(at[lo]), lo)
        lo = hi


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list for each pair of neighbouring bounds."""
    bounds = np.asarray(bounds)
    return pa.ListArray.from_arrays(
        pa.array((bounds - bounds[0]).astype(np.int32)), pa.array(values[bounds[0] : bounds[-1]]).cast(kind)
    )


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    order = np.argsort(keys)
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out
