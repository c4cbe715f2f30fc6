"""Counts of spans of many texts, combined inside a task before anything is shuffled."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa

from . import cells

#: Bytes of whole texts looked at in one go, and distinct keys a task holds before it passes them on.
CHUNK = 1 << 21
HELD = 200_000

SECOND = cells.seeds(256, 11)
SECOND_LOWER = SECOND.copy()
SECOND_LOWER[65:91] = SECOND[97:123]


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def distinct(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct pair of hashes stands first, and how often it occurs."""
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(first, kind="stable")
    for again in (False, True):
        a, b = first[order], second[order]
        new = np.ones(len(order), bool)
        new[1:] = a[1:] != a[:-1]
        mixed = ~new[1:] & (b[1:] != b[:-1])
        if again or not mixed.any():
            break
        order = np.lexsort((second, first))  # two spans with one 64-bit hash: order by both
    new[1:] |= mixed
    head = np.flatnonzero(new)
    return order[head], np.diff(np.append(head, len(order)))


class Held:
    """Counts by key of a task; ``over`` tells when to pass them on."""

    def __init__(self):
        self.counts: Counter = Counter()

    @property
    def over(self) -> bool:
        return len(self.counts) > HELD

    def take(self) -> list[tuple]:
        out = list(self.counts.items())
        self.counts = Counter()
        return out


def text_column(values: list[bytes]) -> pa.Array:
    """Byte strings that are valid UTF-8 as a text column."""
    return pa.array(values, pa.binary()).cast(pa.string())
