import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from trendloom.llm import cells, chunk_dedup


def split(text, reach=chunk_dedup.REACH):
    """Chunks of one text, byte by byte."""
    data = text.encode()
    gear = [int(x) for x in chunk_dedup._GEAR]
    h, hashes = 0, []
    for b in data:
        h = ((h << 1) + gear[b]) & 0xFFFFFFFF
        hashes.append(h)
    char = lambda p: next(q for q in range(p, len(data) + 1) if q == len(data) or data[q] & 0xC0 != 0x80)
    ends = {len(data)} if data else set()
    for i in range(reach + 31, len(data) - reach):
        if hashes[i] > max(hashes[i - reach : i] + hashes[i + 1 : i + reach + 1]):
            ends.add(char(i + 1))
    out, at = [], 0
    for e in sorted(ends):
        cuts = [char(p) for p in range(at + chunk_dedup.MAX, e, chunk_dedup.MAX)] + [e]
        for c in sorted(set(cuts)):
            out.append(data[at:c])
            at = c
    return out


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    chunks = [(2**63 - 1 if d is None else d, split(t or "")) for d, t in rows]
    low = {}
    for d, parts in chunks:
        for c in parts:
            low[c] = min(d, low.get(c, d))
    want = []
    for (d, _), (known, parts) in zip(rows, chunks):
        seen, kept, gone, flags = set(), b"", 0, [False]
        for c in parts:
            drop = c in seen or low[c] < known
            seen.add(c)
            flags.append(drop)
            gone += drop * len(c)
            kept += b"" if drop else c
        spans = sum(b and not a for a, b in zip(flags, flags[1:]))
        want.append((d, len(b"".join(parts)), len(parts), sum(flags), gone, spans, kept.decode()))
    got = [tuple(r) for r in chunk_dedup.remove_chunks(docs).collect()]
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    return got


@pytest.mark.parametrize("which", ["corpus", "odd_docs", "no_docs"])
def test_tables(request, which):
    check(request.getfixturevalue(which))


def test_passages_are_caught(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyzé", k=rng.randint(2, 8)))
    words = lambda n: " ".join(word() for _ in range(n))
    passages = [words(55) for _ in range(20)]
    rows = [(i, f"{words(40)} {passages[i % 20]} {words(30)}") for i in range(60)] + [(100 + i, words(90)) for i in range(30)]
    rows += [(200, "z" * 5000), (201, "z" * 5000)]
    got = {r[0]: r for r in check(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert all(got[i][4] > 60 for i in range(20, 60)) and not any(got[i][4] for i in [*range(20), *range(100, 130)])


def test_insertion_keeps_chunks():
    rng = random.Random(1)
    text = "".join(rng.choices("abcdefgh ", k=20_000))
    a, b = split(text), split(text[:9000] + "inserted" + text[9000:])
    assert len(set(a) - set(b)) <= 3
    t = next(cells.texts_of(pa.array([text])))
    assert np.array_equal(chunk_dedup.chunk_ends(t)[1], np.cumsum([len(x) for x in a]))
    assert brute.sha(b"".join(a)) == brute.sha(text)
