import random

import brute
import numpy as np
import pytest

from trendloom.llm import near_dedup
from trendloom.llm.components import components


def test_components(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(150)]
    pairs += [(500, x) for x in range(501, 560)] + [(7, 7)]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        lo, hi = sorted((find(a), find(b)))
        root[hi] = lo
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in pairs if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    m = 256
    for n in (1, 3, 40, 1000):
        for share in (0.5, 0.9):
            both = int(n * share)
            a, b = base[:n], np.concatenate([base[:both], base[2000 : 2000 + n - both]])
            text = np.repeat([0, 1], n)
            sig = near_dedup.super_min_hash(text, np.concatenate([a, b]), 2, m)
            assert abs((sig[0] == sig[1]).mean() - both / (2 * n - both)) < 0.12
            assert (sig < np.uint64(m) << np.uint64(32)).all()


def check(docs, width, percent, limit):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if r.doc_id is not None]
    want = brute.near(rows, width, percent)
    got = near_dedup.groups(docs, width, percent, limit).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], r.doc_id == want[r.doc_id][1])


@pytest.mark.parametrize("limit", [near_dedup.LIMIT, 200])
def test_families(spark, limit):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    rows = []
    for f in range(6):
        base = [word() for _ in range(rng.randint(30, 90))]
        for c in range(25):
            text = list(base)
            for _ in range(c % 5):
                text[rng.randrange(len(text))] = word()
            rows.append((len(rows), " ".join(text)))
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, "  ".join(base).upper())]
    rng.shuffle(rows)
    check(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85, limit)


@pytest.mark.parametrize("which", ["odd_docs", "corpus", "no_docs"])
def test_tables(request, which):
    docs = request.getfixturevalue(which)
    check(docs, 3, 85, near_dedup.LIMIT)
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    if which == "corpus":
        want = brute.near([(r.doc_id, r.text) for r in docs.collect()], 5, 80)
        assert sorted(ids) == sorted(d for d, (_, c) in want.items() if c == d)
    elif which == "odd_docs":
        assert ids.count(None) == 2 and 6 in ids and 7 not in ids


def test_only_members_texts_are_sent(spark):
    ids = [None, -5, 0, 7, 7, *range(1000, 3000)]
    docs = spark.createDataFrame([(i, f"text {i}", "x") for i in ids], "doc_id long, text string, lang string")
    members = spark.createDataFrame([(i, 1) for i in (-5, 7, 1500, 1500, 99)], "node long, family int")
    left = near_dedup._maybe_members(docs, members)
    assert left.columns == docs.columns
    got = [r.doc_id for r in left.collect()]
    assert sorted(i for i in got if i in (-5, 7, 1500)) == [-5, 7, 7, 1500] and None not in got
    assert len(got) < 20
    assert near_dedup._maybe_members(docs, members.limit(0)).count() == 0
