import random
import re
from collections import Counter

import pytest

from trendloom.llm import phrases


def lists(docs):
    for text, lang in docs:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            if words := re.findall("[^\x20\x09]+", piece):
                yield "und" if lang is None else lang, words


def counted(docs):
    f, n = Counter(), Counter()
    for lang, words in lists(docs):
        n[lang] += len(words)
        for k in range(1, 6):
            f.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    return f, n


def mined(docs, least, top):
    f, n = counted(docs)
    found = {k: c for k, c in f.items() if len(k) > 2 and c >= least}
    inside = {(lang, *part) for (lang, *w), c in found.items() for part in (w[:-1], w[1:]) if f[(lang, *part)] <= c}
    rows = []
    for key, a in found.items():
        lang, *w = key
        if key not in inside:
            cuts = [(1000 * a * n[lang] // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            rows.append((lang, -score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    out, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(rows):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return out


def plain(df):
    return sorted(tuple(r) for r in df.drop("path").collect())


@pytest.mark.parametrize("least,top", [(2, 30), (3, 2000)])
@pytest.mark.parametrize("which", ["odd_docs", "no_docs"])
def test_odd_texts(request, which, least, top):
    docs = request.getfixturevalue(which)
    assert plain(phrases.mine(docs, least, top)) == mined([(r.text, r.lang) for r in docs.collect()], least, top)


def test_given_texts(corpus):
    docs = [(r.text, r.lang) for r in corpus.collect()]
    assert plain(phrases.mine(corpus, 5, 300)) == mined(docs, 5, 300)
    assert plain(phrases.mine(corpus)) == mined(docs, 100, 2000)


def test_words_start_one_gram_each(corpus):
    f, n = counted([(r.text, r.lang) for r in corpus.collect()])
    rows = phrases.longest_grams(corpus, 4).collect()
    total = Counter()
    for r in rows:
        assert r.size == len(r.gram.split(" ")) <= 5 if r.gram else r.size == 0
        total[r.lang] += r.w
    assert total == n
    flows = {(r.lang, *r.phrase.split(" ")): r.f for r in phrases.flow(phrases.longest_grams(corpus, 4), 4).collect()}
    assert flows == {k: c for k, c in f.items() if c >= 4}


def test_tasks_of_the_last_pass_take_several_splits(corpus):
    """A frequent gram is a row of each task, so these grow slower than the splits."""
    cores = corpus.sparkSession.sparkContext.defaultParallelism
    split = corpus.repartition(16 * cores)
    assert phrases._shares(split).rdd.getNumPartitions() == 16 * cores // phrases.SPLITS
    assert phrases._shares(corpus.repartition(cores)).rdd.getNumPartitions() == cores
    assert plain(phrases.mine(split, 5, 300)) == plain(phrases.mine(corpus, 5, 300))


def test_products_past_64_bits(spark):
    big = 3_000_000_000_000
    counts = [("x", "a", 1, big), ("x", "b", 1, big - 1), ("x", "a b", 2, big // 2)]
    counts = spark.createDataFrame(counts, "lang string, phrase string, size int, f long")
    totals = spark.createDataFrame([("x", 7 * big)], "lang string, n long")
    r = phrases.collocations(counts, totals).first()
    assert r.score == 1000 * (big // 2) * 7 * big // (big * (big - 1))


def test_paths(spark):
    """A line, a fork into two, a ring, and a loop of one word."""
    draw = random.Random(3)
    line = [f"l{i}" for i in range(20)]
    fork = [["f1", "f2", "f3", "f4", x, "y", "z", "w"] for x in ("p", "q")]
    ring = [f"r{i}" for i in range(7)] * 2
    loop = ["o"] * 9
    grams = {" ".join(w[i : i + 5]) for w in (line, *fork, ring, loop) for i in range(len(w) - 4)}
    grams = sorted(grams)
    draw.shuffle(grams)
    edges = spark.createDataFrame([("x", g, 5) for g in grams], "lang string, gram string, size int")
    got = {r.gram: (r.place, r.path) for r in phrases.paths(edges).collect()}
    assert set(got) == set(grams)
    assert {got[" ".join(line[i : i + 5])] for i in range(16)} == {(i, " ".join(line)) for i in range(16)}
    for w in fork:
        assert got[" ".join(w[:5])][1] == " ".join(w) == got[" ".join(w[3:])][1]
    assert all(got[" ".join(ring[i : i + 5])] == (0, " ".join(ring[i : i + 5])) for i in range(7))
    assert got["o o o o o"] == (0, "o o o o o")
    short = {r.path for r in phrases.paths(edges, segment=4).collect() if r.gram.startswith("l")}
    assert short == {" ".join(line[i : i + 8]) for i in (0, 4, 8, 12)}
