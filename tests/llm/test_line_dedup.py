import random

import brute
import pytest

from trendloom.llm import line_dedup


def check(docs):
    want = brute.line_dedup({(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()})
    got = line_dedup.dedup_lines(docs).collect()
    result = lambda d, n, links, kept: (d, n, n - len(kept.split(",")) * bool(kept), links, kept)
    expected = [result(r.doc_id, *want[r.doc_id, r.text]) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, expected))
    return got


def test_corpus(corpus, no_docs):
    assert sum(r.n_removed for r in check(corpus)) > 20
    check(no_docs)


def test_odd(odd_docs):
    check(odd_docs)


def test_rows_that_share_an_id(spark):
    rows = [
        (1, "red green blue\nfour five six"), (1, "seven eight\nred green blue\nnine ten"), (1, "four five six"), (1, None),
        (None, "red green blue\nalone here"), (None, "two words\nalone here"), (None, ""), (2, "two words\nseven eight"),
    ]
    got = check(spark.createDataFrame([*rows, rows[0]], "doc_id long, text string"))
    assert sum(r.n_removed for r in got if r.doc_id == 2) == 2


@pytest.mark.parametrize("seed", [1, 2])
def test_edited_lines(spark, seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "and", *(f"w{i}" for i in range(60))]
    bases = [rng.choices(vocabulary, k=rng.randint(1, 30)) for _ in range(25)]
    rows = []
    for d in range(60):
        lines = []
        for _ in range(rng.randint(0, 6)):
            x = list(rng.choice(bases))
            for _ in range(rng.randint(0, 3)):
                x.insert(rng.randrange(len(x) + 1), rng.choice(vocabulary))
            rng.shuffle(x)
            lines.append(rng.choice([" ", "\t ", "  "]).join(x).upper() if rng.random() < 0.5 else " ".join(x))
        rows.append((rng.randrange(10**12), "\n".join(lines)))
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_families_are_not_listed_as_pairs(spark, monkeypatch):
    """Variants of one line, and of one that shares half of it: all links count, but few pairs are rows."""
    rng = random.Random(5)
    bases = [[f"w{i}" for i in range(40)], [f"w{i}" for i in range(20, 60)]]
    lines = [" ".join([w if i != k else f"n{j}" for i, w in enumerate(bases[j % 2])]) for j in range(160) for k in [rng.randrange(40)]]
    listed, write = {}, line_dedup.materialize

    def counted(session, df, purpose):
        out = write(session, df, purpose)
        listed[purpose] = out.count()
        return out

    monkeypatch.setattr(line_dedup, "materialize", counted)
    got = check(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"))
    assert sum(r.n_links for r in got) == 2 * 80 * 79
    assert listed["stars"] + listed["pairs"] + listed["links"] < 1000


def test_chance_meetings_are_told_where_they_meet(spark, monkeypatch):
    """Lines that share two rare words and little else: their keys meet, but are no rows; crowded keys and white space count, too."""
    rng = random.Random(7)
    common = [f"c{i}" for i in range(60)]
    lines = [f"r{i // 2} {' '.join(rng.sample(common, 8))} s{i // 2}" for i in range(200)]
    crowd = [f"x\ty {' '.join(rng.sample(common, 8))}" for _ in range(20)]
    listed, write = {}, line_dedup.materialize

    def counted(session, df, purpose):
        out = write(session, df, purpose)
        listed[purpose] = out.count()
        return out

    monkeypatch.setattr(line_dedup, "materialize", counted)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    check(docs)
    assert listed["meetings"] < 20
    crowded = [*lines, *crowd, crowd[0] + " more", crowd[1].replace("\t", "\x0b")]
    check(spark.createDataFrame(list(enumerate(crowded)), "doc_id long, text string"))


def test_long_sets_that_meet_by_chance_are_no_rows(spark, monkeypatch):
    """Long lines of the same words: many share neighbours, but what comes later tells them apart where they meet."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(500)]
    lines = [" ".join(rng.sample(words, 170)) for _ in range(120)]
    near = [" ".join(rng.sample(x.split(), 150)) for x in lines[:6]]
    listed, write = {}, line_dedup.materialize

    def counted(session, df, purpose):
        out = write(session, df, purpose)
        listed[purpose] = out.count()
        return out

    monkeypatch.setattr(line_dedup, "materialize", counted)
    got = check(spark.createDataFrame(list(enumerate([*lines, *near])), "doc_id long, text string"))
    assert sum(r.n_links for r in got) == 12
    assert listed["met"] + listed["across"] < 5000
