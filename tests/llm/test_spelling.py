import random
import zlib
from collections import Counter

import duckdb
import pytest

from trendloom.llm import spelling, sql_texts


def runs(docs):
    import re

    out = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def grouped(words):
    best, near = {}, Counter()
    for a in words:
        for b in words:
            if one_edit(a, b):
                near[a] += 1
                best[a] = min(best.get(a, (0, "")), (-words[b], b)) if a in best else (-words[b], b)
    form = {a: b for a, (n, b) in best.items() if -n >= 2 * words[a]}
    out = []
    for a, n in words.items():
        root = a
        while root in form:
            root = form[root]
        out.append((a, n, near[a], form.get(a), words[form[a]] if a in form else None, root))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect())


@pytest.mark.parametrize("which", ["odd_docs", "no_docs"])
def test_odd_texts(request, which):
    docs = request.getfixturevalue(which)
    assert got(spelling.group_variants(docs)) == grouped(runs([(r.doc_id, r.text) for r in docs.collect()]))


def test_words_of_texts(spark):
    rows = [(i, f"Größe grösse, Grosse×x éÉÿ Naïve {'x' * 90} abcde{i} _{'Long' * 40}Ā") for i in range(400)]
    docs = spark.createDataFrame(rows + [(None, "Größe abcde naïve") for _ in range(5)], "doc_id long, text string")
    assert {r.word: r.n for r in spelling.vocabulary(docs).collect()} == runs([tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("letters,limit", [("ab", 10_000), ("ab", 20), ("abcdé", 50), ("abcdefgh", 7)])
def test_equals_brute_force(spark, letters, limit):
    """Crowded buckets are cut, small blocks of the scan and of its batches give the same rows."""
    draw = random.Random(len(letters) + limit)
    words = {"".join(draw.choice(letters) for _ in range(draw.randint(5, 9))): draw.choice([3, 4, 6, 9, 50]) for _ in range(500)}
    words |= {"a" * 300: 7, "a" * 299: 3, "a" * 150 + "b" + "a" * 149: 4}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    assert got(spelling.variants(table, limit=limit, rows=300, at_once=64)) == grouped(words)


def test_every_bucket_is_bounded(spark):
    words = [("prefix" + a + b + c, 3) for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefghij"]
    table = spark.createDataFrame(words, "word string, n long")
    parts = spelling.buckets(table, limit=40)
    assert len(parts) > 1
    for part in parts:
        crowded = part.groupBy("key").count().filter("count > 40").join(part.filter("e - s > 1"), "key")
        assert crowded.isEmpty()
    assert got(spelling.variants(table, limit=40)) == grouped(dict(words))


def test_chains(spark):
    words = {"a" * n: 3 << (n - 5) for n in range(5, 30)}
    out = got(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert out == grouped(words) and {r[-1] for r in out} == {"a" * 29}


def test_sql_text(spark, corpus, tmp_path):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.001/documents.parquet')")
    want = con.execute(f"SELECT word, n, n_near, form, form_n, root FROM ({sql_texts.SPELLING})").fetchall()
    assert got(spelling.group_variants(corpus)) == sorted(want)
