import random

import brute
import pytest

from trendloom.llm import suffix_dedup
from pyspark.sql import functions as F


def key(r):
    return tuple((v is None, v) for v in r)


def check(docs, **options):
    out = suffix_dedup.remove_repeats(docs, **options).withColumn("sha", F.sha2("kept", 256))
    got = [tuple(r) for r in out.select("doc_id", "n_bytes", "n_removed", "n_spans", "sha").collect()]
    want = brute.repeats([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sorted(got, key=key) == sorted(want, key=key)
    return got


@pytest.mark.parametrize("which", ["corpus", "odd_docs", "no_docs"])
def test_tables(request, which):
    docs = request.getfixturevalue(which)
    if which == "odd_docs":
        docs = docs.withColumn("text", F.substring("text", 1, 30_000))
    check(docs)


def test_edges(spark):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choices("abé ", k=n))
    shared = [word(n) for n in (49, 50, 51, 60, 200, 48)]
    texts = ["ab" * 60, "ba" * 60, "a" * 300, "a" * 120, shared[1], "x" + shared[1], None, ""]
    for i in range(60):
        texts.append(word(rng.randint(0, 80)) + rng.choice(shared) + word(rng.randint(0, 80)) + rng.choice(shared)[:55])
    rows = [(100 - i if i % 3 else i, t) for i, t in enumerate(texts)] + [(None, shared[4] * 2), (7, shared[3]), (7, shared[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = check(docs.repartition(5), bucket_bytes=400)
    assert sum(r[2] for r in got) > 1000
