from collections import Counter

import brute

import corpus_pipeline
from trendloom.llm import sharding


def test_pipeline(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    good = {r[0] for r in brute.quality(docs) if r[-1]}
    docs = [d for d in docs if d[0] in good]
    one = {d for d, (_, c) in brute.near([d[:2] for d in docs], 5, 80).items() if c == d}
    docs = [d for d in docs if d[0] in one]
    clean = {r[0] for r in brute.hits([d[:2] for d in docs], items) if not r[-1]}
    docs = [d for d in docs if d[0] in clean]
    assert 0 < len(docs) < 200
    table = sharding.fill_table([f"shard-{i:05d}" for i in range(sharding.SHARDS)], sharding.SLOTS)
    out = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in out} <= clean
    sizes, taken, largest = Counter(), Counter(), Counter()
    for _, text, source in docs:
        n = len(brute.WORD.findall(text))
        sizes[source] += n
        largest[source] = max(largest[source], n)
    for r in out:
        assert r.shard == table[r.slot]
        taken[r.source] += len(brute.WORD.findall(r.text))
    for source, want in brute.targets(sizes).items():
        assert abs(taken[source] - want) <= largest[source]
