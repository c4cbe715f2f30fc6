import hashlib
from collections import Counter, defaultdict

import brute
import pytest
from pyspark.sql import functions as F

from trendloom.llm import decontamination, mixing, quality_rules, sharding


def key(r):
    return tuple((v is None, v) for v in r)


def plain(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


@pytest.mark.parametrize("which", ["odd_docs", "corpus", "no_docs"])
def test_quality(request, which):
    docs = request.getfixturevalue(which)
    got = plain(quality_rules.judge(docs), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert sorted(got, key=key) == sorted(brute.quality(plain(docs, "doc_id", "text", "source")), key=key)


def test_common_lines_deplete(spark):
    body = lambda i: " ".join(f"word{i}x{j}" for j in range(60))
    same = "Cookie notice of  this host " * 8
    rows = [(i, same + "\n" + (body(i) if i % 4 else " ".join(body(i).split()[:10])), "h") for i in range(40)]
    rows += [(100 + i, f"{body(100 + i)}\n{same if i < 2 else ''}", "other") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = plain(quality_rules.judge(docs), "doc_id", "kept", "n_common_lines")
    assert {d for d, kept, _ in got if not kept} == {i for i in range(40) if i % 4 == 0}
    assert {d for d, _, n in got if n} == set(range(40))
    assert quality_rules.keep_good(docs).count() == 70


def test_common_lines_in_any_host_size(spark):
    body = lambda i, n: " ".join(f"word{i}x{j}" for j in range(n))
    line = lambda name: " ".join(f"{name}{j}" for j in range(30))
    # 11 of 300 documents have one line, 10 have another, and both keep over 30 % of their words.
    rows = [(i, body(i, 40) + "\n" + line("eleven" if i < 11 else "ten"), "large") for i in range(21)]
    rows += [(i, body(i, 60), "large") for i in range(21, 300)]
    # 5 of 20 documents of a small host, and 4 of 20.
    rows += [(i, body(i, 40) + "\n" + line("five"), "small") for i in range(600, 605)]
    rows += [(i, body(i, 40) + "\n" + line("four"), "small") for i in range(605, 609)]
    rows += [(i, body(i, 60), "small") for i in range(609, 620)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = plain(quality_rules.judge(docs), "doc_id", "kept", "n_common_lines", "words_left")
    gone = {*range(11), *range(600, 605)}
    assert {r[0] for r in got if r[2]} == gone == {r[0] for r in got if not r[1]}
    assert {r[3] for r in got if r[0] in gone} == {40}


def test_copies_make_no_line_common(spark):
    """Copies of one text in one host stay for the near-duplicate stage; a line of eleven texts goes."""
    body = lambda i: " ".join(f"word{i}x{j}" for j in range(60))
    rows = [(i if i < 6 else None, body(0) + "\n" + body(1), "h") for i in range(12)]
    rows += [(20 + i, body(20 + i) + "\n" + body(2) + " common" * 20, "h") for i in range(11)]
    rows += [(40 + i, body(40 + i), "h") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = plain(quality_rules.judge(docs), "doc_id", "kept", "n_common_lines")
    assert [r[1:] for r in got if r[0] is None or r[0] < 6] == [(True, 0)] * 12
    assert {r[2] for r in got if r[0] is not None and 20 <= r[0] < 40} == {1}
    assert sorted(got, key=key) == sorted(((r[0], r[-1], int(20 <= (r[0] or 0) < 40)) for r in brute.quality(rows)), key=key)
    assert quality_rules.keep_good(docs).count() == 123


def test_given_texts_by_the_present_rule(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("source", F.lit("one"))
    got = plain(quality_rules.judge(docs), "doc_id", "n_words", "kept")
    want = brute.quality(plain(docs, "doc_id", "text", "source"))
    assert sorted(got) == sorted((r[0], r[1], r[-1]) for r in want)


def test_stages_judge_rows_by_themselves(spark):
    """Rows without id, or with the id of a bad row, stay or go by their own text."""
    good, passage = (" ".join(f"{w}{i}" for i in range(60)) for w in ("good", "leak"))
    rows = [(None, good, "h"), (None, "too short", "h"), (7, good + " x", "h"), (7, passage, "h"), (None, passage + " more", "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    items = spark.createDataFrame([(1, " ".join(f"leak{i}" for i in range(20)))], "item_id long, text string")
    assert {r.text for r in quality_rules.keep_good(docs).collect()} == {r[1] for r in rows} - {"too short"}
    clean = decontamination.drop_contaminated(docs, items).collect()
    assert sorted((r.text for r in clean)) == sorted([good, "too short", good + " x"])


def test_rows_without_id_reach_the_target(spark):
    rows = [(None, "w " * 10 + str(i), "a") for i in range(100)] + [(i, "w " * 11, "b") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken, target = Counter(), {}
    for r in mixing.mix(docs).collect():
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 11 for s in "ab")
    again = Counter(r.text for r in mixing.sample(docs).collect() if r.source == "a")
    assert sum(again.values()) * 11 == taken["a"]


def test_stage_filters_keep_columns(odd_docs, spark):
    items = spark.createDataFrame([(1, "second line of the same text")], "item_id long, text string")
    for out in (quality_rules.keep_good(odd_docs), decontamination.drop_contaminated(odd_docs, items), mixing.sample(odd_docs)):
        assert out.columns == odd_docs.columns
        out.collect()


@pytest.mark.parametrize("which", ["odd_docs", "corpus", "no_docs"])
def test_mixing(request, which):
    docs = request.getfixturevalue(which)
    rows = plain(docs, "doc_id", "text", "source")
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(brute.WORD.findall(text or ""))
    want = brute.targets(sizes) if rows else {}
    got = plain(mixing.mix(docs), "doc_id", "source", "size", "source_size", "target", "taken")
    assert sorted((r[0], r[2]) for r in got if r[0] is not None) == sorted((d, len(brute.WORD.findall(t or ""))) for d, t, _ in rows if d is not None)
    taken, largest = Counter(), Counter()
    for doc, source, size, total, target, n in got:
        assert total == sizes[source] and target == pytest.approx(want[source])
        assert n <= 3 * size
        taken[source] += n
        largest[source] = max(largest[source], size)
    for source in sizes:
        assert abs(taken[source] - want[source]) <= 2 * largest[source]
    assert sorted(map(key, got)) == sorted(map(key, plain(mixing.mix(docs.repartition(3)), "doc_id", "source", "size", "source_size", "target", "taken")))
    if which == "corpus":
        copies = Counter(r[0] for r in plain(mixing.sample(docs), "doc_id"))
        assert copies == Counter({r[0]: r[1] for r in plain(mixing.mix(docs), "doc_id", "copies") if r[1]})


def test_many_sources_reshare(spark):
    docs = spark.createDataFrame(
        [(i, "w " * (1 if i < 30 else 400), f"s{i % 30 if i < 30 else 31 + i % 3:02d}") for i in range(90)],
        "doc_id long, text string, source string",
    )
    sizes = Counter()
    for r in docs.collect():
        sizes[r.source] += len(r.text.split())
    want = brute.targets(sizes)
    for r in mixing.mix(docs).select("source", "target").distinct().collect():
        assert r.target == pytest.approx(want[r.source])


def test_shard_table():
    table = sharding.fill_table([f"s{i}" for i in range(7)], 101)
    assert set(Counter(table).values()) <= {14, 15}
    bigger = sharding.fill_table([f"s{i}" for i in range(8)], 101)
    assert sum(a != b for a, b in zip(table, bigger)) < 40
    with pytest.raises(ValueError):
        sharding.fill_table(["a"], 100)


@pytest.mark.parametrize(("n", "slots"), [(1, 3), (7, 101), (64, 1009)])
def test_shard_table_by_preference_lists(n, slots):
    names = [f"shard-{i}" for i in range(n)]
    number = lambda name, salt: int(hashlib.sha256(f"{salt}:{name}".encode()).hexdigest()[:16], 16)
    wishes = [[(number(x, "offset") + j * (number(x, "step") % (slots - 1) + 1)) % slots for j in range(slots)] for x in names]
    owner = {}
    for turn in range(slots):
        owner[next(s for s in wishes[turn % n] if s not in owner)] = turn % n
    assert sharding.fill_table(names, slots) == [owner[s] for s in range(slots)]


def test_sharding(odd_docs, corpus, no_docs, spark, tmp_path):
    table = sharding.fill_table([f"shard-{i:05d}" for i in range(sharding.SHARDS)], sharding.SLOTS)
    out = sharding.assign(corpus)
    for r in out.collect():
        assert r.shard == table[r.slot]
    assert out.count() == corpus.count() and sharding.assign(no_docs).count() == 0
    odd = sharding.assign(odd_docs).collect()
    assert len({r.shard for r in odd if r.doc_id is None}) == 1 and len(odd) == odd_docs.count()
    sharding.write_shards(corpus, str(tmp_path / "out"), 8, 101)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.groupBy("shard").agg(F.count("*")).count() == 8 and back.count() == corpus.count()


@pytest.mark.parametrize("which", ["odd_docs", "corpus", "no_docs"])
def test_decontamination(request, spark, which):
    docs = request.getfixturevalue(which)
    items = spark.createDataFrame(
        [(1, "second LINE of the same text"), (2, "a b"), (3, None), (4, "--"), (5, "w1 zeta1 w4 Zeta2"), (12, "a b"),
         (6, "x"), (None, "first and the last")], "item_id long, text string")
    if which == "corpus":
        items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").union(items.filter("item_id <= 4"))
    found = decontamination.contamination(docs, items)
    got = [(*r[:4], brute.sha(",".join(r[4])), r[5]) for r in plain(found, "doc_id", "n_words", "n_hit", "n_items", "item_ids", "contaminated")]
    want = brute.hits(plain(docs, "doc_id", "text"), [r for r in plain(items, "item_id", "text") if r[0] is not None])
    if which == "corpus":
        assert sorted(got, key=key) == sorted(want, key=key)
        assert sum(r[5] for r in got) > 2
    else:
        listed = lambda rows: sorted([(r[0], r[1], r[3], r[4]) for r in rows], key=key)
        assert listed(got) == listed(want)
    assert all(r[2] == 0 for r in plain(decontamination.contamination(docs, items.limit(0)), "doc_id", "n_words", "n_hit"))
