"""Near-duplicate documents: SuperMinHash signatures, banding, exact verification, groups.

Texts with one shingle set are one class, found by a 128-bit hash of the set; only
the class's smallest id goes on.  SuperMinHash gives every shingle a random order of
the signature's places and ranks that grow along it, and a document is done as soon
as no further rank can lower any place.  Bands of four places are compared; the
number of bands follows the similarity asked for (a link at the limit is missed with
a chance below 1e-5).

Classes that share a band form candidate groups.  Their texts are brought together
once (a bitmap of fixed size keeps other texts out of the shuffle) and the links are
confirmed on full shingle sets.  A group larger than ``limit``
shingles is cut into blocks: every block is resolved together with a few pivots of
the group, and what is then outside the group's main component is compared with
every block.  So a group that holds a third of all documents takes work in
proportion to its size, no task gets more than some blocks, and no link is lost.
Pairs are never emitted: a task returns a spanning forest of its links.

Defined results: documents without words have no shingles and no links; a null id has
no component and is kept; rows that share an id are one document, all of them kept or
not.  Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from . import cells
from .components import components

ROWS_PER_BAND = 4
LIMIT = 500_000
PIVOTS = 32
#: 64-bit numbers, at most, of the bitmap that tells which texts a step of the comparison needs.
MAP = 1 << 18


def n_bands(percent: int, miss: float = 1e-5) -> int:
    """Bands so that a pair at the similarity shares none with a chance below ``miss``."""
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** ROWS_PER_BAND))


def shingles(t: cells.Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and hashes of distinct shingles, ordered by both."""
    _, _, text, words = t.words(cells.SPACES, lower=True)
    bounds = t.bounds(text)
    n = np.diff(bounds)
    at = np.flatnonzero(text[: max(0, len(text) - width + 1)] == text[width - 1 :])
    parts = [(text[at], cells.window_hashes(words, width)[at])]
    for w in range(1, width):  # a text of fewer words is one shingle
        short = np.flatnonzero(n == w)
        if len(short):
            parts.append((short, cells.window_hashes(words, w, salt=w + 100)[bounds[short]]))
    text, hashes = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    return text[new], hashes[new]


def super_min_hash(text: np.ndarray, hashes: np.ndarray, n: int, m: int) -> np.ndarray:
    """Signatures of ``n`` sets; place values hold the rank above 32 random bits."""
    out = np.full(n * m, np.iinfo(np.uint64).max, np.uint64)
    live, places = np.arange(len(text)), None
    draw, pick = cells.seeds(m, 21), cells.seeds(m, 22)
    half = np.uint64(32)
    for j in range(m):
        e = hashes[live]
        r = cells.mix(e + draw[j]) >> half
        k = (j + (((cells.mix(e + pick[j]) >> half) * np.uint64(m - j)) >> half)).astype(np.int64)
        if j == 0:
            place, first = k, k
        else:
            row = np.arange(len(live))
            place = places[row, k]
            places[row, k] = places[row, j]
        np.minimum.at(out, text[live] * m + place, (np.uint64(j) << half) | r)
        open_texts = out.reshape(n, m).max(axis=1) >= (np.uint64(j + 1) << half)
        more = open_texts[text[live]]
        if not more.any():
            break
        if j == 0:
            first = first[more]
            places = np.tile(np.arange(m, dtype=np.uint8), (len(first), 1))
            places[np.arange(len(first)), first] = 0
        else:
            places = places[more]
        live = live[more]
    return out.reshape(n, m)


def _scan(width: int, bands: int):
    def run(batches):
        salt = cells.seeds(ROWS_PER_BAND, 31)
        for batch in batches:
            for t in cells.texts_of(batch.column("text")):
                text, hashes = shingles(t, width)
                bounds = t.bounds(text)
                sig = super_min_hash(text, hashes, t.n, bands * ROWS_PER_BAND).reshape(t.n, bands, ROWS_PER_BAND)
                keys = np.zeros((t.n, bands), np.uint64)
                for i in range(ROWS_PER_BAND):
                    keys += sig[:, :, i] * salt[i]
                keys = cells.mix(keys + np.arange(bands, dtype=np.uint64))
                size = np.diff(bounds)
                full = np.where(size > 0)[0]
                sums = [np.zeros(t.n, np.uint64) for _ in range(2)]
                for s, salt2 in zip(sums, cells.seeds(2, 41)):
                    if len(full):
                        s[full] = np.add.reduceat(cells.mix(hashes ^ salt2), bounds[full])
                held = np.where(size > 0, bands, 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[t.lo : t.lo + t.n], pa.array(size.astype(np.int64)),
                        pa.array(cells.signed(sums[0])), pa.array(cells.signed(sums[1])),
                        cells.lists(cells.signed(keys[full].ravel()), np.concatenate([[0], np.cumsum(held)]), pa.int64()),
                    ],
                    ["doc_id", "n_shingles", "h1", "h2", "bands"],
                )

    return run


def _forest(width: int, percent: int):
    """For the texts of a task's share: a spanning forest of the links within each ``family``."""

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("doc_id").to_numpy()
        family = table.column("family").to_numpy()
        texts, codes = [], []
        for t in cells.texts_of(table.column("text")):
            text, hashes = shingles(t, width)
            texts.append(text + t.lo)
            codes.append(hashes)
        text = np.concatenate(texts)
        _, code = np.unique(np.concatenate(codes), return_inverse=True)
        bounds = np.searchsorted(text, np.arange(len(ids) + 1))
        mark = np.zeros(len(code) + 1, bool)
        edges = []
        order = np.argsort(family, kind="stable")
        for members in np.split(order, np.flatnonzero(np.diff(family[order])) + 1):
            edges += _family_forest(ids, members, code, bounds, mark, percent)
        a, b = zip(*edges) if edges else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _family_forest(ids, members, code, bounds, mark, percent):
    sizes = bounds[members + 1] - bounds[members]
    own = np.concatenate([code[bounds[i] : bounds[i + 1]] for i in members])
    at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    group = np.arange(len(members))
    expanded = np.zeros(len(members), bool)
    edges = []
    while True:
        # What lies outside the largest component must be compared with everything.
        largest = np.bincount(group).argmax()
        open_ = np.flatnonzero(~expanded & (group != largest)) if expanded.any() else np.arange(len(members))
        if not len(open_):
            return edges
        i = open_[0]
        expanded[i] = True
        mine = code[bounds[members[i]] : bounds[members[i] + 1]]
        mark[mine] = True
        both = np.add.reduceat(mark[own].astype(np.int64), at)
        mark[mine] = False
        near = np.flatnonzero((100 * both >= percent * (sizes + sizes[i] - both)) & (group != group[i]))
        for j in near:
            if group[j] != group[i]:
                edges.append((int(ids[members[i]]), int(ids[members[j]])))
                group[group == group[j]] = group[i]


def _maybe_members(docs: DataFrame, members: DataFrame) -> DataFrame:
    """``docs`` without most of those whose id is no ``node``, by a bitmap of ``64 * MAP`` bits: all members stay."""
    h = lambda c: F.xxhash64(F.lit(9), F.col(c).cast("long"))
    at = lambda c: F.shiftright(h(c), 6).bitwiseAND(MAP - 1)
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), h(c).bitwiseAND(63).cast("int"))
    words = members.groupBy(at("node").alias("_at")).agg(F.bit_or(bit("node")).alias("_bits"))
    # Bounded whatever the number of members is, so a side to broadcast.
    held = docs.withColumns({"_word": at("doc_id"), "_bit": bit("doc_id")}).join(F.broadcast(words), F.col("_word") == F.col("_at"))
    return held.filter(F.col("_bits").bitwiseAND(F.col("_bit")) != 0).select(*docs.columns)


def _links(docs: DataFrame, members: DataFrame, width: int, percent: int, keys: list[str]) -> DataFrame:
    """Links among the texts of ``members (node, family, *keys)``, each share of equal keys by itself."""
    # The members grow with the documents: never a side to broadcast, whatever a small run would choose.
    shares = _maybe_members(docs, members).join(members.hint("merge"), F.col("doc_id") == F.col("node")).select(
        *dict.fromkeys(["doc_id", "text", "family", *keys])
    )
    return shares.groupBy(*keys).applyInArrow(_forest(width, percent), "a long, b long")


def _verified(docs: DataFrame, families: DataFrame, sizes: DataFrame, width: int, percent: int, limit: int) -> DataFrame:
    """Exact links within candidate families ``(node, component)``."""
    spark = docs.sparkSession
    sized = families.join(sizes, "node").select("node", F.col("component").alias("family"), "n_shingles")
    totals = sized.groupBy("family").agg(F.sum("n_shingles").alias("total"))
    nodes = materialize(
        spark, sized.join(totals, "family").withColumn("blocks", F.ceil(F.col("total") / limit).cast("int")), "families"
    )
    small = nodes.filter("blocks <= 1")
    shares = max(1, math.ceil((small.agg(F.sum("n_shingles")).first()[0] or 0) / limit))
    packed = small.select("node", "family", F.pmod(F.xxhash64("family"), F.lit(shares)).alias("share"))
    links = materialize(spark, _links(docs, packed, width, percent, ["share"]), "links")
    large = nodes.filter("blocks > 1").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    if large.limit(1).count():
        links = links.union(_large_links(docs, materialize(spark, large, "large"), width, percent, limit))
    return links


def _large_links(docs: DataFrame, large: DataFrame, width: int, percent: int, limit: int) -> DataFrame:
    spark = docs.sparkSession
    keys = ["family", "block"]
    # Pivots: the smallest of a hash, by combining sets of bounded size.
    sample = large.groupBy("family", "blocks", F.pmod(F.xxhash64(F.lit(5), "node"), F.lit(PIVOTS)).alias("p")).agg(
        F.min("node").alias("node")
    )
    everywhere = sample.select("node", "family", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    first = materialize(
        spark,
        _links(docs, large.select("node", *keys).union(everywhere.select("node", *keys)).distinct(), width, percent, keys),
        "links",
    )
    known = large.join(components(first).withColumnRenamed("node", "k"), F.col("node") == F.col("k"), "left").select(
        *large.columns, F.coalesce("component", "node").alias("part")
    )
    counts = known.groupBy("family", "part").agg(F.count("*").alias("n"))
    main = counts.groupBy("family").agg(F.max(F.struct("n", "part")).alias("m")).select("family", F.col("m.part").alias("main"))
    outside = materialize(spark, known.join(main, "family").filter("part <> main"), "outside")
    chunks = outside.groupBy("family").agg(F.ceil(F.sum("n_shingles") / limit).cast("int").alias("chunks"))
    chunked = outside.join(chunks, "family").withColumn("chunk", F.pmod(F.xxhash64(F.lit(3), "node"), F.col("chunks")).cast("int"))
    probes = chunked.select(
        "node", "family", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "chunk"
    )
    against = large.join(chunks, "family").select(
        "node", "family", "block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    )
    again = _links(docs, probes.union(against).distinct(), width, percent, [*keys, "chunk"])
    return first.union(materialize(spark, again, "links"))


def groups(docs: DataFrame, width: int = 5, percent: int = 80, limit: int = LIMIT) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, class_id, component_id, kept``.

    Links: ``100 * shared >= percent * all`` of the two sets of ``width``-word shingles.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    scan = materialize(
        spark,
        docs.mapInArrow(
            _scan(width, n_bands(percent)), "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>"
        ),
        "signatures",
    )
    # A text's hashes come with its bands, so any row of a class serves for them.
    classes = materialize(
        spark,
        scan.filter("n_shingles > 0 and doc_id is not null").groupBy("h1", "h2", "n_shingles")
        .agg(F.min("doc_id").alias("rep"), F.min_by("bands", "doc_id").alias("bands")),
        "classes",
    )
    keys = classes.select(F.col("rep").alias("node"), F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
    near = keys.join(buckets.select("key", "low"), "key").filter("node <> low").select(F.col("low").alias("a"), F.col("node").alias("b"))
    families = materialize(spark, components(near), "families")
    sizes = classes.groupBy(F.col("rep").alias("node")).agg(F.max("n_shingles").alias("n_shingles"))
    found = materialize(spark, components(_verified(docs, families, sizes, width, percent, limit)), "groups")
    members = classes.select("h1", "h2", F.col("n_shingles").alias("n"), "rep").join(
        found, F.col("rep") == F.col("node"), "left"
    ).select("h1", "h2", "n", "rep", F.coalesce("component", "rep").alias("component"))
    ids = F.col("doc_id").isNotNull()
    return (
        scan.select("doc_id", "n_shingles", "h1", "h2").alias("s")
        .join(members.alias("m"), (F.col("s.h1") == F.col("m.h1")) & (F.col("s.h2") == F.col("m.h2"))
              & (F.col("s.n_shingles") == F.col("m.n")) & ids, "left")
        .select("doc_id", "n_shingles", F.when(ids, F.coalesce("rep", "doc_id")).alias("class_id"),
                F.when(ids, F.coalesce("component", "doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, limit: int = LIMIT) -> DataFrame:
    """One document of each group, the one with the smallest id, with all its columns."""
    gone = groups(docs, width, percent, limit).filter("not kept").select(F.col("doc_id").alias("_gone_id"))
    return docs.join(gone, docs["doc_id"] == F.col("_gone_id"), "left_anti")
