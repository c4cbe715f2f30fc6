"""Line dedup as an exact set-similarity join, with DataFrame functions only.

A line is the set of its words (in lower case, split at white space).  A line goes if an
earlier line, by (doc_id, hash of the text, line number), has the same set or one with Jaccard similarity
of at least ``PERCENT`` %.

Lines with one set are one class; counting them combines before the shuffle, so a line
of every document costs one row per task.  Tokens are 63-bit numbers that sort by rarity:
the rank of the word's slot in a table of ``SLOTS`` counts over the whole corpus, told in 64 steps before, then the
word's hash.  Two similar sets have two tokens in common
that follow each other in both, and not far from the start: with ``h`` words in only one
of the sets, at most ``h + 1`` common ones stand alone before that.  Such pairs of
neighbours are the keys by which sets meet.  Sets that meet by chance are told by what
follows: where similar sets first have two neighbours in common, each common token before stands alone, so a third of
the tokens before, counted in both, are in one set only, and the later the meeting, the less may differ after it.  Sizes,
places and parity bitmaps of the steps after the neighbours, which cannot differ in more bits than the tokens there, are
dealt with the keys.  Then sets are told by their first tokens.

Sets that meet get a family: that of the smallest set that they meet and may be similar to.  Within a
family nothing is paired.  A set is told by its ``d`` words that differ from the family's
centre, the words of most members; two sets differ in as many words as both do from the centre,
less twice the differences that they share.  Without shared ones a link depends on one number per set
only and links are counted on the numbers' histogram.  Pairs that are links only by what they share, and
pairs of different families, are listed and verified on the full token sets.
Texts without candidates are told by a bitmap of fixed size and not shuffled for that.
The table of counts has a fixed size, too; words that only a line break parts count as one there.

All links between different classes are found; copies are never paired.  ``percent`` is at least 50.

Defined results: lines without words are kept and not counted; null and empty texts have
no lines; rows are told apart by id and text, so rows that share an id, or have none, are
judged by themselves; rows that share both count once in the order but each gets a result; a
null id comes first in the order.  An empty table gives no rows; very long texts and lines are
taken whole.  Other columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

PERCENT = 80
SLOTS = 1 << 14
#: Sets that a key may have for all of them to be compared with each other.
FEW = 8
#: 64-bit numbers of the bitmap of documents that hold candidates.
MAP = 1 << 14


def _odd() -> Column:
    """Whether ``text`` has white space but blanks and line ends; most have none, and blanks alone are split faster."""
    return F.col("text").rlike(r"[\x09\x0B-\x0D]")


def _split(text: str) -> Column:
    """Words of a line of a text that may be ``odd``, in lower case, with empty ones."""
    return F.when(F.col("odd"), F.split(F.lower(text), r"[\x20\x09-\x0D]+")).otherwise(F.split(F.lower(text), " "))


def _words(lines: DataFrame) -> DataFrame:
    """``words`` instead of ``odd`` and ``line``, for lines that have any."""
    split = lines.withColumn("words", F.array_remove(_split("line"), "")).drop("odd", "line")
    return split.filter(F.size("words") > 0)


def _lines(docs: DataFrame) -> DataFrame:
    """``doc_id, row, line_no, words`` of all lines with a word."""
    told = docs.withColumn("odd", _odd())
    return _words(told.select("doc_id", "row", "odd", F.posexplode(F.split("text", "\n")).alias("line_no", "line")))


def _bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(63).cast("int"))


def word_ranks(docs: DataFrame) -> Column:
    """For every slot of word hashes ``step * SLOTS + rank`` by the words in it, 64 steps: a constant of ``SLOTS`` numbers."""
    words = docs.withColumn("odd", _odd()).select(F.explode(_split("text")).alias("word"))
    counts = words.groupBy(F.xxhash64("word").bitwiseAND(SLOTS - 1).cast("int").alias("slot")).agg(F.count("*").alias("n"))
    n = dict(counts.collect())
    most = sum(n.values()) / 64  # what a line holds once is no more than one step
    weights = {slot: min(c, most) for slot, c in n.items()}
    total, before, ranks = sum(weights.values()), 0, [0] * SLOTS
    for rank, slot in enumerate(sorted(range(SLOTS), key=lambda s: (n.get(s, 0), s))):
        ranks[slot] = min(int(64 * before / max(total, 1)), 63) * SLOTS + rank
        before += weights.get(slot, 0)
    return F.from_json(F.lit(json.dumps(ranks)), "array<int>")


def _step(token: Column) -> Column:
    """Which of 64 steps of rarity a token is in; it does not fall along a set's tokens."""
    return F.shiftright(token, 57).cast("int")


def _tokens(lines: DataFrame, ranks: Column) -> DataFrame:
    """``tokens`` instead of ``words``: the line's distinct tokens, rarest first."""

    def token(w: Column) -> Column:
        h = F.xxhash64(w)
        rank = F.get(ranks, h.bitwiseAND(SLOTS - 1).cast("int")).cast("long")
        return F.shiftleft(rank, 43).bitwiseOR(F.shiftrightunsigned(h, 21))

    ids = lines.withColumn("ids", F.transform("words", token)).drop("words")
    return ids.withColumn("tokens", F.sort_array(F.array_distinct("ids"))).drop("ids")


def _reach(size: Column, percent: int) -> Column:
    """So many first tokens of a set hold two neighbours that any similar set has as neighbours, too."""
    own = F.floor(size * (100 - percent) / 100)
    return (own + F.floor((size - own) * (100 - percent) / percent) + 2).cast("int")


def _classes(docs: DataFrame, ranks: Column, percent: int) -> DataFrame:
    """Distinct sets: ``id, size, first, heads, x``."""
    size = F.size("tokens")
    # the step, and 25 bits of rank and hash
    folded = lambda x: F.shiftleft(_step(x), 25).bitwiseOR(F.shiftright(x, 25).bitwiseXOR(x).bitwiseAND(0x1FFFFFF).cast("int"))
    keyed = _tokens(_lines(docs), ranks).select(
        F.xxhash64("tokens").alias("set"), F.xxhash64(F.lit(77), "tokens").alias("check"), size.alias("size"),
        F.struct("doc_id", "row", "line_no").alias("at"),
        F.transform(F.slice("tokens", 1, _reach(size, percent)), folded).alias("heads"),
        # 64 bits, of which each token flips that of its step; so few flips mean few tokens.
        F.aggregate("tokens", F.lit(0).cast("long"), lambda all_, x: all_.bitwiseXOR(_bit(_step(x)))).alias("x"),
    )
    sets = keyed.groupBy("set", "check", "size").agg(F.min("at").alias("first"), F.any_value("heads").alias("heads"), F.any_value("x").alias("x"))
    return sets.select(F.monotonically_increasing_id().alias("id"), "size", "first", "heads", "x")


def _fits(a: dict[str, Column], b: dict[str, Column], percent: int) -> Column:
    """Whether sets of sizes ``n`` may be similar and have their first two common neighbours from the ``i``-th token on,
    with the bitmap ``x`` of later tokens."""
    na, nb = a["n"], b["n"]
    after = 3 * (100 - percent) * (na + nb) - (100 + percent) * (a["i"] + b["i"])
    most = lambda differences: 3 * (100 + percent) * differences <= after
    sizes = 100 * F.least(na, nb) >= percent * F.greatest(na, nb)
    return sizes & most(F.abs(na - a["i"] - nb + b["i"])) & most(F.bit_count(a["x"].bitwiseXOR(b["x"])))


def _keys(classes: DataFrame, percent: int) -> DataFrame:
    """``key, id, n, i, x`` of the neighbours ``i`` and ``i + 1`` of a set, ``x`` the bitmap of steps after that of ``i``."""
    # A set so small that a partner must be equal to it has none.
    some = classes.filter(F.floor(F.col("size") * 100 / percent) > F.ceil(F.col("size") * percent / 100))
    n = F.size("heads") - 1
    each = F.posexplode(F.arrays_zip(F.slice("heads", F.lit(1), n).alias("h"), F.slice("heads", F.lit(2), n).alias("j"))).alias("i", "k")
    # 40 bits: keys that are equal by chance are few against 2 ** 40, and zeros cost little in a shuffle.
    key = F.shiftleft(F.xxhash64("k.h", "k.j"), 24)
    later = F.call_function("shiftleft", F.lit(-2).cast("long"), F.shiftright("k.h", 25))
    return some.select("id", F.col("size").alias("n"), "x", each).select(key.alias("key"), "id", "n", "i", F.col("x").bitwiseAND(later).alias("x"))


def _meetings(classes: DataFrame, percent: int) -> DataFrame:
    """``key, id, n, i, x, many, other`` of sets that share a key with a smaller set ``other`` that they may be similar to.

    Of a key that more than ``FEW`` sets have, each is one row, and the only other one is the smallest, or none.
    """
    same = Window.partitionBy("key").orderBy("id")
    whole = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    met = _keys(classes, percent).withColumn("c", F.count("*").over(whole)).filter("c > 1")
    one = F.struct("id", "n", "i", "x")
    many = F.col("c") > FEW
    others = [F.when(many, F.first(one).over(whole)), *(F.when(~many, F.lag(one, k).over(same)) for k in range(1, FEW))]
    beside = met.select("key", "id", "n", "i", "x", many.alias("many"), *(other.alias(f"o{k}") for k, other in enumerate(others)))
    pairs = beside.select("key", "id", "n", "i", "x", "many", F.explode(F.array(*(f"o{k}" for k in range(FEW)))).alias("o")).filter("o is not null")
    fits = (F.col("o.id") < F.col("id")) & _fits({c: F.col(f"o.{c}") for c in "nix"}, {c: F.col(c) for c in "nix"}, percent)
    told = pairs.select("key", "id", "n", "i", "x", "many", F.when(fits, F.col("o.id")).alias("other"))
    return told.filter(F.col("many") | F.col("other").isNotNull())


def _stars(meetings: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of a set and a smaller one that meet and may be similar."""
    return meetings.filter("other is not null").select(F.col("other").alias("a"), F.col("id").alias("b")).distinct()


def _alike(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The ``pairs (a, b)`` that may be similar by all of their first tokens."""
    near = classes.filter(_maybe_in(pairs.select(F.explode(F.array("a", "b")).alias("id")), "id"))
    side = lambda s: near.select(F.col("id").alias(s), F.col("size").alias(f"n{s}"), F.col("heads").alias(f"h{s}"))
    na, nb = F.col("na"), F.col("nb")
    most = F.floor((na + nb) * (100 - percent) / (100 + percent))
    # Where one's first tokens end sooner than the other's, those not among the other's are words that the other set lacks.
    lacks = (2 * F.size(F.array_except("ha", "hb")) <= most + na - nb) | (2 * F.size(F.array_except("hb", "ha")) <= most + nb - na)
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(lacks).select("a", "b")


def _maybe_in(ids: DataFrame, column: str) -> Column:
    """Whether ``column`` may be among ``ids (id)``, by a bitmap of ``64 * MAP`` bits: never wrong for one that is."""
    h = F.xxhash64(F.lit(9), "id")
    words = ids.groupBy(F.shiftright(h, 6).bitwiseAND(MAP - 1).cast("int").alias("at")).agg(F.bit_or(_bit(h)).alias("bits"))
    held = dict(words.collect())
    bitmap = F.from_json(F.lit(json.dumps([held.get(i, 0) for i in range(MAP)])), "array<bigint>")
    mine = F.xxhash64(F.lit(9), column)
    return F.get(bitmap, F.shiftright(mine, 6).bitwiseAND(MAP - 1).cast("int")).bitwiseAND(_bit(mine)) != 0


def _sets(docs: DataFrame, ranks: Column, wanted: DataFrame) -> DataFrame:
    """``id, first, n, tokens`` of the ``wanted (id, first)`` sets, from the texts where they stand first."""
    spark = docs.sparkSession
    asked = wanted.groupBy(F.col("first.doc_id").alias("f_id"), F.col("first.row").alias("f_row")).agg(
        F.map_from_entries(F.collect_list(F.struct("first.line_no", "id"))).alias("f_lines")
    )
    asked = materialize(spark, asked, "asked")
    near = docs.filter(_maybe_in(asked.select(F.col("f_row").alias("id")), "row"))
    texts = near.join(asked.hint("merge"), (F.col("row") == F.col("f_row")) & F.col("doc_id").eqNullSafe(F.col("f_id")))
    found = texts.withColumn("odd", _odd()).select("doc_id", "row", "odd", "f_lines", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    found = found.withColumn("id", F.col("f_lines")[F.col("line_no")]).drop("f_lines").filter(F.col("id").isNotNull())
    sets = _tokens(_words(found), ranks).dropDuplicates(["id"])
    return sets.select("id", F.struct("doc_id", "row", "line_no").alias("first"), F.size("tokens").alias("n"), "tokens")


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs (a, b)`` of sets that are links."""
    side = lambda s: sets.select(F.col("id").alias(s), F.col("tokens").alias(f"{s}_tokens"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    shared = F.size(F.array_intersect("a_tokens", "b_tokens"))
    union = F.size("a_tokens") + F.size("b_tokens") - shared
    return both.filter(100 * shared >= percent * union).select("a", "b")


def families(stars: DataFrame, ids: DataFrame) -> DataFrame:
    """``id, family`` of all ``ids``, from the pairs ``stars (a, b)``: the smallest ``a`` of a set, or of that one."""
    low = stars.groupBy("b").agg(F.min("a").alias("a"))
    far = low.select(F.col("b").alias("a"), F.col("a").alias("further"))
    root = low.join(far, "a", "left").select(F.col("b").alias("id"), F.coalesce("further", "a").alias("root"))
    return ids.join(root, "id", "left").select("id", F.coalesce("root", "id").alias("family"))


def _members(sets: DataFrame, family: DataFrame, percent: int) -> DataFrame:
    """``family, id, first, n, other, v`` of families of several sets.

    ``other``: the words in only one of the set and its centre; two sets that share ``c`` of these
    are a link if the sum of their ``v`` is at most ``2 * (100 + percent) * c``.
    """
    several = family.groupBy("family").agg(F.count("*").alias("members")).filter("members > 1")
    own = sets.join(family, "id").join(several, "family")
    usual = own.select("family", "members", F.explode("tokens").alias("token")).groupBy("family", "members", "token").agg(F.count("*").alias("c"))
    centre = usual.filter(2 * F.col("c") > F.col("members")).groupBy("family").agg(F.collect_list("token").alias("centre"))
    other = F.concat(F.array_except("tokens", "centre"), F.array_except("centre", "tokens"))
    told = own.join(centre, "family", "left").withColumn("centre", F.coalesce("centre", F.array().cast("array<bigint>")))
    v = (100 + percent) * F.size("other") - (100 - percent) * F.col("n")
    return told.select("family", "id", "first", "n", other.alias("other")).withColumn("v", v)


def _within(members: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links within families: ``id, links, low`` by numbers alone, and the pairs ``a, b`` that are links by what they share."""
    kinds = members.groupBy("family", "v").agg(F.count("*").alias("c"), F.min("first").alias("low"))
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    at = kinds.schema["low"].dataType
    asks = kinds.select("family", (-F.col("v")).alias("at"), F.col("v").alias("of"), F.lit(0).cast("long").alias("c"), none("low", at))
    told = kinds.select("family", F.col("v").alias("at"), none("of", "int"), "c", "low").union(asks)
    up_to = Window.partitionBy("family").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    sums = told.select("family", "of", F.sum("c").over(up_to).alias("links"), F.min("low").over(up_to).alias("low")).filter(F.col("of").isNotNull())
    by_number = members.join(sums.withColumnRenamed("of", "v"), ["family", "v"]).select(
        "id", (F.col("links") - (F.col("v") <= 0).cast("long")).alias("links"), "low"
    )
    most = members.groupBy("family").agg(F.max("v").alias("most"))
    far = members.join(most, "family").filter(F.col("v") + F.col("most") > 0)
    side = lambda s: far.select("family", F.explode("other").alias("token"), F.col("id").alias(s), F.col("v").alias(f"v{s}"), F.size("other").alias(f"d{s}"))
    total, each = F.col("va") + F.col("vb"), 2 * (100 + percent)
    shared = (
        side("a").join(side("b"), ["family", "token"])
        .filter((F.col("a") < F.col("b")) & (total > 0) & (total <= each * F.least("da", "db")))
        .groupBy("a", "b").agg(F.count("*").alias("c"), F.any_value(total).alias("total")).filter(F.col("total") <= each * F.col("c"))
    )
    return by_number, shared.select("a", "b")


def _across(meetings: DataFrame, stars: DataFrame, family: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of sets of different families that meet and may be similar."""
    of = lambda s: family.select(F.col("id").alias(s), F.col("family").alias(f"f{s}"))
    apart = stars.join(of("a"), "a").join(of("b"), "b").filter("fa <> fb").select("a", "b")
    # Where few sets meet, all pairs of them are told; where many do, others may be similar.
    same = Window.partitionBy("key")
    many = meetings.filter("many").select("key", "id", "n", "i", "x").join(family, "id", "left").withColumn("family", F.coalesce("family", "id"))
    mixed = many.select("*", F.min("family").over(same).alias("f"), F.max("family").over(same).alias("g")).filter("f < g").drop("f", "g")
    side = lambda s: mixed.select("key", F.col("id").alias(s), F.col("family").alias(f"f{s}"), *(F.col(c).alias(f"{c}{s}") for c in "nix"))
    of_side = lambda s: {c: F.col(f"{c}{s}") for c in "nix"}
    fits = (F.col("a") < F.col("b")) & (F.col("fa") != F.col("fb")) & _fits(of_side("a"), of_side("b"), percent)
    return apart.union(side("a").join(side("b").hint("merge"), "key").filter(fits).select("a", "b")).distinct()


def links(docs: DataFrame, ranks: Column, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``id, links, low`` of sets with links: their number, and where the earliest of the linked sets, or it itself, stands."""
    spark = docs.sparkSession
    meetings = materialize(spark, _meetings(classes, percent), "meetings")
    stars = materialize(spark, _alike(materialize(spark, _stars(meetings), "met"), classes, percent), "stars")
    family = materialize(spark, families(stars, stars.select(F.explode(F.array("a", "b")).alias("id")).distinct()), "families")
    across = materialize(spark, _across(meetings, stars, family, percent), "across")
    across = materialize(spark, _alike(across, classes, percent), "pairs")
    several = family.groupBy("family").agg(F.count("*").alias("c")).filter("c > 1").select("family")
    near = family.join(several, "family", "left_semi").select("id").union(across.select(F.explode(F.array("a", "b")))).distinct()
    sets = materialize(spark, _sets(docs, ranks, classes.select("id", "first").join(near, "id", "left_semi")), "sets")
    members = materialize(spark, _members(sets, family, percent), "members")
    by_number, shared = _within(members, percent)
    pairs = materialize(spark, shared.union(_similar(across, sets, percent)), "links")
    both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    listed = both.join(sets.select(F.col("id").alias("b"), "first"), "b").groupBy(F.col("a").alias("id")).agg(
        F.count("*").alias("links"), F.min("first").alias("low")
    )
    all_ = by_number.union(listed).groupBy("id").agg(F.sum("links").alias("links"), F.min("low").alias("low"))
    return materialize(spark, all_.filter("links > 0"), "linked")


def dedup_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_removed, n_links, kept_lines`` (numbers from 0, in order).

    ``n_links``: links of the sets that stand first in this document to other sets.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("row", F.xxhash64("text"))
    ranks = word_ranks(docs)
    classes = materialize(spark, _classes(docs, ranks, percent), "line-sets")
    linked = links(docs, ranks, classes, percent)
    judged = classes.select("id", "first").join(linked, "id", "left").withColumn("later", F.col("low") < F.col("first"))
    per = judged.groupBy(F.col("first.doc_id").alias("k_id"), F.col("first.row").alias("k_row")).agg(
        F.array_sort(F.collect_list(F.when(~F.coalesce("later", F.lit(False)), F.col("first.line_no")))).alias("kept"),
        F.sum(F.coalesce("links", F.lit(0))).alias("links"),
    )
    n = F.size(F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    counted = docs.select("doc_id", "row", F.when(F.col("text").isNull(), F.lit(0)).otherwise(n).cast("long").alias("n_lines"))
    kept = F.coalesce("kept", F.array().cast("array<int>"))
    return counted.join(per, (F.col("row") == F.col("k_row")) & F.col("doc_id").eqNullSafe(F.col("k_id")), "left").select(
        "doc_id", "n_lines", (F.col("n_lines") - F.size(kept)).cast("long").alias("n_removed"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.concat_ws(",", kept.cast("array<string>")).alias("kept_lines"),
    )
