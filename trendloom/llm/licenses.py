"""License scans by diagonal voting, with DataFrame functions only.

Texts and templates become lower-cased words.  The hash of every run of ``K`` words of a
text is joined with the positions of that run in the license templates.  A hit lies on
the diagonal (text position - template position); hits are counted per diagonal band,
neighbouring bands are merged, and a merged span is verified by the share of the
template's runs that it holds in order.  Besides, base phrases are found wherever
their words stand next to each other.

The templates are a table of the caller (or ``TEMPLATES``).  Their runs are counted: up to
``MAX_RUNS`` they are broadcast and only hits are shuffled, beyond that the runs of the
texts are shuffled to them.

Defined results: null and empty texts have no words, no labels and score 0; rows that
share a ``doc_id`` are judged one by one, rows that share id and text alike; of equally good
spans all labels count; very long texts are read whole; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import materialize

K = 5
#: Diagonals that differ by less than this many words count as one (words put in or left out).
BAND = 8
MIN_SCORE = 0.4
#: Template runs (of under 100 bytes each) that may be broadcast.
MAX_RUNS = 100_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases with their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Opening notices of common licenses, as words, with their labels.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("cc", "licensed under cc by nc 4 0"),
    ("mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation the"
        " rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit"
        " persons to whom the software is furnished to do so subject to the following conditions"
    ),
    ("mit",
        "the software is provided as is without warranty of any kind express or implied including but not limited to the"
        " warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors"
        " or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or"
        " otherwise arising from out of or in connection with the software or the use or other dealings in the software"
    ),
    ("apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the"
        " license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by"
        " applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"
        " without warranties or conditions of any kind either express or implied"
    ),
    ("gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public"
        " license as published by the free software foundation either version 3 of the license or at your option any later"
        " version this program is distributed in the hope that it will be useful but without any warranty without even the"
        " implied warranty of merchantability or fitness for a particular purpose"
    ),
    ("bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the"
        " following conditions are met redistributions of source code must retain the above copyright notice this list of"
        " conditions and the following disclaimer"
    ),
    ("mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not"
        " distributed with this file you can obtain one at http mozilla org mpl 2 0"
    ),
    ("isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"
        " provided that the above copyright notice and this permission notice appear in all copies"
    ),
    ("cc",
        "this work is licensed under a creative commons attribution 4 0 international license to view a copy of this license"
        " visit http creativecommons org licenses by 4 0"
    ),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _spaced(text: Column) -> Column:
    """The words of a text with one space before each and one behind the last; "" without words."""
    flat = F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), SEPARATORS, " "))
    return F.when(flat == "", F.lit("")).otherwise(F.concat(F.lit(" "), flat, F.lit(" ")))


def _runs(words: Column) -> Column:
    """Hashes of all runs of K words, by position; ``words`` must be a column, or each run would split the text."""
    joined = F.transform(
        F.sequence(F.lit(1), F.size(words) - K + 1), lambda i: F.xxhash64(F.slice(words, i, K))
    )
    return F.when(F.size(words) >= K, joined).otherwise(F.array().cast("array<long>"))


def template_table(spark: SparkSession, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    rows = [(i, label, text) for i, (label, text) in enumerate(templates)]
    return spark.createDataFrame(rows, "template int, label string, text string")


def _phrase_starts(spaced: Column, phrase: str) -> Column:
    """Word numbers at which a phrase stands.  Neighbouring matches may share a word's space."""
    mark = f" {phrase}(?= )"
    n = len(phrase.split())
    before = F.split(spaced, mark, -1)
    spaces = F.transform(before, lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))))
    pieces = F.size(before) - 1
    starts = F.transform(
        F.sequence(F.lit(1), pieces),
        lambda i: F.aggregate(F.slice(spaces, F.lit(1), i), F.lit(0), lambda a, x: a + x) + (i - 1) * n,
    )
    return F.when(spaced.contains(f" {phrase} "), starts).otherwise(F.array().cast("array<int>"))


def _in_order(hits: Column) -> Column:
    """How many different template positions the hits ``(at, -t_at)``, sorted, hold in rising order (the longest such chain).

    ``ends[n]`` is the lowest position on which a chain of ``n + 1`` ends.  Positions of one
    word of the text come in falling order, so a chain takes one of them at most.
    """

    def add(ends: Column, hit: Column) -> Column:
        at = -hit["back"]
        n = F.size(F.filter(ends, lambda end: end < at))
        return F.concat(F.slice(ends, F.lit(1), n), F.array(at), F.slice(ends, n + 2, F.size(ends)))

    return F.aggregate(hits, F.array().cast("array<int>"), add, F.size)


def spans(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """Verified template spans: ``row, template, label, first_word, last_word, score`` of ``docs (row, spaced)``."""
    own = (
        templates.select("template", "label", F.split(F.trim(_spaced(F.col("text"))), " ").alias("words"))
        .select("template", "label", (F.size("words") - K + 1).alias("t_runs"),
                F.posexplode(_runs(F.col("words"))).alias("t_at", "run"))
    )
    own = materialize(docs.sparkSession, own, "templates")
    own = F.broadcast(own) if own.count() <= MAX_RUNS else own.hint("merge")
    hits = (
        docs.select("row", F.split(F.trim("spaced"), " ").alias("words"))
        .select("row", F.posexplode(_runs(F.col("words"))).alias("at", "run"))
        .join(own, "run")
        .select("row", "template", "label", "t_runs", "at", "t_at", F.floor((F.col("at") - F.col("t_at")) / BAND).alias("band"))
    )
    bands = hits.groupBy("row", "template", "label", "t_runs", "band").agg(F.collect_set(F.struct("at", (-F.col("t_at")).alias("back"))).alias("hits"))
    before = Window.partitionBy("row", "template").orderBy("band")
    merged = (
        bands.withColumn("new", F.coalesce(F.col("band") - F.lag("band").over(before) > 1, F.lit(True)).cast("int"))
        .withColumn("span", F.sum("new").over(before))
        .groupBy("row", "template", "label", "t_runs", "span").agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"))
        .select("row", "template", "label", "span", F.col("hits")[0]["at"].alias("first_word"),
                (F.element_at("hits", -1)["at"] + K - 1).alias("last_word"), (_in_order(F.col("hits")) / F.col("t_runs")).alias("score"))
    )
    return merged.filter(F.col("score") >= MIN_SCORE).drop("span")


def scan(docs: DataFrame, templates: DataFrame | None = None, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """One row per document: words, base places and labels, labels of both, score (best verified template)."""
    spark = docs.sparkSession
    templates = templates if templates is not None else template_table(spark)
    # Rows with one id and one text have one result, so both passes name them alike.
    row = F.concat_ws("-", F.col("doc_id").cast("string"), F.xxhash64("text").cast("string"))
    spaced = docs.select(F.col("doc_id").cast("long"), row.alias("row"), _spaced(F.col("text")).alias("spaced"))
    found = {p: _phrase_starts(F.col("spaced"), p) for p in phrases}
    starts = F.array_sort(F.concat(*found.values()))
    base = F.array_sort(
        F.array_distinct(F.filter(F.array(*[F.when(F.size(found[p]) > 0, F.lit(v)) for p, v in phrases.items()]), lambda x: x.isNotNull()))
    )
    gaps = F.length("spaced") - F.length(F.replace("spaced", F.lit(" "), F.lit("")))
    counted = spaced.select(
        "doc_id", "row", F.greatest(gaps - 1, F.lit(0)).cast("long").alias("n_words"), starts.alias("starts"), base.alias("base")
    )
    best = materialize(
        spark,
        spans(spaced, templates).groupBy(F.col("row").alias("r"))
        .agg(F.collect_set("label").alias("more"), F.max("score").alias("score")),
        "license-spans",
    )
    labels = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", F.array().cast("array<string>")))))
    return counted.join(best, F.col("row") == F.col("r"), "left").select(
        "doc_id", "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        F.concat_ws(",", "base").alias("base_labels"), F.concat_ws(",", labels).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
