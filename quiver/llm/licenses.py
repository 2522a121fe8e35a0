"""Operator 8: license scans by diagonal voting.

Templates (license texts and short phrases) are cut into word 2-grams with
their positions. All rolling 2-gram hashes of the documents join them; each
match whose words are really equal votes for its diagonal, document position
minus template position. Votes are aggregated per diagonal before any
shuffle that grows, neighbouring diagonals (words inserted or missing) are
merged, and the merged span is verified by its share of the template. Merged
diagonals are at most ``drift`` apart in all, so a span is as long as its
template but for ``drift`` words, and its words stand in the template's order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quiver.llm.common import text_of
from quiver.llm.decontam import plain_words
from quiver.session import tune

# Phrases that the contract names, and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
# Public license notices (opening or grant clauses) and labels.
NOTICES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
     " documentation files to deal in the software without restriction", "mit"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is"
     " distributed on an as is basis without warranties or conditions of any kind", "apache-2.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that"
     " the following conditions are met", "bsd"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general"
     " public license as published by the free software foundation", "gpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
)
#: Total template words up to which the positions are broadcast; more templates join by shuffle.
BROADCAST_WORDS = 200_000


def _positions(docs: DataFrame, templates: Sequence[tuple[str, str, bool]]) -> DataFrame:
    """(t, tpos, h, a, b): template 2-grams; templates are driver-held text."""
    rows = []
    for t, (phrase, _, _) in enumerate(templates):
        w = phrase.split()
        if len(w) < 2:
            raise ValueError(f"a template needs two words: {phrase!r}")
        rows += [(t, i, a, b) for i, (a, b) in enumerate(zip(w, w[1:]))]
    df = docs.sparkSession.createDataFrame(rows, "t int, tpos int, a string, b string")
    df = df.select("t", "tpos", F.xxhash64(F.xxhash64("a"), F.xxhash64("b")).alias("h"), "a", "b")
    return F.broadcast(df) if len(rows) <= BROADCAST_WORDS else df


def license_spans(texts: DataFrame, templates: Sequence[tuple[str, str, bool]], drift: int = 4,
                  coverage: float = 0.8) -> DataFrame:
    """(doc_id, k, t, first, last, share): verified spans. ``texts``: doc_id, k
    (together the key of a text), words; templates: (words, label, exact).
    ``exact`` ones must match as a whole on one diagonal; others need
    ``coverage`` of their 2-grams on diagonals within ``drift``. Of merges
    within ``drift`` of one another the best one is the span."""
    n = F.greatest(F.size("words") - 1, F.lit(0))
    # a row holds its two words alone, so a long text grows linearly in any join
    grams = texts.select("doc_id", "k", F.posexplode(F.arrays_zip(
        F.slice("words", 1, n).alias("x"), F.slice("words", 2, n).alias("y"))).alias("pos", "g"))
    grams = grams.select("doc_id", "k", "pos", "g.x", "g.y", F.xxhash64(F.xxhash64("g.x"), F.xxhash64("g.y")).alias("h"))
    hits = grams.join(_positions(texts, templates), "h").where("x = a and y = b")
    votes = (hits.groupBy("doc_id", "k", "t", (F.col("pos") - F.col("tpos")).alias("diagonal"))
             .agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.collect_set("tpos").alias("matched")))
    sizes = F.array(*[F.lit(len(p.split()) - 1) for p, _, _ in templates])
    exact = F.array(*[F.lit(e) for _, _, e in templates])
    votes = votes.withColumn("need", F.get(sizes, F.col("t"))).withColumn("exact", F.get(exact, F.col("t")))
    whole = votes.where(F.col("exact") & (F.size("matched") == F.col("need"))).select(
        "doc_id", "k", "t", F.col("lo").alias("first"), (F.col("hi") + 1).alias("last"), F.lit(1.0).alias("share"))
    along = W.partitionBy("doc_id", "k", "t").orderBy("diagonal")
    ahead = along.rangeBetween(0, drift)
    near = votes.where(~F.col("exact")).select(
        "doc_id", "k", "t", "need", "diagonal", F.min("lo").over(ahead).alias("first"), (F.max("hi").over(ahead) + 1).alias("last"),
        F.size(F.array_distinct(F.flatten(F.collect_list("matched").over(ahead)))).alias("got"))
    near = near.where(F.col("got") / F.col("need") >= coverage)
    rank = F.struct("got", -F.col("diagonal"))
    spans = near.withColumn("best", F.max(rank).over(along.rangeBetween(-drift, drift)) == rank).where("best").select(
        "doc_id", "k", "t", "first", "last", (F.col("got") / F.col("need")).alias("share"))
    return whole.union(spans)


def scan_licenses(docs: DataFrame, phrases: Sequence[tuple[str, str]] = PHRASES,
                  notices: Sequence[tuple[str, str]] = NOTICES, drift: int = 4, coverage: float = 0.8,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score, span_first, span_last.

    Words are runs of letters, digits and non-ASCII characters after
    lower-casing A-Z. n_base counts the places of whole phrases; first_word
    and last_word are their smallest and largest start, null without one.
    labels adds notices found by voting; score is the best share of a
    template (1 for a whole phrase, 0 without a span); span_first and
    span_last enclose all spans. Null and empty texts have no words, empty
    labels and score 0. Null and repeated ids keep a row for each input row.
    Empty input gives no rows; extra columns are ignored.
    """
    tune(docs.sparkSession)
    templates = [(p, lab, True) for p, lab in phrases] + [(p, lab, False) for p, lab in notices]
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    texts = texts.select("doc_id", F.xxhash64("text").alias("k"), plain_words(F.col("text")).alias("words"))
    label = F.get(F.array(*[F.lit(lab) for _, lab, _ in templates]), F.col("t"))
    base = F.get(F.array(*[F.lit(e) for _, _, e in templates]), F.col("t"))
    found = license_spans(texts, templates, drift, coverage).withColumn("label", label).withColumn("base", base)
    found = found.groupBy("doc_id", "k").agg(
        F.count_if("base").alias("n_base"), F.min(F.when(F.col("base"), F.col("first"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first"))).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"), F.max("share").alias("score"),
        F.min("first").alias("span_first"), F.max("last").alias("span_last"))
    x, y = texts.select("doc_id", "k", F.size("words").cast("bigint").alias("n_words")).alias("x"), found.alias("y")
    joined = x.join(y, F.col("x.doc_id").eqNullSafe(F.col("y.doc_id")) & (F.col("x.k") == F.col("y.k")), "left")
    return joined.select(
        F.col("x.doc_id").alias("doc_id"), "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        F.col("first_word").cast("bigint").alias("first_word"), F.col("last_word").cast("bigint").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), F.col("span_first").cast("bigint").alias("span_first"),
        F.col("span_last").cast("bigint").alias("span_last"))
