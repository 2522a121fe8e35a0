"""Operator 3: benchmark decontamination by size-partitioned MinHash
containment search. DataFrame functions only.

A short test item inside a long document has a tiny Jaccard similarity, so
fixed-size signatures of whole documents cannot find it. Here the sketch
belongs to the item: its smallest shingle hashes (bottom-s MinHash). Items
are partitioned by size (powers of two of their distinct shingles); within a
partition with at most n shingles, s = n - ceil(t n) + 1. A document holding
a share t of the item's shingles misses at most s - 1 of them, so it holds
at least one of the s sketch values: no contained item is lost, however long
the document is or over how many rows of one id it is spread. Candidates
are then verified by counting shared shingles as strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quiver.llm.common import lower_ascii, materialize, text_of
from quiver.session import tune

#: Sketch rows (two longs each) up to which the sketches are broadcast.
BROADCAST_ROWS = 1_000_000


def plain_words(c: Column) -> Column:
    """Lower-cased words of letters, digits and non-ASCII characters."""
    w = F.split(lower_ascii(c), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.array_remove(w, "")


def word_grams(words: str, k: int) -> Column:
    """Array of k-word shingles; fewer words: the whole sequence; none: empty."""
    n = F.size(words)
    parts = F.arrays_zip(*[F.slice(words, i + 1, F.greatest(n - k + 1, F.lit(0))).alias(f"w{i}") for i in range(k)])
    joined = F.transform(parts, lambda p: F.concat_ws(" ", *[p[f"w{i}"] for i in range(k)]))
    return (F.when(n >= k, joined).when(n > 0, F.array(F.array_join(words, " ")))
            .otherwise(F.array().cast("array<string>")))


def _hash_rows(texts: DataFrame, k: int) -> DataFrame:
    """(id, h): a row for each shingle of a text. ``texts``: id, words."""
    hashed = texts.select("id", F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    size = F.greatest(F.size("h") - k + 1, F.lit(0))
    long = (hashed.where(F.size("h") >= k)
            .select("id", F.inline(F.arrays_zip(*[F.slice("h", i + 1, size).alias(f"h{i}") for i in range(k)])))
            .select("id", F.xxhash64(*[f"h{i}" for i in range(k)]).alias("h")))
    short = hashed.where((F.size("h") < k) & (F.size("h") > 0)).select("id", F.xxhash64("h").alias("h"))
    return long.union(short)


def sketches(items: DataFrame, k: int, threshold: float) -> DataFrame:
    """(item_id, h): bottom-s MinHash of each item, s by its size partition."""
    w = W.partitionBy("id").orderBy("h")
    rows = _hash_rows(items, k).distinct()
    rows = rows.withColumn("r", F.row_number().over(w)).withColumn("n", F.count(F.lit(1)).over(W.partitionBy("id")))
    top = 2 * F.pow(F.lit(2.0), F.floor(F.log2("n"))) - 1
    s = top - F.ceil(F.lit(threshold) * top - 1e-9) + 1
    return rows.where(F.col("r") <= s).select(F.col("id").alias("item_id"), "h")


def contained_items(docs: DataFrame, items: DataFrame, k: int = 5, threshold: float = 0.8,
                    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                    item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles, containment): every pair in
    which the document holds at least ``threshold`` of the item's distinct
    k-word shingles.

    Words are lower-cased runs of letters, digits and non-ASCII characters. A
    text of fewer than k words has one shingle, its whole sequence, and so
    matches only an equally short text; one without words (null, empty) has
    none and matches nothing. Rows with a null id take no part. Repeated rows
    of one id count as one text with the union of their shingles. Extra
    columns are ignored; empty tables give no rows.
    """
    tune(docs.sparkSession)
    d = docs.select(F.col(id_col).alias("id"), plain_words(text_of(text_col)).alias("words")).where("id is not null")
    q = items.select(F.col(item_col).alias("id"), plain_words(text_of(item_text)).alias("words")).where("id is not null")
    small = materialize(sketches(q, k, threshold), "item-sketches")
    # beyond the bound Spark's own choice of a shuffled join holds
    bounded = F.broadcast(small) if small.count() <= BROADCAST_ROWS else small
    found = _hash_rows(d, k).join(bounded, "h").select(F.col("id").alias("doc_id"), "item_id").distinct()
    found = materialize(found, "leak-candidates")

    item_grams = q.select(F.col("id").alias("item_id"), F.explode(F.array_distinct(word_grams("words", k))).alias("g")).distinct()
    sizes = item_grams.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_shingles"))
    hit = d.join(found.select(F.col("doc_id").alias("id")).distinct(), "id", "left_semi")
    doc_grams = hit.select(F.col("id").alias("doc_id"), F.explode(F.array_distinct(word_grams("words", k))).alias("g"))
    doc_grams = doc_grams.join(item_grams.select("g").distinct(), "g", "left_semi").distinct()
    shared = (found.join(item_grams, "item_id").join(doc_grams, ["doc_id", "g"])
              .groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("n_shared")))
    return (shared.join(sizes, "item_id")
            .withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
            .where(F.col("n_shared") >= F.ceil(F.lit(threshold) * F.col("n_shingles") - 1e-9))
            .select("doc_id", "item_id", "n_shared", "n_shingles", "containment"))


def without_leaks(docs: DataFrame, items: DataFrame, k: int = 5, threshold: float = 0.8) -> DataFrame:
    """The documents that hold no item; rows with a null doc_id stay."""
    bad = contained_items(docs, items, k, threshold).select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)
