"""Operator 6: exact dedup with a heavy-hitter split. DataFrame functions only.

``freqItems`` (frequent-element counters in the Misra-Gries manner, merged
across partitions) names at most 1/support digests that may be frequent. An
exact count verifies them; the verified winners, at most 1/support rows, are
broadcast and resolve their copies where they lie. Only the remaining
digests, each held by less than ``support`` of the rows, are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quiver.llm.common import lower_ascii, materialize, text_of
from quiver.session import tune


def exact_duplicates(docs: DataFrame, support: float = 0.001, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per input row.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty. The row with the largest doc_id of a group stays; rows that repeat
    that doc_id stay with it. A null doc_id stays only in a group without any
    other. Empty input gives no rows; extra columns are ignored.
    """
    tune(docs.sparkSession)
    if not 1e-6 <= support <= 1:
        raise ValueError("support bounds the broadcast: at most a million winners")
    rows = materialize(docs.select(F.col(id_col).alias("doc_id"), F.unhex(
        F.sha2(lower_ascii(text_of(text_col)), 256)).alias("digest")), "digests")
    total = rows.count()
    maybe = rows.select(F.hex("digest").alias("digest")).stat.freqItems(["digest"], support)
    maybe = maybe.select(F.explode("digest_freqItems").alias("d")).select(F.unhex("d").alias("digest")).distinct()
    counted = rows.join(F.broadcast(maybe), "digest", "left_semi").groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    winners = materialize(counted.where(F.col("group_size") >= max(2.0, support * total)), "heavy-digests")
    frequent = rows.join(F.broadcast(winners), "digest").select("doc_id", "digest", "keep_id", "group_size")
    same = W.partitionBy("digest")
    rest = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti").select(
        "doc_id", "digest", F.max("doc_id").over(same).alias("keep_id"), F.count(F.lit(1)).over(same).alias("group_size"))
    return frequent.union(rest).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
