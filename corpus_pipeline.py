"""The corpus pipeline: each stage works on the documents that its
predecessor kept, written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiver.llm import decontam, linededup, quality, sentencepieces, simhash
from quiver.llm.common import materialize, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 1: documents that the quality classifier rejects go."""
    return quality.kept_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 2: recurring lines go from the texts; every document stays, ``n_chars`` follows its text."""
    out = linededup.drop_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType)) if "n_chars" in out.columns else out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 3: one document of each SimHash group stays, the smallest doc_id."""
    return simhash.one_of_each_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 4: documents that hold a benchmark item go."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 5: token ids of every document."""
    return sentencepieces.encode(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_filter), ("line_dedup", line_dedup), ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate), ("sentencepiece_encoding", encode)]

#: No SQL: SimHash and SentencePiece have no SQL form; tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
