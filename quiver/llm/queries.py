"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quiver.llm import (decontam, exact_dedup, lattice_lm, licenses, linededup, periodic_runs, quality, ranked_search, secrets, sentencepieces,
                        simhash, source_mixing, urls)
from quiver.llm.common import table

WORD_CHARS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_hash")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score_texts(table(spark, sf_dir, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents")).drop("blob")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.drop_lines(docs, dropped_col="n_dropped")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.mix(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", periodic_runs.planted_text().alias("text"))
    return periodic_runs.digest(periodic_runs.find_runs(docs))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{WORD_CHARS}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{WORD_CHARS}') AS w FROM benchmark),
dg AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
         THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
bg AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 5
         THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM b),
n AS (SELECT item_id, count(*) AS n_shingles FROM bg GROUP BY 1)
SELECT doc_id, item_id, count(*) AS n_shared, n_shingles, count(*) / n_shingles AS containment
FROM dg JOIN bg USING (g) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING count(*) >= ceil(0.8 * n_shingles - 1e-9)
"""

OP6_SQL = f"""
WITH t AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""

TERM_CHARS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all({_LOWER}, '{TERM_CHARS}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{TERM_CHARS}') AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)),
a AS (SELECT count(*)::BIGINT AS nd, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
tf AS (SELECT k, doc_id, n, t, count(*)::BIGINT AS tf FROM (SELECT k, doc_id, len(w)::BIGINT AS n, unnest(w) AS t FROM d) GROUP BY ALL),
q AS (SELECT item_id, t, count(*)::BIGINT AS c FROM (SELECT item_id, unnest(w) AS t FROM b) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w, nd, l
      FROM (SELECT t, count(*)::BIGINT AS df FROM tf GROUP BY t), a),
s AS (SELECT item_id, k, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // l))))::BIGINT AS score
      FROM q JOIN w USING (t) JOIN tf USING (t) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_quality_classifier, op2_lm_scoring, op3_benchmark_decontamination, op4_simhash_near_dedup, op5_secret_scan, op6_exact_dedup, op7_line_dedup, op8_license_scan,
    op9_sentencepiece, op10_url_filter, op11_ranked_search, op12_source_mixing, op13_periodic_runs)}
SQL: dict[str, str] = {"op3_benchmark_decontamination": OP3_SQL, "op6_exact_dedup": OP6_SQL, "op11_ranked_search": OP11_SQL}
