"""Operator 5: secret scans with an incremental blob ledger.

Every version of a document is content-addressed by SHA-256. The ledger
holds one row per (blob, rule version) that was scanned, with its findings.
A scan takes the distinct blobs, leaves out pairs that the ledger has, scans
one copy of each remaining blob, appends the result and joins findings back
to every row that holds the blob.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiver.llm.common import materialize, text_of
from quiver.session import shared_path, tune

# Base kinds in the order that breaks ties, with their patterns,
# the group whose length counts and its least length.
BASE = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
     re.ASCII | re.IGNORECASE, 2, 6),
    ("access", r"AKIA[A-Z0-9]+", re.ASCII, 0, 20),
    ("hex", r"[0-9a-f]{24,}", re.ASCII, 0, 24),
)
# Further kinds of this operator (published key formats).
EXTRA = (
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", re.ASCII, 0, 1),
    # not inside a longer token, so that a run of tokens is read once
    ("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+", re.ASCII, 0, 1),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", re.ASCII, 0, 1),
)
RULES = BASE + EXTRA
LEDGER = "blob binary, rules string, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"


def rule_version(rules=RULES) -> str:
    """Digest of the rule set; changing any rule gives another version."""
    return hashlib.sha256(repr([(n, p, int(f), g, m) for n, p, f, g, m in rules]).encode()).hexdigest()[:16]


def find_secrets(text: str | None, rules=RULES) -> list[tuple[int, int, int, str]]:
    """(start, rule number, end, kind), sorted: leftmost non-overlapping
    matches per kind, those with too short a group dropped. Code points."""
    text = text or ""
    found = []
    for i, (kind, pattern, flags, group, least) in enumerate(rules):
        for m in re.finditer(pattern, text, flags):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), i, m.end(), kind))
    return sorted(found)


def _scan_row(text: str | None, rules) -> tuple[int, int, int, str, str]:
    found = find_secrets(text, rules)
    base = {k for k, *_ in BASE}
    show = lambda rows: ",".join(f"{k}:{s}:{e}" for s, _, e, k in rows)
    count = lambda kind: sum(k == kind for *_, k in found)
    own = show([f for f in found if f[3] in base])
    return count("assign"), count("access"), count("hex"), hashlib.sha256(own.encode()).hexdigest(), show(found)


def _scan(texts: DataFrame, rules, version: str) -> DataFrame:
    """LEDGER rows for ``texts`` (blob, text)."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("blob", pa.binary()), ("rules", pa.string()), ("n_assign", pa.int64()), ("n_access", pa.int64()),
                            ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())])
        for b in it:
            rows = [_scan_row(t.as_py(), rules) for t in b.column(1)]
            cols = [list(c) for c in zip(*rows)] if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(b.column(0).to_pylist(), pa.binary()), pa.array([version] * len(rows), pa.string()),
                                              *[pa.array(c, schema.field(i + 2).type) for i, c in enumerate(cols)]], schema=schema)

    return texts.mapInArrow(batches, LEDGER)


def new_ledger(spark: SparkSession) -> str:
    """An empty ledger in a new folder below the shared checkpoint folder."""
    import uuid

    path = shared_path(spark, f"quiver-llm/ledger-{uuid.uuid4().hex[:12]}")
    spark.createDataFrame([], LEDGER).write.parquet(path)
    return path


def scan_secrets(docs: DataFrame, ledger: str | None = None, rules=RULES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row (each version and path of a blob): doc_id, blob, n_assign, n_access,
    n_hex, base_sha256, spans.

    ``ledger``: folder of an earlier call's ledger; blobs that it has under
    this rule version are not scanned again; new results are appended. None:
    a new, empty one. Null counts as empty text; an empty text has no spans
    and the digest of the empty string. Repeated rows and equal texts share a scan;
    null ids keep their row. No pattern starts twice within a run of its characters,
    so a text of any length takes time in proportion. Empty input gives no
    rows; extra columns are ignored.
    """
    spark = tune(docs.sparkSession)
    ledger, version = ledger or new_ledger(spark), rule_version(rules)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    paths = materialize(rows.select("doc_id", F.unhex(F.sha2("text", 256)).alias("blob")), "blobs")
    done = spark.read.schema(LEDGER).parquet(ledger).where(F.col("rules") == version)
    unseen = paths.join(done.select("blob"), "blob", "left_anti").groupBy("blob").agg(F.min("doc_id").alias("carrier"))
    # Texts cross the network once; the narrow side is the one that is hashed,
    # so no text is sorted or held. Rows that repeat a carrier are scanned alike.
    texts = rows.select("doc_id", F.unhex(F.sha2("text", 256)).alias("b"), "text")
    carriers = texts.join(unseen.hint("shuffle_hash"), (F.col("b") == F.col("blob")) & F.col("doc_id").eqNullSafe(
        F.col("carrier")), "left_semi").select(F.col("b").alias("blob"), "text")
    _scan(carriers, rules, version).write.mode("append").parquet(ledger)
    found = spark.read.schema(LEDGER).parquet(ledger).where(F.col("rules") == version).dropDuplicates(["blob"])
    return paths.join(found.drop("rules"), "blob", "left").select(
        "doc_id", F.lower(F.hex("blob")).alias("blob"), "n_assign", "n_access", "n_hex", "base_sha256", "spans")
