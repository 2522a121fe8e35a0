"""Operator 7: line dedup with a log-template tree.

Fixed-depth parsing: a line's leaf is its number of tokens and its first
``depth`` tokens; tokens with a digit are variable and read as ``<*>``, but a line
with fewer than ``similarity`` other tokens (rows of tables, dates, hex) is only like its
exact copies. Within a
leaf, two distinct lines are alike if at least ``similarity`` of their positions
hold the same token; ``<*>`` agrees with nothing. Lines joined by such pairs are a
group: its template holds the tokens that all of them share, every other position is
``<*>``. Templates found in ``min_docs`` or more documents are recurring;
their lines are dropped from all documents but the first (smallest id), so a
group of copies never loses a text altogether.

Pairs are proposed by prefix filtering: lines of r tokens that need t of them in
common have, for every l up to t, l common tokens among their r - t + l rarest,
whatever the others are. Level l proposes by all l of these together. At
level 1, pairs of tokens that few lines share are compared at once. Lines of other
tokens are first compared with one of them each; then only lines of
different groups are. While a leaf's pairs outnumber the keys of the next level,
its lines go on to that level, where fewer lines share a key; at level t
sharing a key is being alike, and no pair is compared. Both ways are exact;
the rule only takes the one with fewer rows.

Leaves are never gathered in a task: distinct lines are counted, and for
leaves with several of them, (leaf, position, token) is counted over the
corpus with map-side combining.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import combinations

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quiver.llm.common import SEED, connected_components, fresh, materialize, text_of
from quiver.session import tune

DEPTH, SIMILARITY, MIN_DOCS, MIN_TOKENS = 3, 0.7, 2, 5
#: Lines that share a (position, token) up to which all their pairs are compared at once; keys of a line at the last level that is tried.
PAIR_LINES, MAX_KEYS = 16, 5000
#: Bits of the map that spares most lines the shuffle to their leaf; a multiple of 2 ** 15.
LEAF_BITS = 1 << 24
WILD = b"<*>"
_DIGIT = re.compile(rb"[0-9]")


def parse_line(line: str, depth: int = DEPTH, similarity: float = SIMILARITY) -> tuple[int, int, list[bytes]]:
    """(leaf, hash of the masked line, masked tokens); signed 64-bit hashes. A
    line with too many masked tokens is its own leaf, hashed with its digits."""
    import xxhash

    tokens = plain = line.encode("utf-8", "surrogatepass").lower().split()
    if _DIGIT.search(line.encode("utf-8", "surrogatepass")):
        tokens = [WILD if _DIGIT.search(t) else t for t in tokens]

    def h(parts: list[bytes]) -> int:
        x = xxhash.xxh64_intdigest(b" ".join(parts), SEED)
        return x - (1 << 64) if x >= 1 << 63 else x

    if tokens is not plain and len(tokens) - tokens.count(WILD) < similarity * len(tokens) - 1e-9:
        return h(plain), h(plain), plain
    return h([b"%d" % len(tokens), *tokens[:depth]]), h(tokens), tokens


def _lines(rows: DataFrame, depth: int, similarity: float, min_tokens: int) -> DataFrame:
    """(doc_id, k, pos, leaf, line) of the lines with enough tokens."""
    kind = rows.schema["doc_id"].dataType
    id_type = to_arrow_type(kind)

    def tasks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out: list[tuple] = []
            for i, k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                for pos, line in enumerate(t.as_py().split("\n")):
                    leaf, own, tokens = parse_line(line, depth, similarity)
                    if len(tokens) >= min_tokens:
                        out.append((i, k, pos, leaf, own))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(
                cols, (id_type, pa.int64(), pa.int32(), pa.int64(), pa.int64()))], names=["doc_id", "k", "pos", "leaf", "line"])

    return rows.mapInArrow(tasks, f"doc_id {kind.simpleString()}, k bigint, pos int, leaf bigint, line bigint")


def _bitmap(leaves: DataFrame) -> bytes:
    """A bit for each residue of a leaf: at most 2 MB come to the driver."""
    x = F.pmod(F.col("leaf"), F.lit(LEAF_BITS)) + 1
    rows = leaves.groupBy(F.bitmap_bucket_number(x).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(x)).alias("m")).collect()
    parts = {r.b: bytes(r.m) for r in rows}
    return b"".join(parts.get(i + 1, bytes(4096)) for i in range(LEAF_BITS >> 15))


def _line_tokens(rows: DataFrame, depth: int, similarity: float, min_tokens: int, bitmap: bytes) -> DataFrame:
    """(leaf, line, need, tokens): masked lines of all documents, but those whose
    leaf the bitmap excludes for sure; need: equal tokens after the leaf's that make lines alike."""
    def tasks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            seen: dict[int, tuple[int, int, str]] = {}
            for t in b.column(0):
                for line in t.as_py().split("\n"):
                    leaf, own, tokens = parse_line(line, depth, similarity)
                    bit = leaf % LEAF_BITS
                    if len(tokens) >= min_tokens and own not in seen and bitmap[bit >> 3] >> (bit & 7) & 1:
                        need = math.ceil(similarity * len(tokens) - 1e-9) - sum(x != WILD for x in tokens[:depth])
                        seen[own] = (leaf, need, b" ".join(tokens).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([
                pa.array([v[0] for v in seen.values()], pa.int64()), pa.array(list(seen), pa.int64()),
                pa.array([v[1] for v in seen.values()], pa.int32()), pa.array([v[2] for v in seen.values()], pa.string())],
                names=["leaf", "line", "need", "tokens"])

    return rows.select("text").mapInArrow(tasks, "leaf bigint, line bigint, need int, tokens string")


def _alike(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """The (a, b, ...) rows whose lines have at least ``need`` (position, token) hashes in common."""
    one = items.select(F.col("line").alias("a"), F.col("items").alias("x"), "need")
    two = items.select(F.col("line").alias("b"), F.col("items").alias("y"))
    return pairs.join(one, "a").join(two, "b").where(F.size(F.array_intersect("x", "y")) >= F.col("need")).drop("x", "y", "need")


def _level_keys(lines: DataFrame, level: int) -> DataFrame:
    """(key, leaf, line, comp, full): all ``level`` of a line's rarest tokens together;
    full: as many as alike lines need. ``lines``: leaf, line, comp, need, items (rarest first)."""
    def tasks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            keys, at = [], []
            for i, (need, own) in enumerate(zip(b.column(3).to_pylist(), b.column(4).to_pylist())):
                own = own[:len(own) - need + level]
                for some in combinations(own, level):
                    key = level
                    for x in some:
                        key = (key * 0x9E3779B97F4A7C15 + x) & 0xFFFFFFFFFFFFFFFF
                        key ^= key >> 29
                    keys.append(key - (1 << 64) if key >= 1 << 63 else key)
                    at.append(i)
                    if len(keys) >= 100_000:
                        yield batch(b, keys, at)
                        keys, at = [], []
            yield batch(b, keys, at)

    def batch(b: pa.RecordBatch, keys: list[int], at: list[int]) -> pa.RecordBatch:
        where = pa.array(at, pa.int64())
        full = pc.equal(b.column(3).take(where), level)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *[b.column(c).take(where) for c in range(3)], full],
                                          names=["key", "leaf", "line", "comp", "full"])

    return lines.select("leaf", "line", "comp", "need", "items").mapInArrow(
        tasks, "key bigint, leaf bigint, line bigint, comp bigint, full boolean")


def _n_keys(level: int) -> F.Column:
    """Keys of a line at a level: combinations of ``level`` out of size - need + level tokens; 0 beyond its last."""
    free = F.size("items") - F.col("need")
    out = F.lit(1.0)
    for i in range(1, level + 1):
        out = out * (free + i) / i
    return F.when(F.col("need") >= level, out).otherwise(0.0)


def _links(items: DataFrame, size: DataFrame, rare: DataFrame) -> DataFrame:
    """(a, b): links whose components are those of all alike lines. ``items``: leaf, line,
    need, items (rarest first); ``rare`` (item, line): level 1; ``size`` (item, n) counts its lines."""
    few = rare.join(size.where(F.col("n") <= PAIR_LINES).select("item"), "item")
    pairs = few.select("item", F.col("line").alias("a")).join(few.select("item", F.col("line").alias("b")), "item").where("a < b")
    links = _alike(pairs.select("a", "b").distinct(), items)
    common = materialize(rare.join(size.where(F.col("n") > PAIR_LINES).select("item"), "item"), "common-items")
    if common.isEmpty():
        return links
    tried = common.join(common.groupBy("item").agg(F.min("line").alias("b")), "item").select(F.col("line").alias("a"), "b")
    links = materialize(links.union(_alike(tried.where("a <> b").distinct(), items)), "alike-lines")
    lines = materialize(items.join(common.select("line").distinct(), "line", "left_semi"), "common-lines")
    level = 1
    while True:
        comp = connected_components(links)
        named = lines.join(comp, F.col("line") == F.col("node"), "left").withColumn("comp", F.coalesce("component", "line")).drop("node", "component")
        named = materialize(named, "named-lines")
        if level == 1:
            keys = common.join(named, "line").select(F.col("item").alias("key"), "leaf", "line", "comp", (F.col("need") == 1).alias("full"))
        else:
            keys = _level_keys(named.where(F.col("need") >= level), level)
        keys = materialize(keys, "line-keys")
        per = keys.where("NOT full").groupBy("leaf", "key", "comp").agg(F.count(F.lit(1)).cast("double").alias("n"))
        per = per.groupBy("leaf", "key").agg(((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("cross")).where("cross > 0")
        per = materialize(per, "crossed-keys")
        cost = per.groupBy("leaf").agg(F.sum("cross").alias("cross"))
        after = named.groupBy("leaf").agg(F.sum(_n_keys(level + 1)).alias("next"), F.max(_n_keys(level + 1)).alias("most"))
        go_on = (F.col("cross") > F.col("next")) & (F.col("most") <= MAX_KEYS) & (F.col("next") > 0)
        cost = materialize(cost.join(after, "leaf").select("leaf", go_on.alias("go_on")), "leaf-costs")
        now = keys.join(per.join(cost.where("NOT go_on"), "leaf").select("key"), "key", "left_semi").where("NOT full")
        x = now.select("key", F.col("line").alias("a"), F.col("comp").alias("ca"))
        y = now.select("key", F.col("line").alias("b"), F.col("comp").alias("cb"))
        found = _alike(x.join(y, "key").where("ca < cb").select("a", "b").distinct(), items)
        same = keys.where("full").select("key", F.col("line").alias("a"), "comp")
        same = same.join(same.groupBy("key").agg(F.min("a").alias("b")), "key").where("a <> b").select("a", "b").distinct()
        links = materialize(links.union(found).union(same), "alike-lines")
        level += 1
        lines = materialize(lines.join(cost.where("go_on").select("leaf"), "leaf", "left_semi"), "common-lines")
        if lines.isEmpty():
            return links


def templates(rows: DataFrame, lines: DataFrame, depth: int, similarity: float, min_tokens: int) -> DataFrame:
    """(leaf, line, template) of the lines that have others in their group."""
    distinct = lines.groupBy("leaf", "line").agg(F.count(F.lit(1)).alias("n"))
    several = materialize(distinct.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("leaf"), "wide-leaves")
    inside = _line_tokens(rows, depth, similarity, min_tokens, _bitmap(several))
    inside = inside.dropDuplicates(["leaf", "line"]).join(several, "leaf", "left_semi")
    tokens = inside.select("leaf", "line", "need", F.posexplode(F.split("tokens", " ")).alias("pos", "token"))
    tokens = materialize(tokens.where((F.col("pos") >= depth) & (F.col("token") != WILD.decode()))
                         .select("leaf", "line", "need", F.xxhash64("leaf", "pos", "token").alias("item")), "leaf-tokens")
    shared = tokens.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # a line with fewer shared tokens than it needs is like no other
    items = (tokens.join(shared, "item").groupBy("leaf", "line", "need").agg(F.array_sort(F.collect_list(F.struct("n", "item"))).alias("items"))
             .where(F.size("items") >= F.col("need")))
    items = materialize(items, "line-items")
    rare = items.where("need > 0").select(
        "line", F.explode(F.expr("slice(items.item, 1, size(items) - need + 1)")).alias("item"))
    size = rare.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    links = _links(items.select("leaf", "line", "need", F.col("items.item").alias("items")), materialize(size, "rare-items"), rare)
    if depth >= similarity * min_tokens:
        # so short that the leaf's own tokens are enough
        short = inside.where("need <= 0").select("leaf", F.col("line").alias("a"))
        links = links.union(short.join(short.groupBy("leaf").agg(F.min("a").alias("b")), "leaf").select("a", "b"))
    group = connected_components(materialize(links, "alike-lines"))
    return distinct.join(group, F.col("line") == F.col("node")).select("leaf", "line", F.xxhash64("leaf", "component").alias("template"))


def recurring_lines(docs: DataFrame, depth: int = DEPTH, similarity: float = SIMILARITY, min_docs: int = MIN_DOCS,
                    min_tokens: int = MIN_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, k, drop array<int>): positions of the lines to drop; k is the
    hash of the text, so the pair names a document. See ``drop_lines``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("k"), "text")
    lines = materialize(_lines(rows, depth, similarity, min_tokens), "lines")
    named = materialize(templates(rows, lines, depth, similarity, min_tokens), "templates")
    lines = lines.join(named, ["leaf", "line"], "left").select(
        F.struct("doc_id", "k").alias("doc"), "pos", F.coalesce("template", "line").alias("template"))
    lines = materialize(lines, "templated-lines")
    holders = lines.select("template", "doc").distinct()
    recurring = holders.groupBy("template").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("first")).where(
        F.col("n") >= min_docs).select("template", "first")
    drop = lines.join(recurring, "template").where(~F.col("doc").eqNullSafe(F.col("first")))
    return drop.groupBy("doc").agg(F.sort_array(F.collect_set("pos")).alias("drop")).select("doc.doc_id", "doc.k", "drop")


def drop_lines(docs: DataFrame, depth: int = DEPTH, similarity: float = SIMILARITY, min_docs: int = MIN_DOCS,
               min_tokens: int = MIN_TOKENS, id_col: str = "doc_id", text_col: str = "text",
               dropped_col: str | None = None) -> DataFrame:
    """``docs`` with its recurring lines dropped from the text; all rows and columns stay.

    Lines are separated by line feeds; tokens by ASCII white space after
    lower-casing A-Z. Lines of fewer than ``min_tokens`` tokens recur by
    chance and stay. Of a recurring template's documents the first by (id,
    hash of text; a null id first) keeps its lines. Repeated rows with equal id and text are one
    document; with another id, an equal text is another document. Null and
    empty texts stay as they are. ``dropped_col``: add the number of dropped
    lines under this name. Empty input gives no rows.
    """
    tune(docs.sparkSession)
    drop = recurring_lines(docs, depth, similarity, min_docs, min_tokens, id_col, text_col)
    name = fresh(docs, "drop_at")

    @F.pandas_udf("string")
    def without(text: pd.Series, gone: pd.Series) -> pd.Series:
        def cut(t, g):
            if g is None or t is None:
                return t
            out = set(g.tolist())
            return "\n".join(x for i, x in enumerate(t.split("\n")) if i not in out)

        return pd.Series([cut(t, g) for t, g in zip(text, gone)], dtype=object)

    d = docs.alias("d")
    b = drop.select(F.col("doc_id").alias("drop_id"), F.col("k").alias("drop_k"), F.col("drop").alias(name)).alias("b")
    text = F.col(f"d.`{text_col}`")
    hashed = F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))
    joined = d.join(b.hint("shuffle_hash"), F.col(f"d.`{id_col}`").eqNullSafe(F.col("b.drop_id")) & (hashed == F.col("b.drop_k")), "left")
    cols = [without(text, F.col(f"b.{name}")).alias(c) if c == text_col else F.col(f"d.`{c}`") for c in docs.columns]
    if dropped_col:
        cols.append(F.coalesce(F.array_size(F.col(f"b.{name}")), F.lit(0)).alias(dropped_col))
    return joined.select(*cols)
