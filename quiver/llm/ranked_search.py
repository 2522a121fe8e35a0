"""Operator 11: ranked lexical search, hybrid TAAT-DAAT.

The index is split by document. A task cuts its documents into *segments* of
a bounded number of characters; a segment holds the postings (document, term
frequency) of the query terms and the lengths of its documents as one row of
a written table. Document frequencies, the number of documents and their
total length are sums over the segments.

Per segment and item, the term lists split by length. The shortest ones are
read term at a time into summed *accumulators*, at most a quarter of the
segment's documents; these then act as one more list with a bound of its
own. The long lists and the accumulators are read document at a time: lists
are ordered by their largest contribution, documents that occur only in
lists whose bounds together stay below the score of the last rank are
skipped, and for the others the lists are probed from the largest bound on
until what is left cannot lift them to that score. A task carries the ranks
found so far from segment to segment, so later segments skip more.

Items are a stated query set: they are read in blocks of ``block_chars``
characters, so what a task holds does not grow with the number of items.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quiver.llm.common import materialize, text_of
from quiver.session import tune

#: Characters of a segment's documents (and one document), and of a block of items.
SEGMENT_CHARS, BLOCK_CHARS = 6_000_000, 20_000_000
#: Share of a segment's documents that accumulators may hold; documents read at a time.
ACCUMULATORS, STEP = 0.25, 1024
#: Groups in which the ranks of an item are cut before they meet.
SALTS = 64

#: Bytes of a term, A-Z lower-cased; all others become a space. Bytes from 0x80 on belong to characters outside ASCII.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _segment(ids: pa.Array, n: list[int], found: list[tuple[np.ndarray, np.ndarray]], n_terms: int) -> dict:
    """One index row: documents in the order of their ids (null last), postings by term and document."""
    order = pc.sort_indices(ids, null_placement="at_end")
    place = np.empty(len(ids), np.int32)
    place[order.to_numpy()] = np.arange(len(ids), dtype=np.int32)
    doc = np.repeat(place, [len(t) for t, _ in found])
    term = np.concatenate([t for t, _ in found]) if found else np.zeros(0, np.int64)
    tf = np.concatenate([f for _, f in found]) if found else np.zeros(0, np.int64)
    by = np.lexsort((doc, term))
    df = np.bincount(term, minlength=n_terms)
    held = np.flatnonzero(df)
    sizes = np.array(n, np.int64)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([x]) for x in (ids.take(order).to_pylist(), sizes[order.to_numpy()], held, df[held], doc[by], tf[by])],
        schema=pa.schema([("ids", pa.list_(ids.type)), ("n", pa.list_(pa.int64())), ("term", pa.list_(pa.int64())),
                          ("df", pa.list_(pa.int64())), ("doc", pa.list_(pa.int32())), ("tf", pa.list_(pa.int64()))]))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return {"docs": int((sizes > 0).sum()), "words": int(sizes.sum()), "term": held, "df": df[held], "payload": sink.getvalue().to_pybytes()}


_ROW = pa.schema([("docs", pa.int64()), ("words", pa.int64()), ("term", pa.list_(pa.int64())), ("df", pa.list_(pa.int64())), ("payload", pa.binary())])


def build_segments(docs: DataFrame, vocabulary: dict[bytes, int], segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """(docs, words, term, df, payload): index segments of ``docs`` (doc_id, text) over the vocabulary."""
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def tasks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, n, found, chars = [], [], [], 0
        number = known.value

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_segment(pa.array(ids, id_type), n, found, len(number))], schema=_ROW)

        for b in it:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                text = t.as_py()
                words = terms(text)
                if words:
                    at = np.fromiter((number.get(w, -1) for w in words), np.int64, len(words))
                    found.append(np.unique(at[at >= 0], return_counts=True))
                    ids.append(i)
                    n.append(len(words))
                chars += len(text)
                if chars >= segment_chars:
                    if ids:
                        yield row()
                    ids, n, found, chars = [], [], [], 0
        if ids:
            yield row()

    return docs.mapInArrow(tasks, "docs bigint, words bigint, term array<bigint>, df array<bigint>, payload binary")


class Segment:
    """The postings of one segment with their weighted contributions."""

    def __init__(self, payload: bytes, weight: np.ndarray, n_docs: int, n_words: int):
        row = pa.ipc.open_stream(payload).read_next_batch()
        part = {c: row.column(c).values for c in row.schema.names}
        self.ids = part["ids"]
        size, term, df = (part[c].to_numpy() for c in ("n", "term", "df"))
        self.doc, tf = part["doc"].to_numpy(), part["tf"].to_numpy()
        m = 75 + (25 * size * n_docs) // n_words
        self.impact = np.repeat(weight[term], df) * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[self.doc]))
        cut = np.concatenate(([0], np.cumsum(df)))
        self.at = {t: (a, b) for t, a, b in zip(term.tolist(), cut[:-1].tolist(), cut[1:].tolist())}
        self.n = len(size)

    def lists(self, item: dict[int, int]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(documents, contributions) of an item's terms that score here, shortest first."""
        out = []
        for t, repeats in item.items():
            if t in self.at:
                a, b = self.at[t]
                if self.impact[a:b].any():
                    out.append((self.doc[a:b], self.impact[a:b] * repeats if repeats > 1 else self.impact[a:b]))
        return sorted(out, key=lambda x: len(x[0]))


def accumulate(lists: list[tuple[np.ndarray, np.ndarray]], bound: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """The shortest lists of at most ``bound`` postings in all, summed into one, before the others; how many they were."""
    k = total = 0
    while k < len(lists) and total + len(lists[k][0]) <= bound:
        total += len(lists[k][0])
        k += 1
    if k < 2:
        return lists, k
    docs, where = np.unique(np.concatenate([d for d, _ in lists[:k]]), return_inverse=True)
    sums = np.zeros(len(docs), np.int64)
    np.add.at(sums, where, np.concatenate([s for _, s in lists[:k]]))
    return [(docs, sums), *lists[k:]], k


def search_segment(segment: Segment, item: dict[int, int], best: list[tuple], k: int) -> list[tuple]:
    """``best``, [(-score, id is null, id)] of earlier segments in order, with this segment's documents; at most k."""
    lists, _ = accumulate(segment.lists(item), max(64, int(ACCUMULATORS * segment.n)))
    lists.sort(key=lambda x: int(x[1].max()))
    tops = [int(s.max()) for _, s in lists]
    reach = np.cumsum(tops).tolist()  # what lists up to this one can add together
    cuts = [[0] * len(lists)]
    edges = list(range(STEP, segment.n, STEP)) + [segment.n]
    cuts += np.array([np.searchsorted(d, edges) for d, _ in lists]).T.tolist() if lists else []
    for lo, a, b in zip([0, *edges], cuts, cuts[1:]):
        least = -best[k - 1][0] if len(best) >= k else 1
        first = next((i for i, r in enumerate(reach) if r >= least), len(lists))
        if first == len(lists):
            break  # no document left can reach the last rank
        score = np.zeros(STEP, np.int64)
        for j in range(first, len(lists)):
            d, s = lists[j]
            score[d[a[j]:b[j]] - lo] += s[a[j]:b[j]]
        some = np.flatnonzero(score)
        for j in range(first - 1, -1, -1):
            some = some[score[some] + reach[j] >= least]
            if not len(some):
                break
            d, s = lists[j][0][a[j]:b[j]], lists[j][1][a[j]:b[j]]
            if len(d):
                at = np.minimum(np.searchsorted(d, some + lo), len(d) - 1)
                score[some] += np.where(d[at] == some + lo, s[at], 0)
        some = some[score[some] >= least]
        if len(some) > k:  # of equal scores the first documents have the smaller ids
            some = some[np.argsort(-score[some], kind="stable")[:k]]
        if len(some):
            new = [(-int(score[x]), segment.ids[int(x) + lo].as_py()) for x in some]
            best = sorted(best + [(s, i is None, i) for s, i in new], key=lambda x: x[:2] if x[1] else x)[:k]
    return best


def _search_block(docs: DataFrame, items: list[tuple], k: int, segment_chars: int) -> DataFrame | None:
    """(item_no, doc_id, score) of the items [(number, terms)]: the k best of each task; None if no item has a term."""
    vocabulary: dict[bytes, int] = {}
    queries = [(no, {vocabulary.setdefault(t, len(vocabulary)): c for t, c in Counter(ts).items()}) for no, ts in items]
    if not vocabulary:
        return None
    segments = materialize(build_segments(docs, vocabulary, segment_chars), "search-segments")
    sums = segments.agg(F.sum("docs"), F.sum("words")).first()
    n_docs, n_words = sums[0] or 0, sums[1] or 0
    pairs = segments.select(F.explode(F.arrays_zip("term", "df")).alias("x")).groupBy("x.term").agg(F.sum("x.df").alias("df"))
    weight = np.zeros(len(vocabulary), np.int64)
    for r in pairs.collect():  # at most one row for each term of the block's items
        weight[r.term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r.df + 1)))
    shared = docs.sparkSession.sparkContext.broadcast((queries, weight))
    kind = docs.schema["doc_id"].dataType
    id_type = to_arrow_type(kind)

    def tasks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, w = shared.value
        best: dict[int, list[tuple]] = {no: [] for no, _ in wanted}
        for b in it:
            for payload in b.column(0):
                segment = Segment(payload.as_py(), w, n_docs, n_words)
                for no, item in wanted:
                    best[no] = search_segment(segment, item, best[no], k)
        rows = [(no, i, -s) for no, found in best.items() for s, _, i in found]
        cols = list(zip(*rows)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), id_type, pa.int64()))],
                                         names=["item_no", "doc_id", "score"])

    return segments.select("payload").mapInArrow(tasks, f"item_no bigint, doc_id {kind.simpleString()}, score bigint")


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", segment_chars: int = SEGMENT_CHARS,
           block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(item_id, rank int, doc_id, score long): the ``k`` documents of highest score above 0 for every item.

    Terms are runs of ASCII letters and digits and of any characters outside
    ASCII; only A-Z are lower-cased; null and empty texts have none and are
    not counted as documents. Equal scores rank by ascending doc_id, a null
    id last. Each row of ``docs`` is a document, repeated ones too. Rows of
    ``items`` equal in id and text are one item; another text under the same
    id is an item of its own with ranks of its own. Extra columns are
    ignored; empty input on either side gives no rows.
    """
    spark = tune(docs.sparkSession)
    d = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    q = items.select(F.col(item_col).alias("item_id"), text_of(item_text_col).alias("text")).distinct()
    q = materialize(q.withColumn("item_no", F.xxhash64(F.col("item_id").isNull(), "item_id", "text")), "search-items")
    blocks = max(1, math.ceil((q.agg(F.sum(F.length("text"))).first()[0] or 0) / block_chars))
    parts = []
    for block in range(blocks):
        mine = q.where(F.pmod("item_no", F.lit(blocks)) == block).select("item_no", "text").collect()
        part = _search_block(d, [(r.item_no, terms(r.text)) for r in mine], k, segment_chars)
        if part is not None:
            parts.append(part)
    if not parts:
        parts = [spark.createDataFrame([], f"item_no bigint, doc_id {d.schema['doc_id'].dataType.simpleString()}, score bigint")]
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    found = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    near = found.withColumn("rank", F.row_number().over(Window.partitionBy("item_no", "salt").orderBy(*order))).where(F.col("rank") <= k)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("item_no").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.join(q.select("item_no", "item_id"), "item_no").select("item_id", "rank", "doc_id", "score")
