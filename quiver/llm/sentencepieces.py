"""Operator 9: SentencePiece encoding and decoding by suffix-array matching.

A task gathers documents up to a bounded number of characters, cuts them
into segments that no merge can cross (before a run of spaces, around line
breaks and tabs), and indexes the distinct segments of the batch with a
suffix array (``pieces.Index``). The edges of a segment are then relaxed in
the model's order: of all edges that span exactly two current symbols the
one with the best score is taken, leftmost first, until none is left. That
is the merge order of a BPE model, so ids equal the model's own. Characters
without a piece become byte pieces.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import text_of
from quiver.llm.pieces import MODEL, SPACE, Index, Pieces, load_pieces
from quiver.session import tune

#: Characters of a batch of documents, and of the segments indexed at a time.
BATCH_CHARS, INDEX_CHARS = 12_000_000, 500_000
#: Edges of segments up to this length are relaxed for all of them in rounds, those of longer ones from a heap each.
LONG = 48
_NEVER = np.int64(1) << 62
_SEGMENT = re.compile(rf"{SPACE}*[^{SPACE}\n\t]+|{SPACE}+|[\n\t]")


def segments(text: str) -> list[str]:
    """Cuts that no piece crosses: pieces hold spaces only at their start, no line break and no tab."""
    return _SEGMENT.findall(SPACE + text.replace(" ", SPACE)) if text else []


def _check(pieces: Pieces) -> None:
    if any(SPACE in t.lstrip(SPACE) or "\n" in t or "\t" in t for t in pieces.ids):
        raise ValueError("a piece crosses segments; this model needs whole texts as segments")


def _merge_long(edge: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """(position, length) of the final symbols of one segment, whose edges wait
    in a heap by (priority, position). ``edge``: its rows of the index."""
    n, widest, priority = len(edge), edge.shape[1] - 1, pieces.priority
    length, left, right = [1] * n, list(range(-1, n - 1)), [*range(1, n), -1]
    first = np.flatnonzero(edge[:-1, 2]) if widest > 1 else np.zeros(0, np.int64)
    heap = list(zip(priority[edge[first, 2] - 1].tolist(), first.tolist(), (first + 1).tolist(), [2] * len(first)))
    heapq.heapify(heap)

    def offer(i: int) -> None:
        j = right[i]
        if j >= 0 and (both := length[i] + length[j]) <= widest and (k := edge[i, both]):
            heapq.heappush(heap, (int(priority[k - 1]), i, j, both))

    while heap:
        _, i, j, both = heapq.heappop(heap)
        if not length[i] or not length[j] or right[i] != j or length[i] + length[j] != both:
            continue
        length[i], length[j], right[i] = both, 0, right[j]
        if right[j] >= 0:
            left[right[j]] = i
        offer(i)
        if left[i] >= 0:
            offer(left[i])
    at = np.flatnonzero(length)
    return at, np.array(length, np.int64)[at]


def _long_edges(strings: list[str], pieces: Pieces) -> Iterator[np.ndarray]:
    """Edges of each string. Short enough ones share an index; a longer one is indexed in
    overlapping windows that hold all pieces that begin in their own part."""
    at = 0
    while at < len(strings):
        s = strings[at]
        if len(s) > INDEX_CHARS:
            wide = INDEX_CHARS + pieces.longest - 1
            yield np.concatenate([Index([s[lo:lo + wide]], pieces).edge[:min(INDEX_CHARS, len(s) - lo)]
                                  for lo in range(0, len(s), INDEX_CHARS)])
            at += 1
            continue
        chars, end = 0, at
        while end < len(strings) and chars + len(strings[end]) <= INDEX_CHARS:
            chars += len(strings[end])
            end += 1
        index = Index(strings[at:end], pieces)
        for begin, size in zip(index.start.tolist(), index.size.tolist()):
            yield index.edge[begin:begin + size]
        at = end


def _with_bytes(owner: np.ndarray, ids: np.ndarray, points: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """(owner, ids), where symbols without a piece (id below 0; single characters, given by their code points) become byte pieces."""
    lost = np.flatnonzero(ids < 0)
    if not len(lost):
        return owner, ids
    n_ids = np.ones(len(ids), np.int64)
    raw = [chr(c).encode("utf-8", "surrogatepass") for c in points[lost].tolist()]
    n_ids[lost] = [len(b) for b in raw]
    where = np.repeat(np.arange(len(ids)), n_ids)
    flat = ids[where]
    flat[np.repeat(ids < 0, n_ids)] = pieces.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
    return owner[where], flat


def _merge_all(index: Index, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All segments of an index at once: (segment, position, length) of the
    final symbols, in order. Each round takes the best edge of every segment."""
    n = len(index.size)
    seg = np.repeat(np.arange(n), index.size)
    pos = np.arange(len(seg)) + seg  # one terminator for each segment before
    length = np.ones(len(seg), np.int64)
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    widest = index.edge.shape[1] - 1
    while len(seg):
        pair = np.full(len(seg), _NEVER, np.int64)
        both = length[:-1] + length[1:]
        at = np.flatnonzero((seg[:-1] == seg[1:]) & (both <= widest))
        ids = index.edge[pos[at], both[at]]
        hit = ids > 0
        at = at[hit]
        pair[at] = (pieces.priority[ids[hit] - 1] << 32) | at
        begins = np.flatnonzero(np.concatenate(([True], seg[1:] != seg[:-1])))
        best = np.minimum.reduceat(pair, begins)
        sizes = np.diff(np.append(begins, len(seg)))
        open_ = best < _NEVER
        ended = np.repeat(~open_, sizes)
        if ended.any():
            done.append((seg[ended], pos[ended], length[ended]))
        i = best[open_] & 0xFFFFFFFF
        length[i] += length[i + 1]
        keep = ~ended
        keep[i + 1] = False
        seg, pos, length = seg[keep], pos[keep], length[keep]
    if not done:
        return seg, pos, length
    seg, pos, length = (np.concatenate(x) for x in zip(*done))
    order = np.lexsort((pos, seg))
    return seg[order], pos[order], length[order]


def encode_segments(strings: list[str], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of all strings, and where each begins (one more entry than strings)."""
    rows: list[tuple[np.ndarray, np.ndarray]] = []
    short = [i for i, s in enumerate(strings) if len(s) <= LONG]
    at = 0
    while at < len(short):
        chars, end = 0, at
        while end < len(short) and (end == at or chars < INDEX_CHARS):
            chars += len(strings[short[end]]) + 1
            end += 1
        part = np.array(short[at:end])
        index = Index([strings[i] for i in part], pieces)
        seg, pos, length = _merge_all(index, pieces)
        ids = index.edge[pos, length].astype(np.int64) - 1
        rows.append(_with_bytes(part[seg], ids, index.points[pos], pieces))
        at = end
    long = [i for i, s in enumerate(strings) if len(s) > LONG]
    for i, edge in zip(long, _long_edges([strings[i] for i in long], pieces)):
        pos, length = _merge_long(edge, pieces)
        points = np.frombuffer(strings[i].encode("utf-32-le", "surrogatepass"), np.uint32)[pos]
        rows.append(_with_bytes(np.full(len(pos), i), edge[pos, length].astype(np.int64) - 1, points, pieces))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(len(strings) + 1, np.int64)
    seg, ids = (np.concatenate(x) for x in zip(*rows))
    order = np.argsort(seg, kind="stable")
    return ids[order], np.concatenate(([0], np.cumsum(np.bincount(seg, minlength=len(strings)))))


def encode_texts(texts: list[str | None], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of whole texts, and where each begins."""
    known: defaultdict[str, int] = defaultdict(count().__next__)
    number: list[int] = []
    n_segments = []
    for t in texts:
        own = segments(t or "")
        n_segments.append(len(own))
        number.extend(map(known.__getitem__, own))
    ids, begin = encode_segments(list(known), pieces)
    which = np.array(number, np.int64)
    size = np.diff(begin)[which]
    ends = np.cumsum(size)
    flat = ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin[which] - (ends - size), size)]
    cuts = np.concatenate(([0], np.cumsum(n_segments))).astype(np.int64)
    return flat, np.concatenate(([0], ends))[cuts]


def piece_bytes(pieces: Pieces) -> list[bytes]:
    out = [t.replace(SPACE, " ").encode() if n else b"" for t, n in zip(pieces.text, pieces.normal)]
    for value, i in enumerate(pieces.byte_id.tolist()):
        if not pieces.normal[i]:
            out[i] = bytes([value])
    return out


def decode_ids(ids: list[int], table: list[bytes]) -> str:
    """Text of ids: pieces joined, byte pieces as UTF-8, without the space that encoding puts first."""
    text = b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def _batches(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    ids: list = []
    texts: list[str] = []
    chars = 0
    for b in it:
        for i, t in zip(b.column(0).to_pylist(), b.column(1)):
            ids.append(i)
            texts.append(t.as_py())
            chars += len(texts[-1])
            if chars >= BATCH_CHARS:
                yield ids, texts
                ids, texts, chars = [], [], 0
    if ids:
        yield ids, texts


def encode(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, n_tokens, round_trip), one row per input row.

    ids are those of the model's BPE; round_trip says that decoding gives the
    text back (a literal U+2581 decodes to a space, as in the model's own
    decoder). Null and empty texts have no ids and round_trip true. Null and
    repeated ids keep their rows; empty input gives no rows; extra columns
    are ignored.
    """
    tune(docs.sparkSession)
    pieces = load_pieces(model)
    _check(pieces)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def tasks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_bytes(pieces)
        for doc_ids, texts in _batches(it):
            flat, begin = encode_texts(texts, pieces)
            same = [decode_ids(flat[a:b].tolist(), table) == t.replace(SPACE, " ") for t, a, b in zip(texts, begin, begin[1:])]
            step = 200  # output batches stay small
            for i in range(0, len(texts), step):
                j = min(i + step, len(texts))
                cut = begin[i:j + 1]
                arrays = pa.ListArray.from_arrays(pa.array((cut - cut[0]).astype(np.int32)), pa.array(flat[cut[0]:cut[-1]].astype(np.int32)))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(doc_ids[i:j], id_type), "ids": arrays,
                    "n_tokens": pa.array(np.diff(cut)), "round_trip": pa.array(same[i:j])})

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(rows.schema["doc_id"].dataType)
    return rows.mapInArrow(tasks, f"doc_id {kind}, ids array<int>, n_tokens bigint, round_trip boolean")


def decode(encoded: DataFrame, model: str = MODEL, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of encoded rows; null ids decode to the empty text; an id outside the vocabulary fails."""
    tune(encoded.sparkSession)
    table = piece_bytes(load_pieces(model))
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def tasks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(
                [decode_ids(x.as_py() or [], table) for x in b.column(1)], pa.string())], names=["doc_id", "text"])

    return rows.mapInArrow(tasks, f"doc_id {kind}, text string")
