"""Operator 2: language-model scores by subword lattice likelihood.

The scores of an existing piece vocabulary give every piece a probability.
A text is a sequence of words, each put together from pieces in any of its
segmentations; the marginal probability of a word is the sum over all of
them, by a log-space forward recursion over its lattice, and that of a
document the product over its words and one end token. Words share no
piece, so this is the marginal over all segmentations of the document.

Training is ``steps`` expectation steps, the first of them from the existing
scores: on the training documents the scores weight all segmentations,
expected piece counts are gathered over the whole corpus and mixed with the
existing scores as a prior.

Data flow. A task cuts its documents into blocks of a bounded number of
characters; a block keeps its documents as word numbers and lists its
distinct words with counts. Counts are summed per word before and after a
shuffle, each word of the corpus is scored once, and a join gives the scores
back to the blocks.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quiver.llm.common import materialize, text_of
from quiver.llm.pieces import MODEL, SPACE, Index, Pieces, load_pieces
from quiver.session import tune

#: Characters of a block (and one document); words and characters scored at a time.
BLOCK_CHARS, SCORE_WORDS, INDEX_CHARS = 12_000_000, 60_000, 500_000
#: Smoothing of the base model; weight of the existing scores against expected counts; expectation steps.
ALPHA, PRIOR, STEPS = 0.1, 1000.0, 3
LN10 = float(np.log(10))


def vocabulary_logp(pieces: Pieces) -> np.ndarray:
    """Natural-log probability of each piece from the model's scores.

    Scores of a unigram model are log probabilities. Those of a BPE model
    are minus the merge rank; by Zipf's law rank r has weight 1/(1 + r),
    ranks beyond the vocabulary (special scores) and byte pieces the last.
    """
    n = len(pieces.score)
    weight = pieces.score.astype(float)
    if np.array_equal(weight, np.round(weight)):
        weight = -np.log1p(np.clip(-weight, 0, n))
    usable = pieces.normal.copy()
    usable[pieces.byte_id] = True
    weight[pieces.byte_id] = -np.log1p(n)
    weight[~usable] = -np.inf
    return weight - np.log(np.exp(weight[usable]).sum())


def _edge_logp(index: Index, pieces: Pieces, logp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """logp of each edge[position, length]; -inf without one. A character
    without a piece is spelt by its byte pieces (mask returned)."""
    table = np.concatenate(([-np.inf], logp))
    out = table[index.edge]
    spelt = index.edge[:, 1] == 0
    spelt[index.start + index.size] = False  # terminators; a text may hold U+0000, too
    c = index.points[spelt]
    n_bytes = 1 + (c > 0x7F).astype(int) + (c > 0x7FF) + (c > 0xFFFF)
    out[spelt, 1] = n_bytes * logp[pieces.byte_id[0]]
    return out, spelt


def _recursion(start: np.ndarray, size: np.ndarray, edge: np.ndarray, n: int) -> np.ndarray:
    """Forward log sums: a[p] over all segmentations of a word up to p."""
    a = np.full(n + 1, -np.inf)
    a[start] = 0.0
    widest = edge.shape[1] - 1
    order = np.argsort(-size, kind="stable")
    begins, sizes = start[order], size[order]
    alive = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), side="right")
    for t, k in enumerate(alive.tolist(), 1):  # all words of at least t characters at once
        at = begins[:k] + t
        w = np.arange(1, min(t, widest) + 1)
        terms = a[at[:, None] - w] + edge[at[:, None] - w, w]
        top = terms.max(axis=1)
        top = np.where(np.isfinite(top), top, 0.0)
        with np.errstate(divide="ignore"):
            a[at] = top + np.log(np.exp(terms - top[:, None]).sum(axis=1))
    return a


def word_logp(words: list[str], pieces: Pieces, logp: np.ndarray) -> np.ndarray:
    """Natural-log marginal of each word (its leading space piece included)."""
    out = np.empty(len(words))
    for lo, hi in _slices(words):
        index = Index([SPACE + w for w in words[lo:hi]], pieces)
        edge, _ = _edge_logp(index, pieces, logp)
        out[lo:hi] = _recursion(index.start, index.size, edge, len(index.points))[index.start + index.size]
    return out


def expected_counts(words: list[str], n: np.ndarray, pieces: Pieces, logp: np.ndarray) -> np.ndarray:
    """Expected number of each piece in words that occur n times."""
    total = np.zeros(len(logp))
    for lo, hi in _slices(words):
        index = Index([SPACE + w for w in words[lo:hi]], pieces)
        edge, spelt = _edge_logp(index, pieces, logp)
        points = len(index.points)
        a = _recursion(index.start, index.size, edge, points)
        # backward sums are forward sums over the mirrored lattice
        mirror = np.full_like(edge, -np.inf)
        p, w = np.nonzero(np.isfinite(edge))
        last = index.start + index.size
        owner = np.searchsorted(index.start, p, side="right") - 1
        flip = index.start[owner] + last[owner]
        mirror[flip - p - w, w] = edge[p, w]
        b = _recursion(index.start, index.size, mirror, points)
        logs = a[p] + edge[p, w] + b[flip - p - w] - a[last[owner]]
        share = np.exp(logs) * n[lo:hi][owner]
        ids = index.edge[p, w] - 1
        real = ids >= 0
        total += np.bincount(ids[real], share[real], len(logp))
        c = index.points[p[~real]]
        n_bytes = 1 + (c > 0x7F).astype(int) + (c > 0x7FF) + (c > 0xFFFF)
        total[pieces.byte_id] += (share[~real] * n_bytes).sum() / 256
    return total


def _slices(words: list[str]) -> Iterator[tuple[int, int]]:
    lo = chars = 0
    for i, w in enumerate(words):
        chars += len(w) + 2
        if chars >= INDEX_CHARS:
            yield lo, i + 1
            lo, chars = i + 1, 0
    if lo < len(words):
        yield lo, len(words)


_BLOCK = pa.schema([("block", pa.int64()), ("word_id", pa.int32()), ("word", pa.binary()), ("n", pa.int64()), ("docs", pa.binary())])


def _block_rows(ids: list, held: list[bool], texts: list[str], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """One row with the documents as word numbers, one row per distinct word."""
    known: defaultdict[bytes, int] = defaultdict(count().__next__)
    number: list[int] = []
    ends = []
    for t in texts:
        number.extend(map(known.__getitem__, t.encode("utf-8", "surrogatepass").lower().split()))
        ends.append(len(number))
    flat, cuts = np.array(number, np.int32), np.array([0, *ends], np.int64)
    train = np.repeat(~np.array(held), np.diff(cuts))
    n = np.bincount(flat[train], minlength=len(known))
    block = uuid.uuid4().int & ((1 << 62) - 1)
    docs = pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(held), pa.LargeListArray.from_arrays(cuts, flat)],
                                      names=["doc_id", "held_out", "words"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(docs)
    yield pa.RecordBatch.from_pylist([{"block": block, "docs": sink.getvalue().to_pybytes()}], schema=_BLOCK)
    words = list(known)
    for i in range(0, len(words), 20_000):
        part = words[i:i + 20_000]
        k = len(part)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(k, block)), pa.array(np.arange(i, i + k, dtype=np.int32)), pa.array(part, pa.binary()),
            pa.array(n[i:i + k].astype(np.int64)), pa.nulls(k, pa.binary())], schema=_BLOCK)


def _blocks(docs: DataFrame) -> DataFrame:
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)

    def tasks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, texts, chars = [], [], [], 0
        for b in it:
            for i, h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                ids.append(i)
                held.append(h)
                texts.append(t.as_py())
                chars += len(texts[-1])
                if chars >= BLOCK_CHARS:
                    yield from _block_rows(ids, held, texts, id_type)
                    ids, held, texts, chars = [], [], [], 0
        if ids:
            yield from _block_rows(ids, held, texts, id_type)

    return docs.mapInArrow(tasks, "block bigint, word_id int, word binary, n bigint, docs binary")


def _distinct_runs(it: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    rows: list[pa.RecordBatch] = []
    for b in it:
        rows.append(b)
        if sum(len(r) for r in rows) >= SCORE_WORDS:
            yield pa.Table.from_batches(rows)
            rows = []
    if rows:
        yield pa.Table.from_batches(rows)


def _strings(words: pa.ChunkedArray) -> list[str]:
    return [w.decode("utf-8", "surrogatepass") for w in words.to_pylist()]


def score_texts(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text",
                folds: int = 10, steps: int = STEPS, prior_weight: float = PRIOR) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score (both log10).

    Learns from documents whose crc32 of the id's text, modulo ``folds``, is not
    0; a null id counts as the empty string. Tokens are words between white
    space after lower-casing A-Z, and one end token per document. Null and
    empty texts hold the end token alone. Repeated rows count as often as
    they occur. The end token's probability in ``score`` is its smoothed
    share of the training tokens. Empty input gives no rows; extra columns
    are ignored.
    """
    tune(docs.sparkSession)
    pieces = load_pieces(model)
    prior = vocabulary_logp(pieces)
    key = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = docs.select(F.col(id_col).alias("doc_id"), (key % folds == 0).alias("held_out"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    c_end = rows.where("not held_out").count()
    blocks = materialize(_blocks(rows), "word-blocks")

    listed = blocks.where("word is not null").select("block", "word_id", "word", "n")
    # one row per word of the corpus; a word of every block is summed before the shuffle
    counted = materialize(listed.groupBy("word").agg(F.sum("n").alias("c")), "corpus-words")
    totals = counted.agg(F.sum("c"), F.count_if(F.col("c") > 0)).first()
    n_all, v_all = (totals[0] or 0) + c_end, (totals[1] or 0) + (c_end > 0)

    def expect(logp: np.ndarray):
        def tasks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(logp))
            for t in _distinct_runs(it):
                total += expected_counts(_strings(t.column(0)), t.column(1).to_numpy().astype(float), pieces, logp)
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["id", "e"])

        return tasks

    train_words = counted.where("c > 0").select("word", "c")
    learned = prior
    for _ in range(steps):
        # at most one row per piece of the vocabulary comes to the driver
        gathered = train_words.mapInArrow(expect(learned), "id bigint, e double").groupBy("id").agg(F.sum("e").alias("e")).collect()
        expected = np.zeros(len(prior))
        for r in gathered:
            expected[r.id] = r.e
        with np.errstate(divide="ignore"):
            learned = np.log((expected + prior_weight * np.exp(prior)) / (expected.sum() + prior_weight))

    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _distinct_runs(it):
            lp = word_logp(_strings(t.column(0)), pieces, learned) / LN10
            for b in pa.table([t.column(0), t.column(1), pa.array(lp)], names=["word", "c", "lp"]).to_batches(max_chunksize=20_000):
                yield b

    words = materialize(counted.mapInArrow(score, "word binary, c bigint, lp double"), "scored-words")
    scored = listed.join(words, "word").select(F.col("block").alias("in_block"), "word_id", "c", "lp")
    shift = np.log10(n_all + ALPHA * (v_all + 1))
    base_end = float(np.log10(c_end + ALPHA) - shift)

    def documents(held: pa.Table, words: pa.Table) -> pa.Table:
        size = len(words)
        c, lp = np.zeros(size), np.zeros(size)
        at = words.column("word_id").to_numpy()
        c[at], lp[at] = words.column("c").to_numpy(), words.column("lp").to_numpy()
        base = np.log10(c + ALPHA) - shift
        out = []
        for payload in held.column("docs"):
            t = pa.ipc.open_stream(payload.as_py()).read_all()
            lists = t.column("words").combine_chunks()
            flat, cuts = lists.values.to_numpy(), lists.offsets.to_numpy()

            def sums(x: np.ndarray) -> np.ndarray:
                run = np.concatenate(([0.0], x[flat])) if len(flat) else np.zeros(1)
                whole = np.zeros(len(cuts) - 1)
                full = np.flatnonzero(np.diff(cuts))
                if len(full):
                    whole[full] = np.add.reduceat(run[1:], cuts[full])
                return whole

            n = np.diff(cuts)
            out.append(pa.table([
                t.column("doc_id"), t.column("held_out"), pa.array(n + 1), pa.array(sums((c > 0) * 1.0).astype(np.int64) + (c_end > 0)),
                pa.array(np.full(len(n), n_all)), pa.array(sums(base) + base_end), pa.array(sums(lp) + n * go_on + end_lp)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]))
        return pa.concat_tables(out) if out else empty

    # a text goes on with a word or ends: each word carries the first probability, the end token the second
    end_lp = float(np.log10((c_end + 1) / (n_all + 2)))
    go_on = float(np.log10((n_all - c_end + 1) / (n_all + 2)))
    empty = pa.table({"doc_id": pa.array([], to_arrow_type(rows.schema["doc_id"].dataType)), "held_out": pa.array([], pa.bool_()),
                      **{k: pa.array([], pa.int64()) for k in ("n_tokens", "n_known", "train_tokens")},
                      **{k: pa.array([], pa.float64()) for k in ("base_score", "score")}})
    held = blocks.where("docs is not null").select("block", "docs")
    return held.groupBy("block").cogroup(scored.groupBy("in_block")).applyInArrow(
        documents, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
