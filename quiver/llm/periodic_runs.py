"""Operator 13: periodic runs of words by difference-cover LCE.

A run is a stretch of words with smallest period q that is at least two
periods long and that no neighbouring word extends. For each period p, words
at distance p are compared along the multiples of p (the harmonic grid): a
run holds two neighbouring grid points, so their words agree. From a grid
point the longest common extension (LCE) to the right and to the left gives
the stretch; two periods or more make it a run, and stretches found again
under a multiple of their period are dropped.

LCE. Two positions are compared word by word for a few words; most end
there. The others reach positions that both belong to a difference cover
(a set of residues modulo v in which any two positions meet after the same
number of words, below v). Only suffixes at cover positions are sorted; the
rest of the extension is a range minimum over the common prefixes of
neighbours in that order, read from a sparse table. Extensions to the left
use the same structure over the reversed words.

Tasks handle documents in batches of a bounded number of words (and one
document), each document followed by a separator of its own; nothing is
shuffled. The cover's modulus grows with the batch, which bounds the table.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quiver.llm.common import space_words, text_of
from quiver.session import tune

MIN_LENGTH = 12
#: Words of a batch (and one document); characters of a batch; grid pairs extended at a time.
BATCH_WORDS, BATCH_CHARS, PAIRS = 200_000, 4_000_000, 500_000
#: Words compared before a cover position is looked for.
FEW = 8


@lru_cache
def cover(r: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(v, is in the cover, words to the next common cover position by difference and residue).

    Colbourn and Ling's rule: 6r + 4 residues cover all differences modulo 24r^2 + 36r + 13.
    """
    v = 24 * r * r + 36 * r + 13
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    inside = np.zeros(v, bool)
    inside[np.cumsum([0, *steps]) % v] = True
    i = np.arange(v)
    wait = np.empty((v, v), np.int16)  # [difference, residue of the first position]
    for d in range(v):
        meet = np.flatnonzero(inside & inside[(i + d) % v])
        wait[d] = (meet[np.searchsorted(meet, i) % len(meet)] - i) % v
    return v, inside, wait


class CoverSuffixes:
    """Sorted suffixes of ``words`` (non-negative codes; separators occur once each) at cover positions."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        r = 1 if n < 1 << 21 else 3 if n < 1 << 23 else 8
        self.v, inside, self.wait = cover(r)
        v = self.v
        self.words = np.concatenate((words, np.full(v + FEW + 1, -1, np.int64)))
        at = np.flatnonzero(inside[np.arange(n) % v])  # ascending positions
        self.number = np.full(n + 2 * v + 1, len(at), np.int64)  # beyond the end: the empty suffix, smallest
        self.number[at] = np.arange(len(at))
        self._sort(at)

    def _sort(self, at: np.ndarray) -> None:
        """Ranks by ever longer prefixes: three words at a time up to v, then doubled; only ties are looked at again."""
        v, m = self.v, len(at)
        rank = np.zeros(m + 1, np.int64)
        rank[m] = -1
        tied = np.arange(m)
        wide = int(self.words.max(initial=0)) + 2
        per = 3 if wide < 1 << 21 else 2

        def split(tied: np.ndarray, key: np.ndarray) -> np.ndarray:
            """Ranks within groups of equal rank get ordered by key; the members that still share one."""
            order = np.lexsort((key, rank[tied]))
            t, k = tied[order], key[order]
            old = rank[t]
            group = np.concatenate(([True], old[1:] != old[:-1]))
            fresh = group | np.concatenate(([True], k[1:] != k[:-1]))
            place = np.arange(len(t))
            start = np.maximum.accumulate(np.where(group, place, 0))
            first = np.maximum.accumulate(np.where(fresh, place, 0))
            rank[t] = old + first - start  # a rank is the number of smaller suffixes
            alone = fresh & np.concatenate((fresh[1:], [True]))
            return t[~alone]

        for off in range(0, v, per):
            if not len(tied):
                break
            key = np.zeros(len(tied), np.int64)
            for j in range(off, min(off + per, v)):
                key = key * wide + (self.words[np.minimum(at[tied] + j, len(self.words) - 1)] + 1)
            tied = split(tied, key)
        levels, size = [], v
        while len(tied):
            levels.append((size, rank.copy()))
            ahead = rank[self.number[np.minimum(at[tied] + size, len(self.number) - 1)]]
            tied = split(tied, ahead)
            size *= 2
        self.rank = rank[:m]
        order = np.empty(m, np.int64)
        order[self.rank] = np.arange(m)
        # common prefixes of neighbours: long equal pieces from the ranks, the last words one by one
        a, b = at[order[:-1]].copy(), at[order[1:]].copy()
        common = np.zeros(max(m - 1, 0), np.int64)
        for size, ranks in reversed(levels):
            x, y = self.number[np.minimum(a, len(self.number) - 1)], self.number[np.minimum(b, len(self.number) - 1)]
            same = (ranks[x] == ranks[y]) & (x < m) & (y < m)
            common[same] += size
            a[same] += size
            b[same] += size
        common += self._direct(a, b, v)[0]
        table = [common.astype(np.int32 if len(self.words) < 1 << 31 else np.int64)]
        while len(table[-1]) > 1 << (len(table) - 1):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        self.table = table

    def _direct(self, i: np.ndarray, j: np.ndarray, most) -> tuple[np.ndarray, np.ndarray]:
        """(equal words up to ``most``, pairs that got that far)."""
        most = np.broadcast_to(most, len(i))
        out = np.zeros(len(i), np.int64)
        end = len(self.words) - 1
        live = np.flatnonzero(most > 0)
        while len(live):
            t = out[live]
            x, y = self.words[np.minimum(i[live] + t, end)], self.words[np.minimum(j[live] + t, end)]
            live = live[(x == y) & (x >= 0)]
            out[live] += 1
            live = live[out[live] < most[live]]
        return out, out == most

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common words from positions i and j on (i != j)."""
        few = self.wait[(j + FEW - i - FEW) % self.v, (i + FEW) % self.v].astype(np.int64) + FEW
        out, far = self._direct(i, j, few)
        far = np.flatnonzero(far)
        if len(far):
            x = self.number[np.minimum(i[far] + out[far], len(self.number) - 1)]
            y = self.number[np.minimum(j[far] + out[far], len(self.number) - 1)]
            ok = (x < len(self.rank)) & (y < len(self.rank))
            far, x, y = far[ok], self.rank[x[ok]], self.rank[y[ok]]
            lo, hi = np.minimum(x, y), np.maximum(x, y)
            level = np.frexp((hi - lo).astype(float))[1] - 1
            more = np.empty(len(far), np.int64)
            for k in np.unique(level).tolist():
                own = level == k
                row = self.table[k]
                more[own] = np.minimum(row[lo[own]], row[hi[own] - (1 << k)])
            out[far] += more
        return out


class Extensions:
    """LCE to the right and to the left over one array of words. The sorted
    suffixes are made when a pair first reaches a cover position."""

    def __init__(self, words: np.ndarray):
        self.words, self.n = words, len(words)
        self.right: CoverSuffixes | None = None
        self.left: CoverSuffixes | None = None

    def _short(self, i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
        """Equal words in one direction, at most FEW; i < j."""
        out = np.zeros(len(i), np.int64)
        live = np.arange(len(i))
        for t in range(FEW):
            a, b = i[live] + step * t, j[live] + step * t
            ok = (a >= 0) & (b < self.n)
            ok[ok] = self.words[a[ok]] == self.words[b[ok]]
            live = live[ok]
            if not len(live):
                break
            out[live] += 1
        return out

    def both(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(common words from i and j on, common words that end before them)."""
        right, left = self._short(i, j, 1), self._short(i - 1, j - 1, -1)
        far = np.flatnonzero(right == FEW)
        if len(far):
            self.right = self.right or CoverSuffixes(self.words)
            right[far] = self.right.lce(i[far], j[far])
        far = np.flatnonzero(left == FEW)
        if len(far):
            self.left = self.left or CoverSuffixes(np.ascontiguousarray(self.words[::-1]))
            left[far] = self.left.lce(self.n - i[far], self.n - j[far])
        return right, left


def runs(words: np.ndarray, longest: int, doc: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Runs as rows (start, length, period), by start and period. ``doc``: the
    document of each word; separators differ from all words; no document has
    more than ``longest`` words."""
    ext = Extensions(words)
    out: list[np.ndarray] = []
    pairs: list[tuple[np.ndarray, int]] = []
    held = 0

    def extend() -> None:
        nonlocal held
        i = np.concatenate([x for x, _ in pairs])
        p = np.repeat([p for _, p in pairs], [len(x) for x, _ in pairs])
        pairs.clear()
        held = 0
        inside = doc[i] == doc[i + p]
        i, p = i[inside], p[inside]
        right, left = ext.both(i, i + p)
        # the first grid point of a run alone reports it
        good = (right + left >= p) & (left < p) & (right + left + p >= min_length)
        out.append(np.stack((i - left, right + left + p, p), 1)[good])

    for p in range(1, longest // 2 + 1):
        grid = words[::p]
        at = np.flatnonzero(grid[1:] == grid[:-1])
        if len(at):
            pairs.append((at * p, p))
            held += len(at)
            if held >= PAIRS:
                extend()
    if pairs:
        extend()
    found = np.concatenate(out) if out else np.zeros((0, 3), np.int64)
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    if len(found):  # the smallest period of a stretch
        found = found[np.concatenate(([True], (found[1:, :2] != found[:-1, :2]).any(1)))]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _batch(ids: list, texts: list[str], min_length: int) -> Iterator[tuple]:
    """(id, n words, runs, collapsed text) of the documents."""
    known: defaultdict[bytes, int] = defaultdict(count().__next__)
    split = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    codes = [np.fromiter(map(known.__getitem__, w), np.int64, len(w)) for w in split]
    some = [k for k, c in enumerate(codes) if len(c) >= min_length]  # shorter ones hold no run
    parts: list[np.ndarray] = []
    for x, k in enumerate(some):
        parts += [codes[k], np.array([len(known) + x])]
    words = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    sizes = [len(codes[k]) + 1 for k in some]
    begin = np.concatenate(([0], np.cumsum(sizes)))[:-1].astype(np.int64) if some else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(some)), sizes)
    found = runs(words, max(sizes, default=1) - 1, doc, min_length)
    owner = doc[found[:, 0]] if len(found) else np.zeros(0, np.int64)
    cut = dict(zip(some, zip(np.searchsorted(owner, np.arange(len(some)), "left").tolist(),
                             np.searchsorted(owner, np.arange(len(some)), "right").tolist(), begin.tolist())))
    for k, (i, w) in enumerate(zip(ids, split)):
        lo, hi, b = cut.get(k, (0, 0, 0))
        own = found[lo:hi] - [b, 0, 0]
        if len(own):
            gone = np.zeros(len(w) + 1, np.int64)
            np.add.at(gone, own[:, 0] + own[:, 2], 1)
            np.add.at(gone, own[:, 0] + own[:, 1], -1)
            w = [x for x, g in zip(w, np.cumsum(gone).tolist()) if not g]
        yield i, len(split[k]), own.tolist(), b" ".join(w).decode("utf-8", "surrogatepass")


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs array<struct<start, length, period>>, collapsed): one row per input row.

    Words stand between ASCII white space and are numbered from 0; ``runs``
    is ordered by start, then period; ``collapsed`` is the text without the
    words that some run contains after its first period, joined by spaces.
    Null, empty and word-less texts have no words, no runs and an empty
    ``collapsed``. Repeated rows each give a row; a null id is kept. Extra
    columns are ignored; empty input gives no rows.
    """
    tune(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    types = (to_arrow_type(kind), pa.int64(), pa.list_(run), pa.string())

    def tasks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, words, chars = [], [], 0, 0

        def rows_of() -> pa.RecordBatch:
            got = [(i, n, [{"start": s, "length": l, "period": p} for s, l, p in r], c) for i, n, r, c in _batch(ids, texts, min_length)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), types)], names=["doc_id", "n_words", "runs", "collapsed"])

        for b in it:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                ids.append(i)
                texts.append(t.as_py())
                words += texts[-1].count(" ") + 1
                chars += len(texts[-1])
                if words >= BATCH_WORDS or chars >= BATCH_CHARS:
                    yield rows_of()
                    ids, texts, words, chars = [], [], 0, 0
        if ids:
            yield rows_of()

    return rows.mapInArrow(tasks, f"doc_id {kind.simpleString()}, n_words bigint, "
                                  "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def planted_text(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text in which, for ids whose crc32 ends in 0, the words from place a
    on repeat with period p (see the contract of the query)."""
    h = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    g = F.floor(h / 10)
    w = space_words(text_of(text_col))
    n = F.size(w)
    a = F.pmod(g, n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int")))
    planted = F.array_join(F.concat(F.slice(w, 1, a), F.slice(again, 1, n - a)), " ")
    return F.when((h % 10 == 0) & (n > 0), planted).otherwise(text_of(text_col))


def digest(found: DataFrame) -> DataFrame:
    """Per document the number of runs, the longest one and digests of all runs and of the collapsed text."""
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    out = found.withColumn("top", longest)
    return out.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("top.s").alias("start"),
                      (-F.col("top.l")).alias("length"), F.col("top.p").alias("period"),
                      F.floor(-F.col("top.l") * 1000 / F.col("top.p")).alias("exponent_milli"),
                      F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
