"""Word trigrams as packed blocks in numpy: cut from texts, counted and looked up bucket by bucket.

A word's key is Spark's ``xxhash64(lang, xxhash64(word))``, so languages share no key. A record is a
word v with the words u before and w after it (keys of the start and of the end stand in for missing
ones), so each word of a text is the middle of one record. Records are dealt by the middle
word into buckets: all that is counted of a triple (u, v, w), pair (v, w) and context (u, v)
meets there. A task cuts the texts of a unit at a time and writes one block for each bucket
and language: the distinct keys once and small numbers for them, compressed, a few bytes a record. Of texts that are looked
up, words that a filter of the known ones excludes are left out: no table holds them.

A very common middle word (``hot``) is cut further by the word before it, into parts that a task handles one after the
other, so no task holds all of its triples at once; the pairs of all parts are summed up at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast

from quiver.llm.common import LOWER, SEED, SPACES, UPPER

#: Bytes of text that are cut at once; a longer text is a unit of its own.
UNIT_BYTES = 4 << 20
#: Bytes hashed at once.
HASH_BYTES = 1 << 19
#: Records that wait before equal ones are counted.
PENDING = 500_000
#: Rows of a block that a table is written in.
BLOCK_ROWS = 200_000
#: Rows of small tables that are gathered before they are packed.
PACK_ROWS = 200_000
#: Keys of the end of a text and of a word that no table holds.
END, UNKNOWN = 0, 1
#: Bits of a segment of a ``known`` filter, by a power of 2.
SEGMENT = 16

_U = np.uint64
_P1, _P2, _P3, _P4, _P5 = (_U(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[np.frombuffer(UPPER.encode(), np.uint8)] = np.frombuffer(LOWER.encode(), np.uint8)
_WORD = np.ones(256, bool)
_WORD[np.frombuffer(SPACES.encode(), np.uint8)] = False
#: A word's bytes as a polynomial (for equal words within a unit only, its key is the true hash).
_BYTE = np.random.default_rng(7).integers(0, 2 ** 64, 256, np.uint64, endpoint=False)[_LOWER] | _U(1)
_BASE = 0x5851F42D4C957F2D
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _rotl(x: np.ndarray, k: int) -> np.ndarray:
    return (x << _U(k)) | (x >> _U(64 - k))


def hash_long(x: np.ndarray, seed: int) -> np.ndarray:
    """Spark's ``xxhash64`` of longs after a value whose hash is ``seed``."""
    h = (_U(seed & (2 ** 64 - 1)) + _P5 + _U(8)) ^ (_rotl(x * _P2, 31) * _P1)
    return _spread(_rotl(h, 27) * _P1 + _P4)


def _spread(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _P2
    h = (h ^ (h >> _U(29))) * _P3
    return h ^ (h >> _U(32))


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Spark's ``xxhash64`` of parts of ``data``, those of one length at a time."""
    import xxhash

    size, out = ends - starts, np.empty(len(starts), np.uint64)
    for n in np.flatnonzero(np.bincount(np.minimum(size, 32), minlength=33)[:32]).tolist():
        at = np.flatnonzero(size == n)
        rows, j = data[starts[at][:, None] + np.arange(n)], 0
        h = np.full(len(at), _U(SEED + n) + _P5)
        while j + 8 <= n:
            lane = np.ascontiguousarray(rows[:, j:j + 8]).view("<u8").ravel()
            h, j = _rotl(h ^ (_rotl(lane * _P2, 31) * _P1), 27) * _P1 + _P4, j + 8
        if j + 4 <= n:
            lane = np.ascontiguousarray(rows[:, j:j + 4]).view("<u4").ravel().astype(np.uint64)
            h, j = _rotl(h ^ (lane * _P1), 23) * _P2 + _P3, j + 4
        while j < n:
            h, j = _rotl(h ^ (rows[:, j].astype(np.uint64) * _P5), 11) * _P1, j + 1
        out[at] = _spread(h)
    for i in np.flatnonzero(size >= 32).tolist():
        out[i] = xxhash.xxh64_intdigest(data[starts[i]:ends[i]].tobytes(), SEED)
    return out


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A key of two keys, in order."""
    x = a * _P1 + b * _P2
    x = (x ^ (x >> _U(32))) * _P3
    return x ^ (x >> _U(29))


def seed_of(lang: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), SEED)


def start_key(lang: str) -> int:
    """Key that stands for the start of a text."""
    with np.errstate(over="ignore"):
        return int(hash_long(np.zeros(1, np.uint64), seed_of(lang))[0])


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, n of each at least."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 2 ** 64))):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            _powers[i] = np.multiply.accumulate(x)
    return _powers[0], _powers[1]


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts that stand one after another in ``data``, and the number of each text."""
    word = _WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty_like(word)
    before[:1], before[1:] = False, word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty_like(word)
    after[-1:], after[:-1] = False, word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def _polynomials(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit number for each word, equal for equal words (A-Z as a-z)."""
    out, a = np.empty(len(starts), np.uint64), 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + HASH_BYTES, "right")))
        lo = int(starts[a])
        power, inverse = _power(max(HASH_BYTES, int(ends[b - 1]) - lo) + 1)
        x = _BYTE[data[lo:ends[b - 1]]]
        x *= power[:len(x)]
        sums = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(x, out=sums[1:])
        s, e = starts[a:b] - lo, ends[a:b] - lo
        out[a:b] = (sums[e] - sums[s]) * inverse[s]
        a = b
    return out


class Unit:
    """Texts cut into words: codes of each record's words into ``keys``, doc (number of its text among those that have
    words), rows (which texts have words) and words (how many)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lang: np.ndarray, langs: list[str]):
        starts, ends, per = cut(data, offsets)
        self.rows = np.flatnonzero(per)
        self.words = per[self.rows]
        seeds = [seed_of(x) for x in langs]
        of = np.repeat(lang, per)
        h = _polynomials(data, starts, ends) + hash_long(np.arange(len(langs), dtype=np.uint64), 1)[of]
        codes = pa.array(h).dictionary_encode()
        size, codes = len(codes.dictionary), codes.indices.to_numpy(zero_copy_only=False)
        first = np.empty(size, np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        own = hash_words(_LOWER[data], starts[first], ends[first])
        del starts, ends, h
        #: Language of each key; the starts' keys, UNKNOWN and END follow the words'.
        self.lang = np.concatenate([of[first], np.arange(len(langs)), [0, 0]]).astype(np.int32)
        keys = np.empty(size + len(langs) + 2, np.uint64)
        for i, seed in enumerate(seeds):
            mine = np.flatnonzero(self.lang[:size] == i)
            keys[mine] = hash_long(own[mine], seed)
            keys[size + i] = hash_long(np.zeros(1, np.uint64), seed)[0]
        keys[-2:] = UNKNOWN, END
        self.keys, self.size = keys, size
        at = np.concatenate([[0], np.cumsum(self.words + 2)])
        seq = np.empty(at[-1], np.int32)
        inner = np.ones(at[-1], bool)
        inner[at[:-1]] = inner[at[1:] - 1] = False
        seq[inner] = codes
        seq[at[:-1]] = size + lang[self.rows]
        seq[at[1:] - 1] = len(keys) - 1
        here = inner
        here[at[:-1]] = True
        here = np.flatnonzero(here)
        self.v, self.w, self.u = seq[here], seq[here + 1], seq[here - 1]
        heads = at[:-1] - np.arange(len(self.words))
        self.u[heads] = self.v[heads]
        self.doc = np.repeat(np.arange(len(self.words), dtype=np.int32), self.words + 1)


def units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Unit, list[str], np.ndarray | None]]:
    """Of batches (lang, text, id bigint or absent): cut texts, their languages' names and the ids of the texts with words."""
    parts: list[tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray | None]] = []

    def unit():
        data = np.concatenate([p[0] for p in parts])
        offsets = np.concatenate([[0], np.cumsum(np.concatenate([p[1] for p in parts]))])
        lang = pa.concat_arrays([p[2].cast(pa.string()) for p in parts]).dictionary_encode()
        cut_up = Unit(data, offsets, lang.indices.to_numpy(zero_copy_only=False), lang.dictionary.to_pylist())
        ids = np.concatenate([p[3] for p in parts])[cut_up.rows] if parts[0][3] is not None else None
        parts.clear()
        pa.default_memory_pool().release_unused()
        return cut_up, lang.dictionary.to_pylist(), ids

    waiting = 0
    for b in batches:
        text = b.column(1).cast(pa.large_string())
        at = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
        data = np.frombuffer(text.buffers()[2], np.uint8) if text.buffers()[2] else np.empty(0, np.uint8)
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(at, at[i] + UNIT_BYTES - waiting, "right")) - 1)
            parts.append((data[at[i]:at[j]], np.diff(at[i:j + 1]), b.column(0).slice(i, j - i),
                          b.column(2).slice(i, j - i).to_numpy(zero_copy_only=False) if b.num_columns > 2 else None))
            waiting += int(at[j] - at[i])
            if waiting >= UNIT_BYTES:
                yield unit()
                waiting = 0
            i = j
    if parts:
        yield unit()


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return np.mod(keys.view(np.int64), buckets)


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed block."""
    kinds = np.array([x for a in arrays for x in (a.dtype.num, len(a))], np.int64)
    raw = b"".join([np.int64(len(arrays)).tobytes(), kinds.tobytes(), *[a.tobytes() for a in arrays]])
    return np.int64(len(raw)).tobytes() + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


_KINDS = {np.dtype(x).num: np.dtype(x) for x in (np.uint8, np.uint16, np.uint32, np.int64, np.uint64, np.float64)}


def unpacked(block: bytes) -> list[np.ndarray]:
    raw = pa.Codec("zstd").decompress(block[8:], int.from_bytes(block[:8], "little"), asbytes=True)
    n = int.from_bytes(raw[:8], "little")
    kinds, at, out = np.frombuffer(raw, np.int64, 2 * n, 8), 8 + 16 * n, []
    for kind, size in kinds.reshape(-1, 2).tolist():
        out.append(np.frombuffer(raw, _KINDS[kind], size, at))
        at += _KINDS[kind].itemsize * size
    return out


def _small(x: np.ndarray) -> np.ndarray:
    most = int(x.max(initial=0))
    return x.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32)


def pack_keys(columns: list[np.ndarray], *more: np.ndarray) -> bytes:
    """Columns of keys as numbers of their distinct keys, and further arrays."""
    codes = pa.array(np.concatenate(columns)).dictionary_encode()
    numbers = _small(codes.indices.to_numpy(zero_copy_only=False))
    return _packed(codes.dictionary.to_numpy(), *np.split(numbers, len(columns)), *more)


def _segments(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and starts of the runs of equal values, and the length at the end."""
    heads = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.empty(0, np.int64)
    return x[heads], np.append(heads, len(x))


def _probes(keys: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A key's segment of a filter and two bits in it."""
    return (keys >> _U(64 - segments.bit_length() + 1)).astype(np.int64), (keys & _U((1 << SEGMENT) - 1)).astype(np.int64), (
        keys >> _U(SEGMENT) & _U((1 << SEGMENT) - 1)).astype(np.int64)


def filter_segments(batches: Iterator[pa.RecordBatch], segments: int) -> Iterator[pa.RecordBatch]:
    """(segment, bits) of a filter of keys (key); a segment's keys are all here."""
    bits: dict[int, np.ndarray] = {}
    for b in batches:
        at, x, y = _probes(b.column(0).to_numpy().astype(np.int64).view(np.uint64), segments)
        order = np.argsort(at, kind="stable")
        of, heads = _segments(at[order])
        for k, s, e in zip(of.tolist(), heads.tolist(), heads[1:].tolist()):
            mine = bits.setdefault(k, np.zeros(1 << SEGMENT, bool))
            mine[x[order[s:e]]] = mine[y[order[s:e]]] = True
    for k, mine in bits.items():
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([np.packbits(mine).tobytes()], pa.binary())], names=["segment", "bits"])


def known(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether the filter may hold the keys; never false for one that it holds."""
    segments = len(bits) >> SEGMENT - 3
    at, x, y = _probes(keys, segments)
    at <<= SEGMENT - 3
    return (bits[at + (x >> 3)] >> (7 - (x & 7)).astype(np.uint8) & bits[at + (y >> 3)] >> (7 - (y & 7)).astype(np.uint8) & 1).astype(bool)


def deal(u: Unit, buckets: int, hot: dict[int, tuple[int, int]], slices: int = 1, i: int = 0,
         ended: bool = True, some: np.ndarray | None = None, common: np.ndarray | None = None) -> Iterator[tuple[int, int, int, bytes]]:
    """(language, bucket, part, block) of the unit's records in the buckets of slice ``i``; without ``ended`` those before an end
    are left out. hot: of very common words the first part and how many parts. some: keys that matter; records around others are left
    out, others beside them become UNKNOWN. common: numbers of keys in a table that readers have, -1 for others."""
    bucket = bucket_of(u.keys, buckets)
    of, group = np.unique(u.lang.astype(np.int64) * buckets + bucket, return_inverse=True)
    mine = (bucket % slices == i)[u.v]
    if not ended:
        mine &= u.w != len(u.keys) - 1
    if some is not None:
        mine &= some[u.v]
    mine = np.flatnonzero(mine)
    a, v, b, doc = u.u[mine], u.v[mine], u.w[mine], u.doc[mine]
    if some is not None:
        as_known = np.where(some, np.arange(len(some)), len(some) - 2).astype(np.int32)
        a, b = as_known[a], as_known[b]
    # groups of the other words and of the parts of very common ones
    of, part = list(zip(of.tolist(), [0] * len(of))), np.zeros((len(u.keys), 2), np.int64)
    code = group.astype(np.int32)[v]
    if hot:
        often = np.flatnonzero(pc.is_in(pa.array(u.keys), value_set=pa.array(np.array(list(hot), np.uint64))).to_numpy(zero_copy_only=False))
        for k in often.tolist():
            first, n = hot[int(u.keys[k])]
            part[k] = len(of), n
            of += [(of[group[k]][0], first + x) for x in range(n)]
        at = np.flatnonzero(part[:, 1][v])
        first, n = part[v[at]].T
        code[at] = first + (u.keys[a[at]] >> _U(32)).astype(np.int64) % n
    order = np.argsort(code.astype(np.uint16) if len(of) < 1 << 16 else code, kind="stable")
    a, v, b, doc = a[order], v[order], b[order], doc[order]
    edges = np.append(np.searchsorted(code[order], np.arange(len(of))), len(v))
    mark, number = np.zeros(len(u.keys), bool), np.empty(len(u.keys), np.uint32)
    common = np.full(len(u.keys), -1) if common is None else common
    # in the order of their numbers
    ranked = np.argsort(common, kind="stable")
    ranked = np.roll(ranked, -np.searchsorted(common[ranked], 0))
    place = np.empty(len(ranked), np.int32)
    place[ranked] = np.arange(len(ranked))
    keys, common = u.keys[ranked], common[ranked]
    a, v, b = place[a], place[v], place[b]
    for (g, part), s, e in zip(of, edges.tolist(), edges[1:].tolist()):
        if s == e:
            continue
        cols = [a[s:e], v[s:e], b[s:e]]
        for c in cols:
            mark[c] = True
        used = np.flatnonzero(mark)
        mark[used] = False
        number[used] = np.arange(len(used))
        texts, heads = _segments(doc[s:e])
        small = np.uint16 if len(used) < 1 << 16 else np.uint32
        shared = common[used]
        shared = shared[shared >= 0]
        block = _packed(_small(np.diff(shared, prepend=0)), keys[used[len(shared):]], *[number[c].astype(small) for c in cols], _small(texts), _small(np.diff(heads)))
        yield g // buckets, g % buckets, part, block


def ranks(keys: np.ndarray, table: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Numbers of the keys in a table that ``order`` sorts, -1 for others."""
    if not len(table):
        return np.full(len(keys), -1)
    at = order[np.minimum(np.searchsorted(table, keys, sorter=order), len(table) - 1)]
    return np.where(table[at] == keys, at, -1)


def records(block: bytes, table: np.ndarray | None = None) -> list[np.ndarray]:
    """Keys, numbers of u, v and w, texts and their numbers of records of a block that ``deal`` made."""
    shared, own, *cols = unpacked(block)
    return [np.concatenate([table[np.cumsum(shared, dtype=np.int64)], own]) if len(shared) else own, *cols]


def _summed(key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each distinct key: where it stands first when sorted (numbers into ``key``), summed counts, and the runs' edges."""
    order = np.argsort(key)
    _, heads = _segments(key[order])
    return order[heads[:-1]], np.add.reduceat(count[order], heads[:-1]) if len(key) else count, heads


class Triples:
    """Counts of the triples of one language, bucket and part."""

    def __init__(self):
        self.done = [np.empty(0, np.uint64)] * 3 + [np.empty(0, np.int64)]
        self.wait: list[list[np.ndarray]] = []
        self.n = 0

    def add(self, a: np.ndarray, v: np.ndarray, b: np.ndarray, c: np.ndarray | None = None) -> None:
        self.wait.append([a, v, b, np.ones(len(a), np.int64) if c is None else c])
        self.n += len(a)
        if self.n > max(PENDING, len(self.done[0])):
            self.count()

    def count(self) -> list[np.ndarray]:
        if self.wait:
            cols = [np.concatenate(x) for x in zip(self.done, *self.wait)]
            self.wait, self.n, self.done = [], 0, []
            first, c, _ = _summed(mix(mix(cols[0], cols[1]), cols[2]), cols[3])
            self.done = [x[first] for x in cols[:3]] + [c]
        return self.done


def _of_counts(c: np.ndarray) -> list[int]:
    return [int(x) for x in np.bincount(np.minimum(c, 5), minlength=6)[1:5]]


#: Rows of ``counted``: kind is "T" (a block of triples: u, v, w, count), "C" (of a very common v's pairs: v, w, count), "V" (counts after the
#: word key), "W" (n distinct words before the word key), "3" and "2" (counts of counts) and "start" (those after the start).
COUNTED = "kind string, bucket int, lang string, part int, key bigint, total bigint, n bigint, n1 bigint, n2 bigint, n3 bigint, n4 bigint, data binary"
_COUNTED = pa.schema([("kind", pa.string()), ("bucket", pa.int32()), ("lang", pa.string()), ("part", pa.int32())]
                     + [(x, pa.int64()) for x in ("key", "total", "n", "n1", "n2", "n3", "n4")] + [("data", pa.binary())])


def _batch(kind: str, bucket: int, lang: str, part: int, rows: int, **columns) -> pa.RecordBatch:
    def column(f: pa.Field) -> pa.Array:
        if f.name in columns:
            x = columns[f.name]
            return pa.array(x.view(np.int64) if isinstance(x, np.ndarray) and x.dtype == np.uint64 else x, f.type)
        fixed = {"kind": kind, "bucket": bucket, "lang": lang, "part": part}
        return pa.repeat(pa.scalar(fixed[f.name], f.type), rows) if f.name in fixed else pa.nulls(rows, f.type)

    return pa.RecordBatch.from_arrays([column(f) for f in _COUNTED], schema=_COUNTED)


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(b.schema.get_field_index(x)).to_pylist() for x in names))


def _blocks(n: int) -> Iterator[slice]:
    return (slice(i, i + BLOCK_ROWS) for i in range(0, n, BLOCK_ROWS))


def count_buckets(batches: Iterator[pa.RecordBatch], only_words: bool = False) -> Iterator[pa.RecordBatch]:
    """``COUNTED`` rows of blocks sorted by bucket, language and part. only_words: "W" rows only."""
    def part_done(at: tuple, triples: Triples, pairs: list) -> Iterator[pa.RecordBatch]:
        a, v, b, c = triples.count()
        if not only_words:
            order = np.argsort(v)  # packs better
            a, v, b, c = a[order], v[order], b[order], c[order]
            for s in _blocks(len(v)):
                yield _batch("T", *at, 1, data=[pack_keys([a[s], v[s], b[s]], _small(c[s]))])
            yield _batch("3", *at, 1, key=[0], **{f"n{i + 1}": [x] for i, x in enumerate(_of_counts(c))})
            first = _U(start_key(at[1]))
            if len(x := c[(v == first) & (a == first)]):
                yield _batch("start", *at, 1, key=[0], total=[int(x.sum())], n=[len(x)], **{f"n{i + 1}": [y] for i, y in enumerate(_of_counts(x))})
        first, c, _ = _summed(mix(v, b), np.ones(len(v), np.int64))
        pairs.append((v[first], b[first], c, np.full(len(c), at[2] > 0)))

    def bucket_done(bucket: int, lang: str, pairs: list) -> Iterator[pa.RecordBatch]:
        v, b, c, cut_up = (np.concatenate(x) for x in zip(*pairs))
        if len(pairs) > 1:
            first, c, _ = _summed(mix(v, b), c)
            v, b, cut_up = v[first], b[first], cut_up[first]
        at = (bucket, lang, 0)
        first, n, _ = _summed(b, np.ones(len(b), np.int64))
        for s in _blocks(len(first)):
            yield _batch("W", *at, len(n[s]), key=b[first[s]], n=n[s])
        if only_words:
            return
        order = np.argsort(v)
        v, b, c, cut_up = v[order], b[order], c[order], np.flatnonzero(cut_up[order])
        # those of the other words follow from their triples
        for s in _blocks(len(cut_up)):
            s = cut_up[s]
            yield _batch("C", *at, 1, data=[pack_keys([v[s], b[s]], _small(c[s]))])
        yield _batch("2", *at, 1, key=[0], **{f"n{i + 1}": [x] for i, x in enumerate(_of_counts(c))})
        words, heads = _segments(v)
        sums = [np.add.reduceat(x.astype(np.int64), heads[:-1]) for x in (c, c == 1, c == 2)]
        for s in _blocks(len(words)):
            yield _batch("V", *at, len(words[s]), key=words[s], n=np.diff(heads)[s], **{x: y[s] for x, y in zip(("total", "n1", "n2"), sums)})

    with np.errstate(over="ignore"):
        at, triples, pairs = None, Triples(), []
        for bucket, lang, part, data in _rows(batches, "bucket", "lang", "part", "data"):
            if at != (bucket, lang, part):
                if at:
                    yield from part_done(at, triples, pairs)
                    if at[:2] != (bucket, lang):
                        yield from bucket_done(*at[:2], pairs)
                        pairs = []
                at, triples = (bucket, lang, part), Triples()
            keys, a, v, b = records(data)[:4]
            triples.add(keys[a], keys[v], keys[b])
        if at:
            yield from part_done(at, triples, pairs)
            yield from bucket_done(*at[:2], pairs)


class Table:
    """Values by 64-bit key, sorted by the key's hash and found from its upper bits on."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        bits = max(1, len(keys).bit_length())
        self.shift = _U(64 - bits)
        home = ((keys * _P2) >> self.shift).astype(np.int32 if bits < 31 else np.int64)
        order = np.argsort(home, kind="stable")
        self.first = np.zeros((1 << bits) + 1, np.int64)
        np.cumsum(np.bincount(home, minlength=1 << bits), out=self.first[1:])
        self.keys, self.values = keys[order], [x[order] for x in values]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the keys that are there, and their places."""
        home = ((keys * _P2) >> self.shift).astype(np.int64)
        place, end = self.first[home], self.first[home + 1]
        left, found, places = np.flatnonzero(place < end), [], []
        keys, place, end = keys[left], place[left], end[left]
        while len(left):
            same = self.keys[place] == keys
            found.append(left[same])
            places.append(place[same])
            on = np.flatnonzero(~same & (place + 1 < end))
            left, keys, place, end = left[on], keys[on], place[on] + 1, end[on]
        return (np.concatenate(found), np.concatenate(places)) if found else (left, left)


#: Rows that ``look_up`` takes, sorted by bucket, language, part and kind: blocks of words (kind 0: key, gain of its own probability
#: against an unknown word's, toxic ratio against an unknown word's, log mass), of words' probabilities (1: key, p), of very common words' pairs (2), triples (3)
#: and texts' records (4), d1 to d3 the discounts of pairs and e1 to e3 of triples; and the texts' ids and numbers of words (5).
LOOKED_UP = "bucket int, lang string, part int, kind int, unit bigint, data binary, d1 double, d2 double, d3 double, e1 double, e2 double, e3 double"


_DISCOUNTS = ("d1", "d2", "d3", "e1", "e2", "e3")


def _gather(blocks: list[bytes], keyed: int) -> list[np.ndarray]:
    """The columns of packed blocks: ``keyed`` columns of keys and the others."""
    cols = [unpacked(x) for x in blocks]
    return [np.concatenate(x) for x in zip(*([c[0][n] for n in c[1:1 + keyed]] + c[1 + keyed:] for c in cols))]


def look_up(batches: Iterator[pa.RecordBatch], filters: Broadcast) -> Iterator[pa.RecordBatch]:
    """(unit, kind, data) of ``LOOKED_UP`` rows: for each block of texts (kind 1) the texts' numbers, summed terms and largest toxic ratios;
    rows of kind 5 as they are (kind 0)."""
    empty = np.empty(0, np.uint64), np.empty(0), np.empty(0)

    def discounted(c: np.ndarray, heads: np.ndarray, d: tuple) -> tuple[np.ndarray, np.ndarray]:
        """(share, gamma), gamma by run, of counts in runs of one context."""
        off = np.where(c == 1, d[0], np.where(c == 2, d[1], d[2]))
        total, lost = np.add.reduceat(c, heads[:-1]).astype(float), np.add.reduceat(off, heads[:-1])
        return (c - off) / np.repeat(total, np.diff(heads)), lost / total

    def words() -> Table:
        if not blocks[0]:
            return Table(*empty, np.empty(0))
        return Table(*_gather(blocks[0], 1))

    def model(before: np.ndarray, key: np.ndarray, c: np.ndarray, lower: np.ndarray, d: tuple) -> tuple[np.ndarray, ...]:
        """Keys of n-grams, their gains and whole probabilities, the contexts' keys and masses; of the contexts' and n-grams' keys,
        counts and the lower order's probabilities."""
        order = np.argsort(before)
        before, key, c, lower = before[order], key[order], c[order].astype(np.int64), lower[order]
        of, heads = _segments(before)
        share, gamma = discounted(c, heads, d)
        lower *= np.repeat(gamma, np.diff(heads))
        return key, np.log1p(share / lower), share + lower, of, gamma

    def found(table: Table, value: int, keys: np.ndarray) -> np.ndarray:
        n, place = table.find(keys)
        out = np.empty(len(keys))
        out[n] = table.values[value][place]
        return out

    def pairs(cols: list[np.ndarray]) -> Table:
        v, b, c = cols
        return Table(*model(v, mix(v, b), c, found(word_p, 0, b), cuts[2])[:3])

    def own_pairs() -> list[np.ndarray]:
        parts = []
        for block in blocks[3]:
            _, v, b, _ = _gather([block], 3)
            first, c, _ = _summed(mix(v, b), np.ones(len(v), np.int64))
            parts.append((v[first], b[first], c))
        v, b, c = (np.concatenate(x) for x in zip(*parts))
        first, c, _ = _summed(mix(v, b), c)
        return [v[first], b[first], c]

    def triples(pair: Table) -> tuple[Table, Table]:
        parts, start = [], _U(start_key(at[1]))
        for block in blocks[3]:
            a, v, b, c = _gather([block], 3)
            before = mix(a, v)
            parts.append((before, mix(before, b), c.astype(np.uint32), found(pair, 1, mix(v, b)), before[v == start]))
        before, key, c, lower, starts = (np.concatenate(x) for x in zip(*parts))
        key, gain, _, context, gamma = model(before, key, c, lower, cuts[3])
        # the start's weights are added to each text elsewhere
        inner = ~np.isin(context, np.unique(starts))
        return Table(key, gain), Table(context[inner], np.log(gamma[inner]))

    def row(unit: int, kind: int, data: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([unit], pa.int64()), pa.array([kind], pa.int32()), pa.array([data], pa.binary())],
                                          names=["unit", "kind", "data"])

    with np.errstate(over="ignore"):
        at, ready = (None, None, None), False
        for bucket, lang, part, kind, unit, data, *d in _rows(batches, "bucket", "lang", "part", "kind", "unit", "data", *_DISCOUNTS):
            if kind == 5:
                yield row(unit, 0, data)
                continue
            if (bucket, lang) != at[:2]:
                blocks, cuts, word, word_p, common_pair = {0: [], 1: [], 2: [], 3: []}, {}, None, None, None
            if (bucket, lang, part) != at:
                at, blocks[3], ready = (bucket, lang, part), [], False
            if kind < 4:
                blocks[kind].append(data)
                if kind == 3:
                    cuts = {2: d[:3], 3: d[3:]}
                elif kind == 2:
                    cuts = {2: d[:3]}
                continue
            if not ready:
                if word is None:
                    word, word_p = words(), Table(*_gather(blocks[1], 1)) if blocks[1] else Table(*empty[:2])
                    common_pair = pairs(_gather(blocks[2], 2)) if blocks[2] else Table(*empty)
                    blocks[0], blocks[1], blocks[2] = [], [], []
                pair = common_pair if part else pairs(own_pairs()) if blocks[3] else Table(*empty)
                triple, context = triples(pair) if blocks[3] else (Table(*empty[:2]), Table(*empty[:2]))
                blocks[3], ready = [], True
            keys, a, v, b, texts, per = records(data, filters.value[1])
            first, gains = _U(start_key(lang)), np.zeros(len(v))
            last = keys[b] == _U(END)
            # what depends on the middle word alone
            n, place = word.find(keys)
            own, mass, ratio = np.zeros(len(keys)), np.zeros(len(keys)), np.ones(len(keys))
            own[n], ratio[n], mass[n] = (x[place] for x in word.values)
            gains += own[v] + np.where(last, 0.0, mass[v])
            mid, after = keys[v], keys[b]
            before = mix(keys[a], mid)
            for table, key in ((pair, mix(mid, after)), (triple, mix(before, after)), (context, before)):
                n, place = table.find(key)
                gains[n] += np.where(last[n], 0.0, table.values[0][place])
            ratio[keys == first] = 0.0
            heads = np.concatenate([[0], np.cumsum(per, dtype=np.int64)])[:-1]
            yield row(unit, 1, _packed(texts, np.add.reduceat(gains, heads), np.maximum.reduceat(ratio[v], heads)))


def sum_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n, terms, ratio) of each text, of ``look_up``'s rows sorted by unit and kind."""
    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n), pa.array(terms), pa.array(ratio)], names=["id", "n", "terms", "ratio"])

    at = None
    for unit, kind, data in _rows(batches, "unit", "kind", "data"):
        if unit != at:
            if at is not None:
                yield done()
            at = unit
        if kind == 0:
            ids, n, ratio = unpacked(data)
            terms, ratio = np.zeros(len(ids)), ratio.astype(float)
        else:
            texts, sums, most = unpacked(data)
            terms[texts] += sums
            ratio[texts] = np.maximum(ratio[texts], most)
    if at is not None:
        yield done()


def census(batches: Iterator[pa.RecordBatch], share: float = 1 / 2000) -> Iterator[pa.RecordBatch]:
    """(key, n): words with at least ``share`` of a unit's, and the number of all words (key: that of the end)."""
    with np.errstate(over="ignore"):
        for u, _, _ in units(batches):
            n = np.bincount(u.v, minlength=len(u.keys))
            often = np.flatnonzero(n >= max(2, share * len(u.v)))
            yield pa.RecordBatch.from_arrays([pa.array(np.append(u.keys[often], _U(END)).view(np.int64)),
                                              pa.array(np.append(n[often], int(u.words.sum())).astype(np.int64))], names=["key", "n"])


def fit_blocks(batches: Iterator[pa.RecordBatch], buckets: int, hot: dict) -> Iterator[pa.RecordBatch]:
    """(bucket, lang, part, data) of batches (lang, text)."""
    with np.errstate(over="ignore"):
        for u, langs, _ in units(batches):
            for lang, bucket, part, block in deal(u, buckets, hot, ended=False):
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([langs[lang]]), pa.array([part], pa.int32()), pa.array([block], pa.binary())],
                                                 names=["bucket", "lang", "part", "data"])


_LOOKED_UP = pa.schema([("bucket", pa.int32()), ("lang", pa.string()), ("part", pa.int32()), ("kind", pa.int32()), ("unit", pa.int64()),
                        ("data", pa.binary())] + [(x, pa.float64()) for x in _DISCOUNTS])


def _looked_up(bucket: int, lang: str, part: int, kind: int, unit: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"bucket": bucket, "lang": lang, "part": part, "kind": kind, "unit": unit, "data": data}], _LOOKED_UP)


def text_blocks(batches: Iterator[pa.RecordBatch], buckets: int, hot: dict, slices: int, i: int, filters: Broadcast) -> Iterator[pa.RecordBatch]:
    """``LOOKED_UP`` rows of batches (lang, text, id) for the buckets of slice ``i``; filters: the filter of
    all known words and a table of common ones."""
    from pyspark import TaskContext

    bits, table = filters.value
    order = np.argsort(table)
    with np.errstate(over="ignore"):
        for number, (u, langs, ids) in enumerate(units(batches)):
            if not len(ids):
                continue
            # the same whenever a task is run again
            unit = (TaskContext.get().partitionId() << 32) + number
            some = known(u.keys, bits)
            some[u.size:] = True
            # an unknown word's toxic ratio is 1
            ratio = np.bincount(u.doc[~some[u.v]], minlength=len(ids)) > 0
            yield _looked_up(unit % buckets // slices * slices + i, "", -1, 5, unit, _packed(ids.astype(np.int64), u.words.astype(np.int64), ratio.astype(np.uint8)))
            for lang, bucket, part, block in deal(u, buckets, hot, slices, i, some=some, common=ranks(u.keys, table, order)):
                yield _looked_up(bucket, langs[lang], part, 4, unit, block)


def pack_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``LOOKED_UP`` blocks of rows (kind 0 or 1, bucket, lang, key, a, b, c)."""
    def done() -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(waiting)
        lang = t["lang"].combine_chunks().dictionary_encode()
        kind, bucket, key = (t[x].to_numpy() for x in ("kind", "bucket", "key"))
        group = (lang.indices.to_numpy(zero_copy_only=False).astype(np.int64) << 33) + (bucket.astype(np.int64) << 1) + kind
        order = np.argsort(group, kind="stable")
        of, heads = _segments(group[order])
        cols = [t[x].to_numpy()[order] for x in "abc"]
        key = key[order].astype(np.int64).view(np.uint64)
        for g, s, e in zip(of.tolist(), heads.tolist(), heads[1:].tolist()):
            more = [x[s:e].astype(float) for x in cols[:1 if g & 1 else 3]]
            yield _looked_up(g >> 1 & (1 << 32) - 1, lang.dictionary[g >> 33].as_py(), -1, g & 1, 0,
                             _packed(key[s:e], np.arange(e - s, dtype=np.uint32), *more))

    waiting, n = [], 0
    for b in batches:
        waiting.append(b)
        n += b.num_rows
        if n >= PACK_ROWS:
            yield from done()
            waiting, n = [], 0
    if n:
        yield from done()
