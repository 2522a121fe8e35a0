"""Ranked search, source mixing and periodic runs against brute force on small and awkward inputs."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quiver.llm import periodic_runs, queries, ranked_search, source_mixing
from tests.conftest import SF001

SCHEMA = "doc_id long, text string, source string"
rng = random.Random(11)
VOCAB = [f"w{i}é"[: 2 + i % 3] for i in range(120)]


def prose(n):
    return " ".join(rng.choice(VOCAB[: rng.choice([5, 40, 120])]) for _ in range(n))


ROWS = [(1, "Alpha BETA gamma-delta", "a"), (2, "alpha beta gamma delta", "b"), (3, None, None), (4, "", "a"), (5, " \t\n", "é"),
        (6, prose(20_000), "a"), (7, "É é", None), (8, "alpha", "b"), (8, "alpha", "b"), (None, "alpha null id", "b"), (-9, "alpha", "z"),
        *[(20 + i, prose(rng.choice([1, 3, 30, 200])), rng.choice("aaab")) for i in range(60)]]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in ("size", "target", "n", "runs", "rank", "score", "item_no", "sid", "words", "salt")})


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


# -- 11 -----------------------------------------------------------------------
def brute_search(rows, items, k):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

    def cut(t):
        return term.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    bags = [(i, collections.Counter(w), len(w)) for i, w in ((r[0], cut(r[1])) for r in rows) if w]
    n_docs, n_words = len(bags), sum(n for _, _, n in bags)
    df = collections.Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in set(items):
        want = collections.Counter(cut(text))
        scores = []
        for i, b, n in bags:
            m = 75 + 25 * n * n_docs // n_words
            s = sum(c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 12 * m))
                    for t, c in want.items() if t in b)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k], 1)]
    return collections.Counter(out)


ITEMS = [(0, "alpha beta"), (1, prose(40)), (2, "w1 w1 W1 alpha É"), (3, None), (4, "nothing-here"), (5, "alpha"), (5, "alpha"), (5, "delta"), (None, "beta")]


@pytest.mark.parametrize("segment_chars, block_chars, k", [(6_000_000, 20_000_000, 20), (2_000, 60, 3), (1, 100, 2)])
def test_search_equals_brute_force(spark, docs, segment_chars, block_chars, k):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    out = ranked_search.search(docs, items, k, segment_chars=segment_chars, block_chars=block_chars).collect()
    assert collections.Counter(map(tuple, out)) == brute_search(ROWS, ITEMS, k)


def test_search_of_nothing(spark, docs, none):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked_search.search(none, items).count() == 0
    assert ranked_search.search(docs, items.limit(0)).count() == 0
    assert ranked_search.search(docs, items.where("item_id = 3")).count() == 0


def test_search_skips_but_loses_nothing():
    """Segments of many documents: what is skipped could not have ranked."""
    r = np.random.default_rng(1)
    ids = ranked_search.pa.array(range(5000))
    found = []
    for _ in range(5000):
        t = np.unique(np.minimum(r.zipf(1.3, 30), 50) - 1)
        found.append((t.astype(np.int64), r.integers(1, 5, len(t))))
    row = ranked_search._segment(ids, [100] * 5000, found, 50)
    weight = (1000 * np.log(10002 / (2 * np.bincount(np.concatenate([t for t, _ in found]), minlength=50) + 1))).astype(np.int64)
    seg = ranked_search.Segment(row["payload"], weight, 5000, 500_000)
    for item in ({0: 1, 1: 2, 40: 1}, {49: 1}, {t: 1 for t in range(50)}, {1: 1, 2: 1}):
        all_scores = np.zeros(5000, np.int64)
        for d, s in seg.lists(item):
            all_scores[d] += s
        want = sorted((-int(s), False, i) for i, s in enumerate(all_scores) if s > 0)[:20]
        assert ranked_search.search_segment(seg, item, [], 20) == want


# -- 12 -----------------------------------------------------------------------
def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    capped, left = {}, set(names)
    while True:
        rest = share * sum(sizes.values()) - sum(capped.values())
        now = {s: rest * w[s] / sum(w[x] for x in left) for s in left} if left else {}
        over = {s for s in left if now[s] > most * sizes[s]}
        if not over:
            return capped | now
        capped |= {s: most * sizes[s] for s in over}
        left -= over


def check_mix(rows, out):
    size = {}
    for r in out:
        size.setdefault(r.source, []).append(r)
    total = {s: sum(r.size for r in rs) for s, rs in size.items()}
    want = brute_targets(total)
    for s, rs in size.items():
        assert all(r.source_size == total[s] and math.isclose(r.target, want[s], rel_tol=1e-9, abs_tol=1e-9) for r in rs)
        assert all(0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size for r in rs)
        taken = sum(r.taken for r in rs)
        assert taken <= want[s] + 1e-6
        # whatever could still be taken does not fit
        spare = [r.size for r in rs if r.size > 0 and r.copies < 2]
        assert not spare or want[s] - taken < sorted(spare)[-1] + 1
        # rates solve the dual: one tilt per source
        if 0 < want[s] < 2 * total[s]:
            assert math.isclose(sum(r.rate * r.size for r in rs), want[s], rel_tol=1e-4, abs_tol=1e-3 * len(rs))
            tilts = [math.log(r.rate) / r.size for r in rs if r.size > 0 and 1e-3 < r.rate < 2]
            assert not tilts or max(tilts) - min(tilts) < 1e-3


def test_mix(docs, none):
    out = source_mixing.mix(docs).collect()
    assert len(out) == len(ROWS)
    assert collections.Counter((r.doc_id, r.size) for r in out) == collections.Counter((i, len((t or "").split())) for i, t, _ in ROWS)
    check_mix(ROWS, out)
    again = source_mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, again))
    assert source_mixing.mix(none).count() == 0
    assert [r.taken for r in source_mixing.mix(docs.where("text is null or doc_id = 4")).collect()] == [0, 0]


def test_mix_comes_near_its_targets(spark):
    r = random.Random(4)
    rows = [(i, " ".join("x" * int(1 + r.paretovariate(0.7) % 3000)), f"s{i % 7}") for i in range(2000)]
    out = source_mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    check_mix(rows, out)
    for s in {r.source for r in out}:
        mine = [r for r in out if r.source == s]
        assert mine[0].target - sum(r.taken for r in mine) <= max(20, 0.005 * mine[0].target)


# -- 13 -----------------------------------------------------------------------
def brute_runs(w, least=12):
    got = {}
    for q in range(1, len(w) // 2 + 1):
        begin = None
        for x in range(len(w) - q + 1):
            same = x < len(w) - q and w[x] == w[x + q]
            if same and begin is None:
                begin = x
            if not same and begin is not None:
                length = x - begin + q
                if length >= max(least, 2 * q):
                    got.setdefault((begin, length), q)
                begin = None
    return sorted((s, n, q) for (s, n), q in got.items())


def brute_collapse(w, found):
    gone = {x for s, n, q in found for x in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def shapes():
    r = random.Random(2)
    f, g = ["a"], ["a", "b"]
    while len(g) < 400:
        f, g = g, g + f
    yield g  # Fibonacci word: many overlapping runs
    yield ["x"] * 300
    yield (["a", "b"] * 20 + ["a", "a"]) * 6
    yield list("abcabcabcabcabd" * 9)
    base = [f"w{r.randrange(4)}" for _ in range(600)]
    yield base
    for n in (0, 1, 11, 12, 13, 40, 500):
        for k in (1, 2, 40):
            yield [f"v{r.randrange(k)}" for _ in range(n)]
    for n, p in ((500, 100), (900, 7), (700, 349), (24, 12), (23, 12)):
        unit = [f"u{r.randrange(30)}" for _ in range(p)]
        w = [unit[i % p] for i in range(n)]
        yield w
        yield ["head"] * 3 + w + base[:50]


def test_runs_equal_brute_force():
    words = list(shapes())
    words.insert(5, words[4])  # copies next to each other
    texts = [" ".join(w) for w in words]
    for least in (12, 4):
        got = list(periodic_runs._batch(list(range(len(words))), texts, least))
        for (i, n, found, kept), w in zip(got, words):
            want = brute_runs(w, least)
            assert n == len(w) and found == [list(x) for x in want], i
            assert kept == brute_collapse(w, want)


def test_cover_has_all_differences():
    for r in (0, 1, 3, 8):
        v, inside, wait = periodic_runs.cover(r)
        assert inside.sum() <= 6 * r + 4 and wait.min() >= 0
        for d in range(v):
            x = np.arange(v)
            assert inside[(x + wait[d]) % v].all() and inside[(x + d + wait[d]) % v].all()


def test_extensions_equal_comparison():
    r = np.random.default_rng(3)
    for words in (np.tile(r.integers(0, 3, 90), 9), r.integers(0, 2, 800), np.zeros(700, np.int64)):
        words = np.concatenate((words, [99])).astype(np.int64)
        ext = periodic_runs.Extensions(words)
        i = r.integers(0, len(words) - 1, 400)
        j = np.minimum(i + r.integers(1, 300, 400), len(words) - 1)
        i, j = i[i < j], j[i < j]
        right, left = ext.both(i, j)
        for a, b, x, y in zip(i.tolist(), j.tolist(), right.tolist(), left.tolist()):
            n = 0
            while b + n < len(words) and words[a + n] == words[b + n]:
                n += 1
            m = 0
            while a - m > 0 and words[a - m - 1] == words[b - m - 1]:
                m += 1
            assert (x, y) == (n, m)


def test_runs_query(spark):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in rows if len(r.text or "") < 6000] + [(None, "a b a b a b a b a b a b"), (30, None), (30, ""), (-4, "x " * 40)]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, runs string, n_words int")
    out = periodic_runs.digest(periodic_runs.find_runs(docs.withColumn("text", periodic_runs.planted_text()))).collect()
    want = []
    for i, t in rows:
        w = (t or "").encode().split()
        w = [x.decode() for x in w]
        h = zlib.crc32(("" if i is None else str(i)).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[x] if x < a else w[a + (x - a) % p] for x in range(n)]
        found = brute_runs(w)
        top = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None,) * 3
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        want.append((i, len(found), *top, 1000 * top[1] // top[2] if found else None, hashlib.sha256(lines.encode()).hexdigest(),
                     hashlib.sha256(brute_collapse(w, found).encode()).hexdigest()))
    assert collections.Counter(map(tuple, out)) == collections.Counter(want)
    assert sum(r.n_runs for r in out) > 0
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0


def test_long_text_of_one_word():
    (_, n, found, kept), = periodic_runs._batch([1], ["x " * 60_000], 12)
    assert n == 60_000 and found == [[0, 60_000, 1]] and kept == "x"


def test_queries_are_registered():
    assert {"op11_ranked_search", "op12_source_mixing", "op13_periodic_runs"} <= set(queries.QUERIES)
