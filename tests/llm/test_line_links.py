"""Line dedup: links of many lines that share tokens, against all pairs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quiver.llm import linededup


def groups(lines):
    """Smallest line number of each line's component over all alike pairs."""
    up = list(range(len(lines)))

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    words = [x.split() for x in lines]
    for i, x in enumerate(words):
        for j in range(i):
            y = words[j]
            if len(x) == len(y) and x[:3] == y[:3] and sum(a == b for a, b in zip(x, y)) >= 0.7 * len(x) - 1e-9:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(lines))]


def dropped(spark, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    return [r.n_dropped for r in linededup.drop_lines(df, dropped_col="n_dropped").orderBy("doc_id").collect()]


def star(r, n=300, size=20):
    """A centre and variants that are like it, but seldom like each other."""
    centre = [f"c{chr(97 + i)}" for i in range(size)]
    out = [centre]
    for k in range(n - 1):
        own = list(centre)
        for i in r.sample(range(3, size), 6):
            own[i] = f"v{chr(97 + k % 26)}{chr(97 + k // 26)}{chr(97 + i)}"
        out.append(own)
    r.shuffle(out)
    return out


def chain(r, n=300, size=20):
    """Each line differs from the one before in four places; far ones share little."""
    out = [["h", "h", "h"] + [r.choice("abcdefgh") for _ in range(size - 3)]]
    while len(out) < n:
        own = list(out[-1])
        for i in r.sample(range(3, size), 4):
            own[i] = r.choice("abcdefgh")
        out.append(own)
    r.shuffle(out)
    return out


def bridge(r, size=20):
    """Two dense groups and one line that is like members of both."""
    left, right = ([f"{s}{chr(97 + i)}" for i in range(size)] for s in "lr")
    right[:9] = left[:9]
    right[9:13] = left[9:13]
    out = []
    for base in (left, right):
        for k in range(150):
            own = list(base)
            own[3 + k % 6] = f"x{base[0][0]}{chr(97 + k % 26)}{chr(97 + k // 26)}"
            out.append(own)
    out.append(left[:17] + right[17:])
    r.shuffle(out)
    return out


def unlike(r, n, words="pqrstuvw"):
    return [["t", "t", "t"] + [r.choice(words) for _ in range(10)] for _ in range(n)]


@pytest.mark.parametrize("shape", [star, chain, bridge, lambda r: unlike(r, 300)], ids=["star", "chain", "bridge", "unlike"])
def test_links_equal_all_pairs(spark, shape):
    lines = [" ".join(x) for x in shape(random.Random(3))]
    group = groups(lines)
    first = {}
    for i, g in enumerate(group):
        first.setdefault(g, i)
    assert dropped(spark, lines) == [int(first[g] != i) for i, g in enumerate(group)]


def test_rows_grow_with_the_lines(spark, monkeypatch):
    """Pairs that are compared and keys that are made, for twice as many unlike lines."""
    def rows(n):
        seen = []
        whole, keys = linededup._alike, linededup._level_keys

        def alike(pairs, items):
            seen.append(pairs.count())
            return whole(pairs, items)

        def level_keys(lines, level):
            out = keys(lines, level)
            seen.append(out.count())
            return out

        with monkeypatch.context() as m:
            m.setattr(linededup, "_alike", alike)
            m.setattr(linededup, "_level_keys", level_keys)
            dropped(spark, [" ".join(x) for x in unlike(random.Random(5), n)])
        return sum(seen)

    few, many = rows(400), rows(1600)
    assert many < 8 * few  # all pairs would be 16 times as many


def test_level_keys_meet_where_lines_are_alike(spark):
    """Alike lines share a key at each level up to the tokens they need."""
    r = random.Random(1)
    rows = []
    for k in range(40):
        rows.append((1, k, k, 5, sorted(r.sample(range(12), 8))))
    df = spark.createDataFrame(rows, "leaf long, line long, comp long, need int, items array<long>")
    for level in (2, 3, 5):
        keys = linededup._level_keys(df, level)
        per = {}
        for x in keys.collect():
            per.setdefault(x.key, set()).add(x.line)
            assert x.full == (level == 5)
        assert df.select(F.sum(linededup._n_keys(level))).first()[0] == keys.count()
        met = {(a, b) for s in per.values() for a in s for b in s if a < b}
        need = {(i, j) for i in range(40) for j in range(i + 1, 40) if len(set(rows[i][4]) & set(rows[j][4])) >= 5}
        assert need <= met and (level < 5 or need == met)
