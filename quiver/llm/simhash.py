"""Operator 4: SimHash near-duplicates by pivot distance tables.

Fingerprints are computed per document; everything after works on *distinct*
fingerprints. Candidate pairs come from blocks: 64 bits are cut into six
blocks, and two fingerprints that differ in at most three bits agree on at
least three whole blocks, so joining on each of the 20 triples of blocks
misses no pair. (Pivot coordinates alone cannot propose pairs without
comparing everything: distances to a random reference are concentrated
around 32, and a band of +-3 holds more than half of the table.) Each
fingerprint carries its precomputed Hamming distances to eight reference
fingerprints; pairs whose largest coordinate difference exceeds the limit are
discarded (triangle inequality), and survivors are verified bit by bit.

Buckets with more than ``hot_bucket`` distinct fingerprints are not paired.
Their members meet at *neighbours*: a fingerprint emits every z within one
bit (as a centre) and within two bits (as a member); x and y differ in at most three bits
exactly when some z is within one of x and two of y. Linking all of z's
members to one of its centres needs rows linear in the bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import SEED, connected_components, materialize, text_of
from quiver.session import tune

CUTS = (0, 11, 22, 32, 43, 54, 64)
MAX_BITS = 3


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


#: Reference fingerprints, by the multiplicative (golden ratio) sequence.
PIVOTS = tuple(_signed((i * 0x9E3779B97F4A7C15) % (1 << 64)) for i in range(1, 9))


def fingerprint(text: str | None, k: int = 3) -> int:
    """Signed 64-bit SimHash over k-word shingles, repeats included; a bit is
    1 if set in over half of the shingle hashes. No words: 0."""
    import xxhash

    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    grams = [b" ".join(w)] if len(w) < k else list(map(b" ".join, zip(*(w[i:] for i in range(k)))))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(g, SEED) for g in grams), np.uint64, len(grams))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 100_000):  # bounded for very long texts
        ones += np.unpackbits(h[i:i + 100_000].astype(">u8").view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(grams)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, k: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long), one row per input row."""
    kept = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            fp = pa.array([fingerprint(t.as_py(), k) for t in b.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fp], names=["doc_id", "fp"])

    kind = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(batches, f"doc_id {kind}, fp bigint")


def _masks() -> list[int]:
    block = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(CUTS, CUTS[1:])]
    return [_signed(block[i] | block[j] | block[k]) for i, j, k in combinations(range(6), 3)]


def _coordinate(d: Column, i: int) -> Column:
    return F.shiftrightunsigned(d, 8 * i).bitwiseAND(F.lit(0xFF))


def links(distinct: DataFrame, max_bits: int = MAX_BITS, hot_bucket: int = 1000) -> DataFrame:
    """Edges (a, b) between fingerprints; their components are those of the
    graph 'at most ``max_bits`` (up to 3) bits differ'. ``distinct``: fp."""
    if not 0 <= max_bits <= 3:
        raise ValueError("six blocks serve up to 3 differing bits")
    fp = F.col("fp")
    packed = F.lit(0).cast("bigint")
    for i, p in enumerate(PIVOTS):
        packed = packed.bitwiseOR(F.shiftleft(F.bit_count(fp.bitwiseXOR(F.lit(p))).cast("bigint"), 8 * i))
    pivots = distinct.select("fp", packed.alias("d"))
    bands = pivots.select("fp", "d", F.posexplode(F.array(
        *[fp.bitwiseAND(F.lit(m)) for m in _masks()])).alias("t", "key"))
    hot = materialize(bands.groupBy("t", "key").agg(
        F.count(F.lit(1)).alias("n"), F.bit_or("fp").alias("o"), F.bit_and("fp").alias("a"))
        .where(F.col("n") > hot_bucket).select("t", "key", F.col("o").bitwiseXOR(F.col("a")).alias("vary")), "hot-buckets")
    some_hot = not hot.isEmpty()
    cold = bands.join(hot.select("t", "key"), ["t", "key"], "left_anti") if some_hot else bands
    x, y = cold.alias("x"), cold.alias("y")
    far = F.greatest(*[F.abs(_coordinate(F.col("x.d"), i) - _coordinate(F.col("y.d"), i)) for i in range(len(PIVOTS))])
    pairs = (x.join(y, (F.col("x.t") == F.col("y.t")) & (F.col("x.key") == F.col("y.key"))
                    & (F.col("x.fp") < F.col("y.fp")) & (far <= max_bits)
                    & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= max_bits))
             .select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")))
    if some_hot:
        pairs = pairs.union(_through_neighbours(bands.join(hot, ["t", "key"]), max_bits))
    return pairs


def _through_neighbours(members: DataFrame, max_bits: int) -> DataFrame:
    """Edges of the hot buckets (t, key, fp, vary): see the module's text.
    Only bits that vary within the bucket are flipped. Centres are within
    ``max_bits // 2`` bits of z, members within the rest."""
    near, wide = max_bits // 2, max_bits - max_bits // 2
    bits = F.filter(F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("shiftleft", F.lit(1).cast("bigint"), i)),
                    lambda b: F.col("vary").bitwiseAND(b) != 0)
    m = members.select("t", "key", "fp", bits.alias("bits"))
    zero = F.array(F.lit(0).cast("bigint"))
    two = F.flatten(F.transform("bits", lambda p: F.transform(F.filter("bits", lambda q: q > p), lambda q: p.bitwiseOR(q))))
    flips = [(0, zero), (1, F.col("bits")), (2, two)]

    def marked(arr: Column, centre: bool) -> Column:
        return F.transform(arr, lambda f: F.struct(f.alias("f"), F.lit(centre).alias("centre")))

    steps = F.concat(*[marked(arr, n <= near) for n, arr in flips if n <= wide])
    z = m.select("t", "key", "fp", F.explode(steps).alias("s")).select(
        "t", "key", F.col("fp").bitwiseXOR(F.col("s.f")).alias("z"), "fp", F.col("s.centre").alias("centre"))
    centre = z.where("centre").groupBy("t", "key", "z").agg(F.min("fp").alias("c"))
    return z.join(centre, ["t", "key", "z"]).where("fp <> c").select(F.col("c").alias("a"), F.col("fp").alias("b"))


def near_duplicates(docs: DataFrame, k: int = 3, max_bits: int = MAX_BITS, hot_bucket: int = 1000,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per input row.

    Null and word-less texts have fingerprint zero and link like any other. component_id is
    the smallest doc_id reachable over links of at most ``max_bits`` bits,
    the row's own included; a null doc_id is never the smallest while another
    is there. Repeated rows share fingerprint and component. Empty input
    gives an empty result. Extra columns are ignored.
    """
    tune(docs.sparkSession)
    fps = materialize(fingerprints(docs, k, id_col, text_col), "simhash")
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    comp = connected_components(links(distinct.select("fp"), max_bits, hot_bucket))
    comp = comp.select(F.col("node").alias("fp"), F.col("component").alias("c"))
    named = distinct.join(comp, "fp", "left").withColumn("c", F.coalesce("c", "fp"))
    named = named.join(named.groupBy("c").agg(F.min("low").alias("component_id")), "c").select("fp", "component_id")
    return fps.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, k: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents with the smallest doc_id of their group (rows that repeat
    that doc_id stay with it; a null doc_id stays only in a group without any other)."""
    groups = near_duplicates(docs, k, max_bits)
    stay = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("stay_id")).distinct()
    d = docs.alias("d")
    return d.join(stay.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.stay_id")), "left_semi").select(*[F.col(f"d.`{c}`") for c in docs.columns])
