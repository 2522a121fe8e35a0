"""Operator 12: mixing sources to target weights by entropy balancing.

Every document gets a rate, the expected number of its copies. Of all rates
between 0 and ``most`` whose words add up to the target of each source, those
nearest to one copy each in relative entropy are tilted exponentials,
min(most, exp(tilt * size / mean size)), with one tilt per source: the
solution of a convex dual. Newton steps on the logarithm of a source's words,
held between two bounds, find all tilts together; a step is one aggregate
over (source, size, number of documents) and a join with the small table of
tilts, so nothing of a source meets in one task.

Targets: sources share ``share`` times all sizes by weight; none gets more
than ``most`` times its size, the rest is shared anew by weight. That is one
level for all sources (target = min(most * size, level * weight)).

Rounding: a document has floor(rate) copies, and one more if it is among the
first of its source in the order of draw / (draw + fraction); the last place
is where the source's words reach its target. What is then left goes to the
next ones that are small enough, and after these, for sources of few
documents, to any small enough that have fewer than ``most`` copies. Places
are found by counting words per 16 bits of the order, three times.

Sums are whole numbers of 2^-20 words, so reruns agree to the last bit.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiver.llm.common import SPACES, materialize, text_of
from quiver.session import tune

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2
UNIT, TOLERANCE, MAX_STEPS = 1 << 20, 1e-7, 100
#: Bits of the order of rounding: three digits of 16.
DIGIT, DIGITS = 16, 3
#: Rounds in which a source is filled up to its target.
FILLS = 4


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``sources`` (source, words, ...) with sid, weight and target. The ranks and the level need one order of
    all sources, rows of one number each; documents are not touched."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    s = sources.select("*", F.row_number().over(by_name).alias("sid"), weight.cast("double").alias("weight"))
    s = s.withColumn("cap", (F.col("words") * most).cast("double"))
    up = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    everything, before = Window.partitionBy(), up.rowsBetween(Window.unboundedPreceding, -1)
    rest = (F.sum("words").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    # the level rises while the sources below it are set to their caps, then falls
    s = s.withColumn("level", rest / left)
    s = s.withColumn("level", F.max("level").over(everything))
    return s.withColumn("target", F.least("cap", F.col("level") * F.col("weight"))).drop("level")


def solve_tilts(sizes: DataFrame, sources: DataFrame, most: int = MOST) -> DataFrame:
    """(sid, scale, tilt) of the sources whose target is between 0 and their cap. ``sizes``: (sid, size, n)."""
    least = sizes.groupBy("sid").agg(F.min("size").alias("low"), F.sum("n").alias("docs"))
    start = sources.where("target > 0 AND target < cap").join(least, "sid")
    more = F.col("target") > F.col("words")
    state = start.select(
        "sid", "target", (F.col("words") / F.col("docs")).alias("scale"), F.lit(0.0).alias("tilt"), F.col("low").alias("least"),
        (F.col("target") == F.col("words")).alias("done"), more.alias("more"))
    state = state.select("sid", "target", "scale", "tilt", "done", F.when(F.col("more"), 0.0).otherwise(-1e9).alias("lo"),
                         F.when(F.col("more"), math.log(most) * F.col("scale") / F.col("least")).otherwise(0.0).alias("hi"))
    state = materialize(state, "tilts")
    x = F.col("size") / F.col("scale")
    raw = F.exp(F.col("tilt") * x)
    rate = F.least(raw, F.lit(float(most)))

    def total(c: Column) -> Column:
        return F.sum(F.floor(c * UNIT).cast("decimal(25,0)") * F.col("n").cast("decimal(13,0)")).cast("double") / UNIT

    for _ in range(MAX_STEPS):
        if state.where("NOT done").isEmpty():
            break
        sums = sizes.join(state.where("NOT done").select("sid", "tilt", "scale"), "sid").groupBy("sid").agg(
            total(F.col("size") * rate).alias("got"),
            total(F.when(raw < most, F.col("size") * x * raw).otherwise(0.0)).alias("rise"))
        s = state.join(sums, "sid", "left")
        got = F.greatest("got", F.lit(1.0 / UNIT))
        step = F.col("tilt") - F.try_divide(F.ln(got / F.col("target")) * got, "rise")
        lo = F.when(got < F.col("target"), F.col("tilt")).otherwise(F.col("lo"))
        hi = F.when(got < F.col("target"), F.col("hi")).otherwise(F.col("tilt"))
        good = F.abs(got - F.col("target")) <= F.col("target") * TOLERANCE
        s = s.withColumns({"step": step, "lo_": lo, "hi_": hi, "good": good})
        inside = (F.col("step") > F.col("lo_")) & (F.col("step") < F.col("hi_"))
        moved = F.when(inside, F.col("step")).otherwise((F.col("lo_") + F.col("hi_")) / 2)
        old = F.col("done")
        state = materialize(s.select(
            "sid", "target", "scale", F.when(old | F.col("good"), F.col("tilt")).otherwise(moved).alias("tilt"),
            (old | F.col("good")).alias("done"), F.when(old, F.col("lo")).otherwise(F.col("lo_")).alias("lo"),
            F.when(old, F.col("hi")).otherwise(F.col("hi_")).alias("hi")), "tilts")
    else:
        raise RuntimeError(f"tilts did not settle in {MAX_STEPS} steps")
    return state.select("sid", "scale", "tilt")


def _prefix(rows: DataFrame, room: DataFrame) -> DataFrame:
    """(sid, place, left): the first place in the order ``key`` whose words, with
    all before it, exceed the ``room`` of the source, and what is then left.
    ``rows``: (sid, key, size). Sources whose rows all fit get a place behind all."""
    state = room.select("sid", F.col("room").cast("bigint").alias("left"), F.lit(0).cast("bigint").alias("head"), F.lit(False).alias("fits"))
    cum = Window.partitionBy("sid").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    for d in range(DIGITS - 1, -1, -1):
        shift = DIGIT * d
        here = rows.join(state.where("NOT fits").select("sid", "head"), "sid").where(
            F.shiftright("key", shift + DIGIT) == F.col("head"))
        bins = here.groupBy("sid", F.shiftright("key", shift).alias("bin")).agg(F.sum("size").alias("own"))
        run = bins.withColumn("upto", F.sum("own").over(cum)).join(state.select("sid", "left"), "sid")
        over = run.groupBy("sid").agg(F.min(F.when(F.col("upto") > F.col("left"), F.col("bin"))).alias("bin"),
                                      F.max(F.when(F.col("upto") <= F.col("left"), F.col("upto"))).alias("used"))
        s = state.join(over, "sid", "left")
        fits = F.col("fits") | F.col("bin").isNull()
        state = materialize(s.select("sid", (F.col("left") - F.coalesce("used", F.lit(0))).alias("left"),
                                     F.coalesce("bin", F.lit(0)).cast("bigint").alias("head"), fits.alias("fits")), "mix-places")
    return state.select("sid", F.when(F.col("fits"), F.lit(1 << (DIGIT * DIGITS)).cast("bigint")).otherwise(F.col("head")).alias("place"), "left")


def _copies(fills: int, most: int) -> Column:
    """Copies after so many fills; needs the columns of ``places``. The first
    two fills go by the draw among those with a fraction, the others by the plain draw among all."""
    copies = F.col("low")
    for k in range(fills):
        fits = F.col("size") <= F.col(f"left{k - 1}") if k else F.lit(True)
        copies = copies + (_open(copies, k, most) & fits & (_key(k) < F.col(f"place{k}"))).cast("bigint")
    return copies


def _open(copies: Column, k: int, most: int) -> Column:
    return F.col("open") & (copies == F.col("low")) if k < 2 else (F.col("size") > 0) & (copies < most)


def _key(k: int) -> Column:
    return F.col("key") if k < 2 else F.col("plain")


def round_rates(rated: DataFrame, sources: DataFrame, most: int = MOST) -> DataFrame:
    """``rated`` (sid, size, rate, draw in (0, 1), ...) with copies."""
    part, wide = F.col("rate") - F.floor("rate"), 1 << (DIGIT * DIGITS)
    key = F.least(F.floor(F.col("draw") / (F.col("draw") + part) * wide), F.lit(wide - 1)).cast("bigint")
    rows = rated.withColumns({"low": F.floor("rate"), "open": (part > 0) & (F.col("size") > 0), "key": key,
                              "plain": F.floor(F.col("draw") * wide).cast("bigint")})
    rows = materialize(rows, "mix-rates")
    sure = rows.groupBy("sid").agg(F.sum(F.col("low") * F.col("size")).alias("sure"))
    places = sources.join(sure, "sid").select("sid", F.greatest(F.floor("target") - F.col("sure"), F.lit(0)).alias("room"))
    places = materialize(places, "mix-room")
    for k in range(FILLS):
        room = F.col(f"left{k - 1}") if k else F.col("room")
        fits = F.col("size") <= room if k else F.lit(True)
        candidates = rows.join(places, "sid").where(_open(_copies(k, most), k, most) & fits).select("sid", _key(k).alias("key"), "size")
        found = _prefix(candidates, places.select("sid", room.alias("room")))
        found = found.select("sid", F.col("place").alias(f"place{k}"), F.col("left").alias(f"left{k}"))
        places = materialize(places.join(found, "sid"), "mix-room")
    return rows.join(places, "sid").withColumn("copies", _copies(FILLS, most))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, salt: str = "mix",
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, size, source_size, target, taken, rate, copies, source): one row per input row.

    Sizes are words between ASCII white space; null, empty and word-less
    texts have size 0 and take nothing. A null source is a source, the last
    in order. ``taken`` is size * copies and never above ``most`` times the
    size; a source's sum is at most its target and, unless documents are so
    few or so alike in size that no other choice fits, within a few words of
    it. The draw hangs on the id and the text, so rows equal in both are
    taken alike, and a null id is no special case. Extra columns are ignored;
    empty input gives no rows.
    """
    tune(docs.sparkSession)
    text = F.btrim(text_of(text_col), F.lit(SPACES))
    words = F.when(text == "", F.lit(0)).otherwise(F.regexp_count(text, F.lit(r"[ \t\n\x0B\f\r]+")) + 1)
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(salt), F.coalesce(F.col(id_col).cast("string"), F.lit("")),
                                                F.md5(text_of(text_col)))), 1, 10), 16, 10).cast("bigint")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       words.cast("bigint").alias("size"), ((draw + F.lit(0.5)) / (1 << 40)).alias("draw"))
    rows = materialize(rows, "mix-documents")
    sizes = materialize(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    sources = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    sources = materialize(source_targets(sources, weights, share, most), "mix-sources")
    sized = sizes.where("size > 0").withColumnRenamed("source", "name").join(
        sources.select("source", "sid"), F.col("name").eqNullSafe(F.col("source"))).select("sid", "size", "n")
    tilts = solve_tilts(materialize(sized, "mix-sizes"), sources, most)
    known = materialize(sources.join(tilts, "sid", "left"), "mix-sources").withColumnRenamed("source", "name")
    rate = F.when(F.col("tilt").isNull() & (F.col("target") > 0), F.lit(float(most))).otherwise(
        F.coalesce(F.least(F.exp(F.col("tilt") * (F.col("size") / F.col("scale"))), F.lit(float(most))), F.lit(0.0)))
    rated = rows.join(known, F.col("source").eqNullSafe(F.col("name"))).select(
        "doc_id", "source", "size", "draw", "sid", F.col("words").alias("source_size"), "target", rate.alias("rate"))
    out = round_rates(rated, sources, most)
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
                      F.round("rate", 6).alias("rate"), "copies", "source")
