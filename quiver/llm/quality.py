"""Operator 1: quality classifier by an interpolated modified Kneser-Ney
trigram model of trusted text.

Every trusted document is used, for one of two things: by a hash of the id, one half is
fitted on, the other half, which the fit has not seen, gives the quantiles.
Per language, n-gram counts, continuation counts, discounts from counts of counts, and
back-off weights of the whole half are grouped aggregations and joins on n-gram hashes.

In back-off form a word's log probability is a sum over the n-grams that end in it:
each known n-gram adds what its own probability gains over backing off, each known context its
back-off weight, the rest nothing. So a document's perplexity is a sum of what its known n-grams have.

N-grams of a whole corpus as rows take many times its room and time. So texts are cut into packed blocks of
records (``ngrams``) that are dealt into buckets by the middle word: what is known of
a triple (u, v, w), of the pair (v, w) and of the context (u, v) depends on no other v, given words' probabilities and
discounts. A first round counts the fitted texts' buckets; Spark joins and sums what is known of words over all
buckets; a second round looks up every document's records in the buckets' tables, a bucket to a task, in up to SLICES slices of the
buckets, one after another, for the room their blocks take on disk. A bucket has about PART_ROWS fitted
words, so a task's memory is bounded; commoner words are cut further by the word before them.

The perplexity of a
few words says little, so a document's mean log probability is first mixed
with ``prior_words`` words at its language's average. A document is rejected when
this smoothed perplexity exceeds its language's quantile over the trusted
documents of the half that the fit has not seen.

Toxic words in normal prose vanish in a document's mean. Word probabilities of the same
kind, from documents labelled toxic, give every word a log-likelihood ratio
toxic to trusted. Words above the language's quantile of the same trusted documents'
largest ratios are suspect; a document is rejected, too, if trusted text of its length
would hold so many of them with a probability below ``toxic_tail`` (Poisson, at the trusted
documents' rate), so a long clean text with a few is kept. The ratio takes the models' lowest order (distinct
predecessors of a word): longer n-grams recognise copied passages, not toxic words.

Nothing is bounded unless the caller asks for it: ``max_docs`` or ``max_chars`` limit the fit to so much
per language (``training_sample``); the queries do not.
"""

from __future__ import annotations

from functools import partial, reduce

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quiver.llm import ngrams
from quiver.llm.common import SPACES, discard, lower_ascii, materialize_lean, space_words, text_of
from quiver.session import tune

#: Bounds of ``training_sample`` for one language.
MAX_DOCS, MAX_CHARS = 400, 600_000
#: A document longer than this share of max_chars stays out of the fit.
MAX_SHARE = 0.25
#: Rejected above this quantile of trusted perplexities, times the margin.
QUANTILE, MARGIN = 0.99, 1.25
#: Words above this quantile of trusted documents' largest toxic ratios are suspect; rejected below this probability of so many.
TOXIC_QUANTILE, TOXIC_TAIL = 0.99, 0.02
#: Words at the language's average that every document's perplexity is mixed with.
PRIOR_WORDS = 16
#: Languages up to which per-language rows are broadcast.
BROADCAST_LANGS = 10_000
#: Labelled or flagged documents up to which their ids are broadcast.
BROADCAST_IDS = 1_000_000
#: Rows of other tables up to which they are broadcast.
BROADCAST_ROWS = 2_000_000
#: Hash that stands for the start of a text.
START = 0
#: Fitted words of a bucket; a word with over half as many is cut into parts.
PART_ROWS = 1_500_000
#: Fitted words of a bucket at least, where more buckets would only serve more tasks.
LEAST_WORDS = 50_000
#: Slices of the buckets that documents are looked up in, one after another: more take less disk and more time.
SLICES = 3
#: Fitted words up to which fewer slices do.
SLICE_WORDS = 7_500_000
#: Size of the filter of known words at most: 64 Kbit times this power of 2.
FILTER_BITS = 12
#: Words at most whose keys all tasks have.
COMMON_WORDS = 1 << 18
#: Bytes and rows of blocks that are handed to Python at once.
BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20), "spark.sql.execution.arrow.maxRecordsPerBatch": "200"}


def _hashed(texts: DataFrame, keep: list[str]) -> DataFrame:
    """keep and w, the array of the hashes of the words of ``text``."""
    text = F.btrim(lower_ascii(F.col("text")), F.lit(SPACES))
    # trimmed, only a text without words has an empty one
    words = F.array_remove(F.split(text, r"[ \t\n\x0B\f\r]+"), "")
    return texts.select(*keep, F.transform(words, lambda x: F.xxhash64(x)).alias("w"))


def _rows(hashed: DataFrame, keep: list[str]) -> DataFrame:
    """A row for each word of ``w``: keep, u, v, w (hashes of the two words before it and its own), last (no word follows)."""
    start = F.lit(START).cast("bigint")
    n = F.size("w")
    u = F.slice(F.concat(F.array(start, start), F.col("w")), F.lit(1), n)
    v = F.slice(F.concat(F.array(start), F.col("w")), F.lit(1), n)
    last = F.slice(F.concat(F.array_repeat(F.lit(False), n - 1), F.array(F.lit(True))), F.lit(1), n)
    return hashed.select(*keep, F.inline(F.arrays_zip(u.alias("u"), v.alias("v"), F.col("w"), last.alias("last"))))


def fit_half(doc_id: Column) -> Column:
    """Trusted documents of this half are fitted on; the other half, never
    seen by the fit, gives the quantiles."""
    return F.pmod(F.xxhash64(doc_id, F.lit("fit")), F.lit(2)) == 0


def training_sample(trusted: DataFrame, max_docs: int = MAX_DOCS, max_chars: int = MAX_CHARS) -> DataFrame:
    """For callers that bound the fit: ids of at most max_docs whole documents per language, in
    the order of the id's hash, as long as their lengths add up to at most max_chars.

    Documents above MAX_SHARE of max_chars are left out, so one long text
    neither empties nor fills a sample; a language with only such texts
    is fitted on its shortest, whatever its length, rather than not at all."""
    per = W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    half = trusted.where("chars > 0").where(fit_half(F.col("doc_id")))
    most = int(max_chars * MAX_SHARE)
    first = half.where(F.col("chars") <= most).withColumn(
        "r", F.row_number().over(per)).where(F.col("r") <= max_docs)
    short = first.withColumn("sum", F.sum("chars").over(per)).where(F.col("sum") <= max_chars).select("doc_id")
    lone = half.groupBy("lang").agg(F.min(F.struct("chars", "doc_id")).alias("least")).where(
        F.col("least.chars") > most).select(F.col("least.doc_id").alias("doc_id"))
    return short.union(lone).distinct()


def _counts_of_counts(counts: DataFrame, n: int) -> DataFrame:
    """(lang, n, n1, n2, n3, n4): how many n-grams of order n have a count of 1, 2, 3 and 4."""
    return counts.groupBy("lang").agg(*[F.count_if(F.col("c") == i).alias(f"n{i}") for i in (1, 2, 3, 4)]).select(
        "lang", F.lit(n).alias("n"), "n1", "n2", "n3", "n4")


def _discounts(ones: DataFrame) -> DataFrame:
    """(lang, n, d1, d2, d3): discounts of counts 1, 2 and 3 or more of each order n, from counts of counts."""
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

    def discount(k: int) -> Column:
        raw = k - (k + 1) * y * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}"))
        # a sample without such counts of counts: 0.5, 0.75, 1
        return F.least(F.greatest(F.coalesce(raw, F.lit(0.25 + 0.25 * k)), F.lit(0.05)), F.lit(float(k)))

    ones = ones.groupBy("lang", "n").agg(*[F.sum(f"n{i}").cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)])
    return materialize_lean(ones.select("lang", "n", *[discount(k).alias(f"d{k}") for k in (1, 2, 3)]), "kn-discounts")


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    """A written table, marked for broadcast if it has at most ``rows`` rows."""
    return F.broadcast(df) if df.count() <= rows else df


def _discounted(counts: DataFrame, context: list[str], discounts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (lang, context..., w, c): (lang, context..., w, share, gamma) and (lang,
    context..., gamma): discounted probability and the mass left to the lower order."""
    rows = counts.join(discounts, "lang").withColumn(
        "d", F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3")))
    total = rows.groupBy("lang", *context).agg(F.sum("c").alias("total"), F.sum("d").alias("cut"))
    gamma = (F.col("cut") / F.col("total")).alias("gamma")
    share = rows.join(total, ["lang", *context]).select("lang", *context, "w", ((F.col("c") - F.col("d")) / F.col("total")).alias("share"), gamma)
    return share, total.select("lang", *context, gamma)


def _in_python(df: DataFrame, name: str) -> DataFrame:
    """``materialize_lean`` of a plan that hands blocks to Python."""
    conf = df.sparkSession.conf
    before = {k: conf.get(k, None) for k in BATCH}
    for k, v in BATCH.items():
        conf.set(k, v)
    try:
        return materialize_lean(df, name)
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def _dealing(texts: DataFrame) -> DataFrame:
    """How n-grams are dealt: (key, first, parts) of very common words: their parts' numbers; key END: buckets and slices."""
    spark = texts.sparkSession
    often = texts.select("lang", "text").mapInArrow(ngrams.census, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    most = max(1, PART_ROWS // 2)
    n = {r.key: r.n for r in often.where((F.col("n") > most) | (F.col("key") == ngrams.END)).collect()}
    words = n.pop(ngrams.END, 0)
    slices = min(SLICES, 1 + words // SLICE_WORDS)
    each = max(1 + words // (PART_ROWS * slices), min(2 * spark.sparkContext.defaultParallelism, 1 + words // LEAST_WORDS))
    rows, first = [(ngrams.END, slices * each, slices)], 1
    for key in sorted(n):
        rows.append((key, first, 1 + n[key] // most))
        first += rows[-1][2]
    return spark.createDataFrame(rows, "key bigint, first bigint, parts bigint")


def _dealt(dealing: DataFrame) -> tuple[int, int, dict[int, tuple[int, int]]]:
    """(buckets, slices, parts of very common words)."""
    rows = {key: (first, parts) for key, first, parts in dealing.collect()}
    buckets, slices = rows.pop(ngrams.END)
    return buckets, slices, {k % 2 ** 64: x for k, x in rows.items()}


def _counted(texts: DataFrame, dealing: DataFrame, only_words: bool = False) -> DataFrame:
    """``ngrams.COUNTED`` rows of the (lang, text) rows, by bucket."""
    buckets, _, hot = _dealt(dealing)
    blocks = texts.select("lang", "text").mapInArrow(partial(ngrams.fit_blocks, buckets=buckets, hot=hot), "bucket int, lang string, part int, data binary")
    blocks = blocks.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket", "lang", "part")
    return _in_python(blocks.mapInArrow(partial(ngrams.count_buckets, only_words=only_words), ngrams.COUNTED), "kn-counted")


def fit(texts: DataFrame) -> dict[str, DataFrame]:
    """Tables of (lang, text) rows: share (k, p) of every n-gram, mass (k, g) left by
    every context, words (k, p, g, lang) with both of a word, floor (lang, floor, start) of an unseen word and
    the log weights of the contexts before a first word; k hashes the language and one to three words. For
    ``slice_terms``: dealing, counted, d3, d2 (discounts) and p1 (lang, w, share, p1, c; w hashes the language, too)."""
    dealing = _dealing(texts)
    counted = _counted(texts, dealing)
    c1 = materialize_lean(counted.where("kind = 'W'").groupBy("lang", F.col("key").alias("w")).agg(F.sum("n").alias("c")), "kn-words")
    ones = counted.where("kind in ('2', '3')").select("lang", F.col("kind").cast("int").alias("n"), "n1", "n2", "n3", "n4")
    cuts = _discounts(ones.union(_counts_of_counts(c1, 1)))
    d3, d2, d1 = (_bounded(cuts.where(F.col("n") == n).drop("n"), BROADCAST_LANGS) for n in (3, 2, 1))
    # the discounts of a context's counts, from how many are 1, 2 and more
    gamma = (F.col("n1") * F.col("d1") + F.col("n2") * F.col("d2") + (F.col("n") - F.col("n1") - F.col("n2")) * F.col("d3")) / F.col("total")

    def weight(kind: str, cuts: DataFrame) -> DataFrame:
        rows = counted.where(F.col("kind") == kind).select("lang", F.col("key").alias("w"), "total", "n", "n1", "n2")
        return rows.join(cuts, "lang").select("lang", "w", gamma.alias("gamma"))

    g2 = materialize_lean(weight("V", d2), "kn-word-mass")
    first = weight("start", d3).select("lang", F.log("gamma").alias("pair"))
    start = first.join(g2.where(F.col("w") == F.xxhash64("lang", F.lit(START).cast("bigint"))).select("lang", F.log("gamma").alias("word")), "lang").select(
        "lang", (F.col("pair") + F.col("word")).alias("start"))
    s1, g1 = _discounted(c1, [], d1)
    s1 = s1.join(c1, ["lang", "w"])
    v = c1.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    floor = materialize_lean(g1.join(v, "lang").select("lang", (F.col("gamma") / (F.col("v") + 1)).alias("floor")).join(start, "lang"), "kn-floor")
    p1 = materialize_lean(s1.join(_bounded(floor, BROADCAST_LANGS), "lang").select("lang", "w", "share", (F.col("share") + F.col("floor")).alias("p1"), "c"), "kn-word-p")
    words = p1.select("lang", "w", "share").join(g2, ["lang", "w"], "left").select(
        F.col("w").alias("k"), F.col("share").alias("p"), F.coalesce("gamma", F.lit(1.0)).alias("g"), "lang")
    words = materialize_lean(words, "kn-words-model")
    discard(c1, g2)
    # computed when read, in one go
    c3 = _rows(_hashed(texts, ["lang"]), ["lang"]).groupBy("lang", "u", "v", "w").agg(F.count(F.lit(1)).alias("c"))
    s3, g3 = _discounted(c3, ["u", "v"], d3)
    s2, g2 = _discounted(c3.groupBy("lang", "v", "w").agg(F.count(F.lit(1)).alias("c")), ["v"], d2)
    share = [t.select(F.xxhash64("lang", *by, "w").alias("k"), F.col("share").alias("p")) for t, by in ((s3, ["u", "v"]), (s2, ["v"]))]
    mass = [t.select(F.xxhash64("lang", *by).alias("k"), F.col("gamma").alias("g")) for t, by in ((g3, ["u", "v"]), (g2, ["v"]))]
    return {"share": share[0].union(share[1]).union(p1.select("w", "share")), "mass": mass[0].union(mass[1]), "floor": floor, "words": words,
            "dealing": dealing, "counted": counted, "d3": d3, "d2": d2, "p1": p1}


def with_toxic(model: dict[str, DataFrame], texts: DataFrame) -> dict[str, DataFrame]:
    """The model with word probabilities of toxic (lang, text) rows: column t
    in words, toxic_floor in floor (null for a language without such texts)."""
    counted = _counted(texts, model["dealing"], only_words=True)
    c1 = materialize_lean(counted.groupBy("lang", F.col("key").alias("w")).agg(F.sum("n").alias("c")), "toxic-words")
    cuts = _bounded(_discounts(_counts_of_counts(c1, 1)).drop("n"), BROADCAST_LANGS)
    share, mass = _discounted(c1, [], cuts)
    both = model["words"].withColumn("t", F.lit(0.0)).union(
        share.select(F.col("w").alias("k"), F.lit(0.0).alias("p"), F.lit(1.0).alias("g"), "lang", F.col("share").alias("t")))
    v = c1.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    floor = mass.join(v, "lang").select("lang", (F.col("gamma") / (F.col("v") + 1)).alias("toxic_floor"))
    both = both.groupBy("k", "lang").agg(F.sum("p").alias("p"), F.min("g").alias("g"), F.sum("t").alias("t"))  # no weight is above 1
    out = {**model, "words": materialize_lean(both, "kn-words-toxic"),
           "floor": materialize_lean(model["floor"].join(floor, "lang", "left"), "kn-floor-toxic")}
    discard(counted, c1, model["words"])
    return out


def _ratio() -> Column:
    """A word's toxic ratio against that of an unknown word; 1 without toxic texts."""
    return F.coalesce((F.col("t") / F.col("toxic_floor") + 1) / (F.col("p") / F.col("floor") + 1), F.lit(1.0))


def _toxicity(ratio: Column) -> Column:
    """Log-likelihood ratio of toxic to trusted text, from a ``_ratio``."""
    return F.log(ratio) + F.log(F.col("toxic_floor") / F.col("floor"))


def word_filters(model: dict[str, DataFrame]) -> Broadcast:
    """Of the model's words: a filter's bits, never 0 for one of them (``ngrams.known``), and the keys of the commonest."""
    words = model["words"].select("k")
    # eight bits a word; a full filter only excludes fewer words
    power = min(FILTER_BITS, max(1, (8 * words.count() >> ngrams.SEGMENT).bit_length()))
    rows = words.repartition(F.shiftrightunsigned("k", 64 - power)).mapInArrow(
        partial(ngrams.filter_segments, segments=1 << power), "segment int, bits binary")
    size = 1 << ngrams.SEGMENT - 3
    bits = np.zeros(size << power, np.uint8)
    for segment, part in rows.collect():
        bits[segment * size:(segment + 1) * size] = np.frombuffer(part, np.uint8)
    # blocks need no keys of these; as many counts, from the top, as there is room for
    counts = model["p1"].groupBy(F.least("c", F.lit(COMMON_WORDS)).alias("c")).count().orderBy(F.desc("c")).collect()
    least, n = COMMON_WORDS + 1, 0
    for c, rows in counts:
        n += rows
        if n > COMMON_WORDS:
            break
        least = c
    common = model["p1"].where(F.col("c") >= least).select("w", "c").toArrow()
    common = common["w"].to_numpy()[np.argsort(-common["c"].to_numpy(), kind="stable")].astype(np.int64).view(np.uint64)
    return words.sparkSession.sparkContext.broadcast((bits, common))


def slice_terms(docs: DataFrame, model: dict[str, DataFrame], i: int, filters: Broadcast) -> DataFrame:
    """(id, n, terms, ratio) of ``docs`` (id, lang, text) with words from the buckets of slice ``i`` (filters: ``word_filters``): number of words, summed terms and
    the largest of the words' ``_ratio``. Terms are the log of a known triple's or pair's probability against backing off, the log
    weights of contexts of one and two words and the log of a known word's probability against an unknown one's."""
    buckets, slices, hot = _dealt(model["dealing"])
    here = F.pmod("bucket", F.lit(slices)) == i
    counted = model["counted"].where(here)
    nothing = F.lit(0.0)
    p1 = counted.where("kind = 'W'").select("bucket", "lang", F.col("key").alias("w")).join(model["p1"].select("lang", "w", "p1"), ["lang", "w"]).select(
        F.lit(1).alias("kind"), "bucket", "lang", F.col("w").alias("key"), F.col("p1").alias("a"), nothing.alias("b"), nothing.alias("c"))
    words = model["words"].withColumn("bucket", F.pmod("k", F.lit(buckets)).cast("int")).where(here).join(_bounded(model["floor"], BROADCAST_LANGS), "lang").select(
        F.lit(0).alias("kind"), "bucket", "lang", "k", F.log1p(F.col("p") / F.col("floor")), _ratio(), F.log("g"))
    tables = words.toDF(*p1.columns).union(p1).mapInArrow(ngrams.pack_tables, ngrams.LOOKED_UP)
    cuts = model["d2"].join(model["d3"].toDF("lang", "e1", "e2", "e3"), "lang")
    blocks = counted.where("kind in ('C', 'T')").join(_bounded(cuts, BROADCAST_LANGS), "lang")
    tables = tables.union(blocks.select("bucket", "lang", F.when(F.col("kind") == "C", -1).otherwise(F.col("part")), F.when(F.col("kind") == "C", 2).otherwise(3),
                                        F.lit(0).cast("bigint"), "data", "d1", "d2", "d3", "e1", "e2", "e3"))
    texts = docs.select("lang", "text", "id").mapInArrow(partial(ngrams.text_blocks, buckets=buckets, hot=hot, slices=slices, i=i, filters=filters), ngrams.LOOKED_UP)
    dealt = tables.union(texts).repartitionById(buckets // slices, F.floor(F.col("bucket") / slices).cast("int"))
    found = dealt.sortWithinPartitions("bucket", "lang", "part", "kind").mapInArrow(partial(ngrams.look_up, filters=filters), "unit bigint, kind int, data binary")
    sums = found.repartition("unit").sortWithinPartitions("unit", "kind").mapInArrow(ngrams.sum_texts, "id bigint, n bigint, terms double, ratio double")
    # rows that repeat a document have the same
    return _in_python(sums.groupBy("id").agg(F.max("n").alias("n"), F.avg("terms").alias("terms"), F.max("ratio").alias("ratio")), "slice-terms")


def _terms(docs: DataFrame, model: dict[str, DataFrame]) -> DataFrame:
    """``slice_terms`` of all slices, one slice after another."""
    filters = word_filters(model)
    parts = [slice_terms(docs, model, i, filters) for i in range(_dealt(model["dealing"])[1])]
    filters.destroy()
    return reduce(DataFrame.union, parts).groupBy("id").agg(F.max("n").alias("n"), F.sum("terms").alias("terms"), F.max("ratio").alias("ratio"))


def perplexities(docs: DataFrame, model: dict[str, DataFrame]) -> DataFrame:
    """(doc_id, k, lang, n_words, perplexity, toxicity) of ``docs`` (doc_id, k, lang,
    text) with words and a modelled language; the model is ``with_toxic``."""
    floor = _bounded(model["floor"], BROADCAST_LANGS)
    docs = docs.join(floor.select("lang"), "lang", "left_semi").withColumn("id", F.xxhash64("doc_id", "k", "lang"))
    own = docs.select("doc_id", "k", "lang", "id").dropDuplicates(["id"])
    found = own.join(_terms(docs, model), "id").join(floor, "lang")
    mean = (F.col("terms") + F.col("start")) / F.col("n") + F.log("floor")
    return found.select("doc_id", "k", "lang", F.col("n").alias("n_words"), F.exp(-mean).alias("perplexity"), _toxicity(F.col("ratio")).alias("toxicity"))


def suspect_words(docs: DataFrame, flagged: DataFrame, model: dict[str, DataFrame]) -> DataFrame:
    """(doc_id, k, lang, suspects): words of the ``flagged`` documents (doc_id, k, lang,
    toxic_threshold) whose toxic ratio is above the threshold."""
    limits = flagged.select("lang", "toxic_threshold").distinct().join(model["floor"], "lang").withColumn(
        "unknown", _toxicity(F.lit(1.0)) > F.col("toxic_threshold"))
    limits = _bounded(materialize_lean(limits, "toxic-limits"), BROADCAST_LANGS)
    # the words that differ from unknown ones: few, unless unknown words are suspect
    odd = model["words"].join(limits, "lang").where((_toxicity(_ratio()) > F.col("toxic_threshold")) != F.col("unknown")).select(F.col("k").alias("odd"))
    odd = materialize_lean(odd, "odd-words")
    d, f = docs.alias("d"), _bounded(flagged, BROADCAST_IDS).alias("f")
    texts = d.join(f, F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.k") == F.col("f.k")) & (F.col("d.lang") == F.col("f.lang")))
    words = texts.select("d.doc_id", F.col("d.k").alias("text_k"), "d.lang", F.posexplode(space_words(lower_ascii(F.col("d.text")))).alias("at", "w"))
    words = words.withColumn("a1", F.xxhash64("lang", F.xxhash64("w"))).join(_bounded(odd, BROADCAST_ROWS), F.col("a1") == F.col("odd"), "left")
    counts = words.groupBy("doc_id", F.col("text_k").alias("k"), "lang").agg(
        F.count(F.lit(1)).alias("n"), F.count("odd").alias("odd"), F.count_if(F.col("at") == 0).alias("copies"))
    return counts.join(limits, "lang").select(
        "doc_id", "k", "lang", (F.when(F.col("unknown"), F.col("n") - F.col("odd")).otherwise(F.col("odd")) / F.col("copies")).cast("bigint").alias("suspects"))


def poisson_tail(k: Column, mean: Column) -> Column:
    """Probability of k or more; beyond 100, that of 100 or more; null for a null."""
    term = F.struct(F.lit(0.0).alias("sum"), F.exp(-mean).alias("next"))
    below = F.aggregate(F.sequence(F.lit(1), F.least(k, F.lit(100)).cast("int")), term,
                        lambda s, i: F.struct((s["sum"] + s["next"]).alias("sum"), (s["next"] * mean / i).alias("next")))
    return F.when(k <= 0, F.lit(1.0)).when(k.isNotNull() & mean.isNotNull(), F.greatest(F.lit(0.0), 1.0 - below["sum"]))


def judge_quality(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN,
                  max_docs: int | None = None, max_chars: int | None = None, prior_words: float = PRIOR_WORDS,
                  toxic_quantile: float = TOXIC_QUANTILE, toxic_tail: float = TOXIC_TAIL, id_col: str = "doc_id",
                  text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: doc_id, lang, text_hash, n_words, perplexity, smoothed, threshold, toxicity, toxic_threshold, suspects, kept.

    Trusted are documents labelled quality 1 and not toxic; by hash of the
    id, one half is fitted on and the other gives the languages' averages and
    thresholds: ``margin`` times the ``quantile`` of their smoothed perplexities, the
    ``toxic_quantile`` of their toxicities and the rate of suspect words. Documents labelled toxic are halved alike;
    ``max_docs`` and ``max_chars``, if given, bound both fits per language. A
    language without any in the fit half has null toxicities, which reject nothing. Texts without words (null, empty)
    have no perplexity and are rejected. A language without trusted text
    outside the fit (null included) cannot be judged: smoothed perplexity and threshold are null and
    the document is kept. Repeated rows are judged alike; a label holds for every row of its id;
    contradictory labels of one id do not make it trusted. Empty tables give empty or unjudged results;
    extra columns are ignored.
    """
    tune(docs.sparkSession)
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
                    text_of(text_col).alias("text")).withColumn("k", F.xxhash64("text"))
    good = labels.groupBy(F.col("doc_id").alias("label_id")).agg(
        F.min("quality").alias("q"), F.max("toxic").alias("t")).where("q = 1 and coalesce(t, 0) = 0").select("label_id")
    good = materialize_lean(good, "trusted-ids")
    harsh = labels.where("toxic = 1").select(F.col("doc_id").alias("label_id")).distinct()

    def fit_texts(ids: DataFrame) -> DataFrame:
        ids = ids.where(fit_half(F.col("label_id")))
        texts = d.where(fit_half(F.col("doc_id"))).join(_bounded(ids, BROADCAST_IDS), F.col("doc_id") == F.col("label_id"), "left_semi")
        if max_docs is not None or max_chars is not None:
            lengths = materialize_lean(texts.select("doc_id", "lang", F.length(F.btrim("text")).alias("chars")), "fit-lengths")
            few = training_sample(lengths, 2 ** 31 - 1 if max_docs is None else max_docs, 2 ** 62 if max_chars is None else max_chars)
            texts = texts.join(materialize_lean(few, "fit-ids"), "doc_id", "left_semi")
        return texts.select("lang", "text")

    model = with_toxic(fit(fit_texts(good)), fit_texts(materialize_lean(harsh, "toxic-ids")))
    scored = materialize_lean(perplexities(d, model), "perplexities")
    discard(model["counted"], model["p1"])
    unseen = materialize_lean(scored.where(~fit_half(F.col("doc_id"))).join(good, F.col("doc_id") == F.col("label_id"), "left_semi")
                         .select("doc_id", "k", "lang", "n_words", F.log("perplexity").alias("mean"), "toxicity"), "unseen-trusted")
    average = materialize_lean(unseen.groupBy("lang").agg(F.avg("mean").alias("average")), "lang-averages")

    def smoothed(mean: Column) -> Column:
        return F.exp((F.col("n_words") * mean + prior_words * F.col("average")) / (F.col("n_words") + prior_words))

    limit = (unseen.join(_bounded(average, BROADCAST_LANGS), "lang").groupBy("lang", "average")
             .agg((F.percentile_approx(smoothed(F.col("mean")), quantile, 100_000) * margin).alias("threshold"),
                  F.percentile_approx("toxicity", toxic_quantile, 100_000).alias("toxic_threshold")))
    limit = _bounded(materialize_lean(limit, "lang-thresholds"), BROADCAST_LANGS)
    flagged = scored.join(limit, "lang").where("toxicity > toxic_threshold").select("doc_id", "k", "lang", "toxic_threshold")
    flagged = materialize_lean(flagged, "flagged")
    suspects = materialize_lean(suspect_words(d, flagged, model), "suspect-words")
    discard(model["words"])
    # suspect words of the unseen trusted documents and one more, over all their words
    seen = unseen.join(suspects, ["doc_id", "k", "lang"], "left").groupBy("lang").agg(
        ((F.coalesce(F.sum("suspects"), F.lit(0)) + 1) / F.sum("n_words")).alias("rate"))
    limit = _bounded(materialize_lean(limit.join(seen, "lang"), "lang-limits"), BROADCAST_LANGS)
    scored = scored.alias("s").join(suspects.alias("t"), F.col("s.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("s.k") == F.col("t.k"))
                                    & (F.col("s.lang") == F.col("t.lang")), "left").select("s.*", "t.suspects")
    x = d.select("doc_id", "lang", "k", F.btrim("text", F.lit(" \t\n\x0b\f\r")) .alias("t")).select(
        "doc_id", "lang", "k", (F.col("t") != "").alias("has_words")).alias("x")
    y = scored.select("doc_id", "lang", "k", "n_words", "perplexity", "toxicity", "suspects").alias("y")
    joined = x.join(y, F.col("x.doc_id").eqNullSafe(F.col("y.doc_id")) & (F.col("x.k") == F.col("y.k"))
                    & (F.col("x.lang") == F.col("y.lang")), "left").join(limit.alias("z"), F.col("x.lang") == F.col("z.lang"), "left")
    judged = joined.select(
        F.col("x.doc_id").alias("doc_id"), F.col("x.lang").alias("lang"), F.col("x.k").alias("text_hash"),
        "n_words", "perplexity", smoothed(F.log("perplexity")).alias("smoothed"), "threshold", "toxicity", "toxic_threshold",
        F.when(F.col("toxicity").isNotNull(), F.coalesce("suspects", F.lit(0))).alias("suspects"), "rate", "has_words")
    return judged.withColumn("kept", F.col("has_words") & F.coalesce(F.col("smoothed") <= F.col("threshold"), F.lit(True))
                             & F.coalesce(poisson_tail(F.col("suspects"), F.col("n_words") * F.col("rate")) >= toxic_tail, F.lit(True))
                             ).drop("has_words", "rate")


def kept_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that ``judge_quality`` keeps, with all their columns."""
    bad = judge_quality(docs, labels, **options).where("not kept").select(
        F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash"), F.col("lang").alias("bad_lang")).distinct()
    d, b = docs.alias("d"), bad.alias("b")
    lang = F.coalesce(F.col("d.lang").cast("string"), F.lit(""))
    text = F.coalesce(F.col("d.text").cast("string"), F.lit(""))
    return d.join(b.hint("shuffle_hash"), F.col("d.doc_id").eqNullSafe(F.col("b.bad_id")) & (F.xxhash64(text) == F.col("b.bad_hash"))
                  & (lang == F.col("b.bad_lang")), "left_anti").select(*[F.col(f"d.`{c}`") for c in docs.columns])
