"""Helpers shared by the training-data operators: text normalisation as
column expressions, written intermediate tables, and connected components.

Null texts count as empty everywhere. ``fresh`` gives internal columns names
that the caller's extra columns cannot clash with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quiver.session import shared_path, tune
from quiver.sources.files import _fs

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = " \t\n\x0b\f\r"
#: XXH64 seed of Spark's ``xxhash64``.
SEED = 42
#: Setting that removes a query's shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """Lower-cases A-Z only. All-ASCII texts take the fast built-in; others
    would lose the case of letters like É in it and are translated."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def text_of(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def space_words(c: Column) -> Column:
    """Words between ASCII white space, as an array."""
    t = F.btrim(c, F.lit(SPACES))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, r"[ \t\n\x0B\f\r]+"))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant that is no column of ``df`` (any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to a new folder below the cluster's shared checkpoint folder and
    read back: cuts the lineage, computes once, survives lost executors."""
    import uuid

    path = shared_path(df.sparkSession, f"quiver-llm/{name}-{uuid.uuid4().hex[:12]}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_lean(df: DataFrame, name: str) -> DataFrame:
    """``materialize`` that removes the write's shuffle files when it is done, not when the driver collects garbage."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return materialize(df, name)
    finally:
        if before is None:
            conf.unset(CLEANUP)
        else:
            conf.set(CLEANUP, before)


def discard(*tables: DataFrame) -> None:
    """Delete materialized tables that nothing reads any more."""
    for t in tables:
        for folder in {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            if "/quiver-llm/" in folder:  # never a caller's table
                fs, path = _fs(t.sparkSession, folder)
                fs.delete(path, True)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest
    node reachable. Nulls and self-loops are ignored.

    Alternates large-star and small-star steps, each a map-side combined
    minimum per node and a join, until the edge set stops changing. Every
    round is written to the shared folder, so lineage stays short. A hub with
    most edges is reduced before the shuffle; its join is one that Spark can
    split. Edges never outnumber the input's.
    """
    e = (edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = materialize(e, "cc")
    seen = None
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = materialize(large, "cc")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                 F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        e = materialize(small, "cc")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(e.select(F.col("v"), F.col("v")).distinct()))
