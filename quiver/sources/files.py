"""File sources and sinks.

Readers never rely on row numbers or file order: the price-file reader keeps
rows whose first field parses as a date, so files split freely and headers
of any height are dropped by content. Writers are plain DataFrame writers
(partitioned Parquet by default).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Column order of a downloaded daily price file after the date.
PRICE_FILE_COLUMNS = ("Close", "High", "Low", "Open", "Volume")
# Labels the service reads from the prediction report.
PROB_LABEL, REC_LABEL = "Ensemble Prob UP", "Recommendation"


def read_price_file(spark: SparkSession, path: str, columns: Sequence[str] = PRICE_FILE_COLUMNS,
                    date_format: str = "yyyy-MM-dd") -> DataFrame:
    """A1: a price CSV whose first column is the date, with any number of
    header rows (the three-row 'Price / Ticker / Date' header included).

    Columns are found by name (any case, any order) in the header row that
    names ``Close`` or ``price``; without one, or with differing ones among
    the files, the read fails. Names of ``columns`` that the header lacks come as
    NULL; a ``price`` column is kept under that name. Every field is read as
    text; rows whose first field is not a date are dropped. Numbers use ``try_cast`` (bad -> NULL).
    Partition columns of the folder layout (e.g. ``ticker=``) are kept.
    """
    raw = spark.read.option("header", "false").csv(path)
    fields = sorted((c for c in raw.columns if re.fullmatch(r"_c\d+", c)), key=lambda c: int(c[2:]))
    date = F.try_to_date(F.col(fields[0]), date_format)
    names = F.array(*[F.lower(F.trim(F.coalesce(c, F.lit("")))) for c in fields[1:]])
    heads = (raw.filter(date.isNull()).select(names.alias("h")).filter(F.arrays_overlap("h", F.array(F.lit("close"), F.lit("price"))))
             .distinct().limit(2).collect())
    if len(heads) != 1:
        raise ValueError(f"{path}: {'differing header rows' if heads else 'no header row names Close or price'}")
    at = {name: c for name, c in reversed(list(zip(heads[0].h, fields[1:])))}
    wanted = [c for c in columns if c.lower() != "close" or "close" in at or "price" not in at]
    wanted += ["price"] if "price" in at and "price" not in wanted else []
    extra = [c for c in raw.columns if c not in fields]
    value = {c: F.col(at[c.lower()]) if c.lower() in at else F.lit(None) for c in wanted}
    return raw.filter(date.isNotNull()).select(
        *extra, date.alias("date"), *[v.cast("string").try_cast("double").alias(c) for c, v in value.items()])


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None,
               fmt: str | None = None) -> DataFrame:
    """A2: a raw or processed table, CSV (with header) or Parquet by suffix."""
    fmt = fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        return reader.option("header", "true").csv(path)
    return reader.format(fmt).load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ("ticker",),
                mode: str = "overwrite") -> str:
    """Save a table (partitioned by ticker when it has one)."""
    cols = [c for c in partition_by if c in df.columns]
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", "true")
    if cols:
        w = w.partitionBy(*cols)
    w.save(path)
    return path


def _fs(spark: SparkSession, path: str):
    """(file system, path) of the cluster's storage for ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def is_complete(spark: SparkSession, path: str) -> bool:
    """True if a write to ``path`` has ended: its folder has the success marker."""
    fs, p = _fs(spark, path)
    return fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))


def publish(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ("ticker",)) -> bool:
    """Write beside ``path`` and move the complete table there in one rename.

    A write that fails leaves nothing under ``path``; what an earlier broken
    write left there (no success marker) gives way. If another writer was
    first, its table stays, this one goes and the result is False.
    """
    spark = df.sparkSession
    aside = f"{path.rstrip('/')}.writing-{uuid.uuid4().hex[:12]}"
    fs, target = _fs(spark, path)
    source = spark._jvm.org.apache.hadoop.fs.Path(aside)
    try:
        write_table(df, aside, fmt, partition_by)
        if fs.exists(target) and not is_complete(spark, path):
            fs.delete(target, True)
        return not fs.exists(target) and fs.rename(source, target)
    finally:
        if fs.exists(source):
            fs.delete(source, True)


def materialize_once(df: DataFrame, path: str, fmt: str = "parquet",
                     partition_by: Sequence[str] = ("ticker",)) -> str:
    """Build an output only if it is not there yet, complete with its marker."""
    if not is_complete(df.sparkSession, path) and not publish(df, path, fmt, partition_by) and not is_complete(df.sparkSession, path):
        raise OSError(f"{path} could not be published")
    return path


def write_json_sorted(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Metrics as JSON lines with keys (columns) in sorted order."""
    df.select(*sorted(df.columns)).write.mode(mode).json(path)
    return path


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def write_text_reports(df: DataFrame, text_col: str, path: str, partition_by: Sequence[str] = ("ticker",)) -> str:
    """Text reports, one folder per ticker (A12/A13 sink)."""
    df.select(*partition_by, text_col).write.mode("overwrite").partitionBy(*partition_by).text(path)
    return path


def parse_report(spark: SparkSession, path: str) -> DataFrame:
    """A10: probability and recommendation from ``key : value`` report files.

    Each file is one row (reports are a few lines); lines are numbered with
    ``posexplode`` so the last matching line wins, as in the service loop.
    A probability that does not parse keeps the previous one (0.0 if none);
    a missing recommendation is 'UNKNOWN'.
    """
    raw = spark.read.option("wholetext", "true").text(path)
    extra = [c for c in raw.columns if c != "value"]
    lines = raw.select(*extra, F.input_file_name().alias("_file"),
                       F.posexplode(F.split("value", "\n")).alias("_pos", "_line"))
    after = F.trim(F.substring_index("_line", ":", -1))
    num = after.try_cast("double")
    keyed = [*extra, "_file"]
    agg = lines.groupBy(*keyed).agg(
        F.max_by(F.when(F.col("_line").contains(PROB_LABEL), num), F.when(
            F.col("_line").contains(PROB_LABEL) & num.isNotNull(), F.col("_pos"))).alias("_p"),
        F.max_by(F.when(F.col("_line").contains(REC_LABEL), after), F.when(
            F.col("_line").contains(REC_LABEL), F.col("_pos"))).alias("_r"))
    return agg.select(*extra, F.coalesce("_p", F.lit(0.0)).alias("probability_up"),
                      F.coalesce("_r", F.lit("UNKNOWN")).alias("recommendation"))


def serve_table(parsed: DataFrame) -> DataFrame:
    """The response rows a service would return, as a table."""
    return parsed.select(
        "ticker", F.when(F.col("probability_up") >= 0.5, "UP").otherwise("DOWN").alias("prediction"),
        "probability_up", "recommendation")


RUNS_SCHEMA = "ticker string, key string, value double, run_id string, kind string"


def append_run(metrics: DataFrame, path: str, run_id: str, kind: str) -> str:
    """Log one run's parameters or metrics as long rows (run_id, kind,
    ticker, key, value). A run's kind is a partition of its own that is
    replaced as a whole, so a repeated or retried call leaves its rows once."""
    keys = [c for c in metrics.columns if c != "ticker"]
    items = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("double").alias("value")) for k in keys])
    long = metrics.select(F.col("ticker").cast("string").alias("ticker"), F.explode(items).alias("_kv")).select(
        "ticker", F.col("_kv.key").alias("key"), F.col("_kv.value").alias("value"),
        F.lit(run_id).alias("run_id"), F.lit(kind).alias("kind"))
    long.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "kind").parquet(path)
    return path


def compare_runs(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """One row per (run, ticker), one column per metric."""
    runs = spark.read.schema(RUNS_SCHEMA).parquet(path)
    return runs.groupBy("run_id", "ticker").pivot("key", list(keys)).agg(F.max("value"))


def save_params(df: DataFrame, path: str, model_type: str) -> str:
    """A fitted parameter table stored with its model type."""
    df.withColumn("model_type", F.lit(model_type)).write.mode("overwrite").parquet(path)
    return path


def load_params(spark: SparkSession, path: str, model_type: str) -> DataFrame:
    """Load a parameter table, rejecting one stored for another model type."""
    df = spark.read.parquet(path)
    bad = df.filter(F.col("model_type") != model_type).limit(1).take(1)
    if bad:
        raise TypeError(f"stored parameters are {bad[0]['model_type']!r}, expected {model_type!r}")
    return df.drop("model_type")


def save_model(model, path: str) -> str:
    """A fitted ``pyspark.ml`` model (its class is stored with it)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str, cls):
    """Load a model; a folder written for another class is rejected."""
    try:
        return cls.load(path)
    except Exception as exc:  # noqa: BLE001 - Spark raises different errors per version
        raise TypeError(f"{path} does not hold a {cls.__name__}: {exc}") from exc
