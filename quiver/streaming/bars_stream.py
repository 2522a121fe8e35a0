"""Tick-to-bar aggregation (A4) as a Structured Streaming query.

Landed tick files are read as a stream. Every micro-batch aggregates its
ticks to partial bars per (ticker, window start) and writes them through
``foreachBatch`` under its batch id, which a repeated batch overwrites. Open,
high, low, close and volume of partial bars merge exactly, so ``read_bars``
combines them: no state is kept, and ticks that arrive late, by any amount, are
merged like all others instead of falling behind a watermark. The
checkpoint lives under the cluster's shared checkpoint folder, so a lost
driver or executor resumes from the last committed batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quiver.session import ensure_checkpoint_dir


def partial_bars(ticks: DataFrame, unit: str = "1 hour") -> DataFrame:
    """OHLCV of one batch per (ticker, window) with the order keys of its first
    and last tick (event time must be a session-zone TIMESTAMP; window starts are returned
    as wall-clock TIMESTAMP_NTZ like the landed ticks)."""
    order = F.struct("ts", "event_id")
    return (ticks.groupBy("ticker", F.window("ts", unit).alias("w"))
            .agg(F.min_by("value", order).alias("open"), F.max("value").alias("high"),
                 F.min("value").alias("low"), F.max_by("value", order).alias("close"),
                 F.count(F.lit(1)).alias("volume"), F.min(order).alias("first"), F.max(order).alias("last"))
            .select("ticker", F.col("w.start").cast("timestamp_ntz").alias("hour"),
                    "open", "high", "low", "close", "volume", "first", "last"))


def run_bars_stream(spark: SparkSession, source_dir: str, schema: StructType | str, out_dir: str,
                    checkpoint: str | None = None, unit: str = "1 hour", file_glob: str = "*.parquet") -> str:
    """Process every landed file once (``availableNow``) and return ``out_dir``.

    Each micro-batch writes its partial bars below its batch id;
    ``read_bars`` merges them.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    checkpoint = checkpoint or f"{base}/streams/{out_dir.rstrip('/').split('/')[-1]}"
    ticks = (spark.readStream.schema(schema).option("pathGlobFilter", file_glob).parquet(source_dir)
             .select(F.col("event_type").alias("ticker"), F.col("ts").cast("timestamp").alias("ts"),
                     "value", "event_id"))

    def write(batch: DataFrame, batch_id: int) -> None:
        partial_bars(batch, unit).write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch_id={batch_id}")

    q = (ticks.writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return out_dir


def read_bars(spark: SparkSession, out_dir: str) -> DataFrame:
    """Every bar, merged from its partial bars of all batches."""
    return (spark.read.parquet(out_dir).groupBy("ticker", "hour")
            .agg(F.min_by("open", "first").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
                 F.max_by("close", "last").alias("close"), F.sum("volume").alias("volume")))
