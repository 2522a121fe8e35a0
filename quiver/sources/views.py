"""Canonical series views over the landed tables.

Each view exists twice: as a DataFrame built from the Parquet tables and as
SQL text for the independent DuckDB oracle. All of them are aggregates, so
the raw volume (orders, line items, events) is reduced by a partial
(map-side) aggregation before any shuffle, and the output has one row per
(series, period): a hot customer segment or event type with a third of the
raw rows still yields one bar per date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The 13 market instruments, in the order the instrument table
# lists them (volatility index, S&P 500, small caps, sectors, bonds, credit,
# dollar, gold, 10-year yield).
INSTRUMENTS = ("vix", "spy", "iwm", "xlk", "xlf", "xli", "xly", "xlp",
               "tlt", "hyg", "uup", "gld", "tnx")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _orders_bars(orders: DataFrame, ticker) -> DataFrame:
    return (orders.groupBy(ticker.alias("ticker"),
                           F.to_date("o_orderdate").alias("date"))
            .agg(F.avg("o_totalprice").alias("price"),
                 F.count(F.lit(1)).cast("double").alias("volume")))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per customer segment: (ticker, date, price, volume)."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = orders.join(cust, orders.o_custkey == cust.c_custkey, "inner")
    return _orders_bars(joined, F.col("c_mktsegment"))


def bars_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series over all orders, ticker 'ALL'."""
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice")
    return _orders_bars(orders, F.lit("ALL"))


def bars_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """125 series (segment x nation): the many-tickers scale fixture."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    joined = orders.join(cust, orders.o_custkey == cust.c_custkey, "inner")
    return _orders_bars(joined, F.concat_ws("-", "c_mktsegment", F.col("c_nationkey").cast("string")))


def instruments_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long instrument closes: (name, date, close)."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate", "l_extendedprice")
    name = F.element_at(F.array(*[F.lit(n) for n in INSTRUMENTS]),
                        (F.col("l_partkey") % len(INSTRUMENTS) + 1).cast("int"))
    return (li.groupBy(name.alias("name"), F.to_date("l_shipdate").alias("date"))
            .agg(F.avg("l_extendedprice").alias("close")))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ticks: (ticker, ts, value)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_type").alias("ticker"), "ts", "value", "event_id")


# ---------------------------------------------------------------------------
# The same views as SQL text (DuckDB dialect) for the oracle.
# ---------------------------------------------------------------------------

_NAME_LIST = "[" + ", ".join(f"'{n}'" for n in INSTRUMENTS) + "]"

SQL_VIEWS: dict[str, str] = {
    "bars": """bars AS (
  SELECT c.c_mktsegment AS ticker, CAST(o.o_orderdate AS DATE) AS date,
         avg(o.o_totalprice) AS price, CAST(count(*) AS DOUBLE) AS volume
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2)""",
    "bars_all": """bars_all AS (
  SELECT 'ALL' AS ticker, CAST(o_orderdate AS DATE) AS date,
         avg(o_totalprice) AS price, CAST(count(*) AS DOUBLE) AS volume
  FROM orders GROUP BY 1, 2)""",
    "bars_wide": """bars_wide AS (
  SELECT c.c_mktsegment || '-' || CAST(c.c_nationkey AS VARCHAR) AS ticker,
         CAST(o.o_orderdate AS DATE) AS date,
         avg(o.o_totalprice) AS price, CAST(count(*) AS DOUBLE) AS volume
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2)""",
    "instruments_long": f"""instruments_long AS (
  SELECT {_NAME_LIST}[CAST(l_partkey % 13 + 1 AS INTEGER)] AS name,
         CAST(l_shipdate AS DATE) AS date, avg(l_extendedprice) AS close
  FROM lineitem GROUP BY 1, 2)""",
    "ticks": """ticks AS (
  SELECT event_type AS ticker, ts, value, event_id FROM events)""",
}


def sql_with(*names: str, extra: list[str] | None = None) -> str:
    """``WITH`` clause holding the named canonical views plus extra CTEs."""
    parts = [SQL_VIEWS[n] for n in names] + list(extra or [])
    return "WITH " + ",\n".join(parts) + "\n"
