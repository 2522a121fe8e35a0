"""Market instruments: wide table, relative strength, alignment onto bars.

The instrument table has one row per calendar date (a pivot of 13 named
instruments), so its size is bounded by the calendar, not by the data
volume: a few thousand rows per decade. No broadcast hint is given: the
planner decides by the measured size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quiver.functions.scalar import safe_div, safe_ln
from quiver.functions.windows import KEYS, rolling_sum, series_window
from quiver.operators.features import forward_fill
from quiver.sources.views import INSTRUMENTS

# The eight relative-strength ratios (name, numerator, denominator).
RATIOS = (
    ("iwm_spy_relative_strength", "iwm", "spy"),
    ("qqq_spy_market_strength", "xlk", "spy"),
    ("tech_vs_staples", "xlk", "xlp"),
    ("discretionary_vs_staples", "xly", "xlp"),
    ("financials_vs_market", "xlf", "spy"),
    ("industrials_vs_market", "xli", "spy"),
    ("credit_risk_appetite", "hyg", "tlt"),
    ("gold_vs_market", "gld", "spy"),
)

# Five-row momentum of instrument returns (feature, instrument).
INSTRUMENT_MOMENTUM = (
    ("spy_momentum_5", "spy"), ("iwm_momentum_5", "iwm"), ("xlk_momentum_5", "xlk"),
    ("dollar_momentum_5", "uup"), ("bond_momentum_5", "tlt"), ("credit_momentum_5", "hyg"),
)


def market_columns(names: Sequence[str] = INSTRUMENTS) -> list[str]:
    cols = []
    for n in names:
        cols += [f"{n}_close", f"{n}_return"]
    return cols


def instrument_returns(long: DataFrame) -> DataFrame:
    """Per-instrument log return on the instrument's own calendar."""
    w = Window.partitionBy("name").orderBy("date")
    lc = safe_ln("close")
    return long.withColumn("ret", lc - F.lag(lc).over(w))


def calendar_align(long: DataFrame, names: Sequence[str] = INSTRUMENTS) -> DataFrame:
    """One row per date of the first instrument, other instruments aligned
    (missing where they have no bar that day)."""
    # conditional aggregation = a pivot with known values (one shuffle on date,
    # partial aggregation; no distinct-values job, simpler plan than Pivot)
    aggs = []
    for n in names:
        hit = F.col("name") == n
        aggs += [F.max(F.when(hit, F.col("close"))).alias(f"{n}_close"),
                 F.max(F.when(hit, F.col("ret"))).alias(f"{n}_return")]
    wide = instrument_returns(long.filter(F.col("name").isin(list(names)))).groupBy("date").agg(*aggs)
    return wide.filter(F.col(f"{names[0]}_close").isNotNull()).select("date", *market_columns(names))


def relative_strength(df: DataFrame) -> DataFrame:
    """The eight ratios; NULL where the denominator is 0 or missing."""
    return df.withColumns({name: safe_div(f"{a}_close", f"{b}_close") for name, a, b in RATIOS})


def ingest_instruments(long: DataFrame, names: Sequence[str] = INSTRUMENTS,
                       start: str | None = None, end: str | None = None,
                       skip_absent: bool = True) -> DataFrame:
    """A5: closes and returns of the named instruments on the first one's
    calendar, incomplete dates dropped, ratios added.

    ``skip_absent`` drops instruments without any bar first; that needs
    one small action (at most ``len(names)`` distinct names reach the driver).
    """
    if start is not None:
        long = long.filter(F.col("date") >= F.to_date(F.lit(start)))
    if end is not None:
        long = long.filter(F.col("date") < F.to_date(F.lit(end)))
    names = list(names)
    if skip_absent:
        present = {r[0] for r in long.filter(F.col("name").isin(names))
                   .select("name").distinct().collect()}
        names = [n for n in names if n in present]
    wide = calendar_align(long, names).na.drop("any")
    if all(n in names for n in ("iwm", "spy", "xlk", "xlp", "xly", "xlf", "xli", "hyg", "tlt", "gld")):
        wide = relative_strength(wide)
    return wide


def join_market_ffill(bars: DataFrame, market: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Bars LEFT JOIN instruments on date, forward fill every column per
    ticker, log return after the fill, incomplete rows dropped.

    The market side has at most one row per calendar date; whether it is
    broadcast is left to the planner's measured sizes.
    """
    joined = bars.join(market, "date", "left")
    filled = forward_fill(joined, keys=keys)
    lp = safe_ln("price")
    out = filled.withColumn("log_return", lp - F.lag(lp).over(series_window(keys)))
    return out.na.drop("any")


def instrument_momentum(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Five-row sums of six instrument returns."""
    return df.withColumns({name: rolling_sum(f"{src}_return", 5, keys)
                           for name, src in INSTRUMENT_MOMENTUM})


def level_changes(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """First differences of vix and the 10-year yield; vix one row back."""
    w = series_window(keys)
    return df.withColumns({
        "vix_change": F.col("vix_close") - F.lag("vix_close").over(w),
        "vix_lag_1": F.lag("vix_close").over(w),
        "rate_change": F.col("tnx_close") - F.lag("tnx_close").over(w),
    })


def asof_fill(left: DataFrame, right: DataFrame, value: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """For every left row the last right value at or before its date.

    Union both sides (same key and order), carry the last non-null value
    over the ordered series and keep the left rows: one exchange, one sort,
    no inequality join.
    """
    r = right.select(*keys, "date", F.col(value).alias("_v"), F.lit(0).alias("_side"))
    lcols = [c for c in left.columns]
    l_ = left.withColumn("_v", F.lit(None).cast("double")).withColumn("_side", F.lit(1))
    u = l_.unionByName(r, allowMissingColumns=True)
    # Right rows sort before left rows on the same date, so "at or before" holds.
    w = Window.partitionBy(*keys).orderBy("date", "_side").rowsBetween(Window.unboundedPreceding, 0)
    out = u.withColumn(value, F.last("_v", ignorenulls=True).over(w)).filter(F.col("_side") == 1)
    return out.select(*lcols, value)


def ohlcv_bars(ticks: DataFrame, unit: str = "hour") -> DataFrame:
    """A4: open/high/low/close/volume bars from ticks, per ticker and period.

    A partial aggregate: each map task pre-aggregates its ticks before the
    shuffle, so a hot ticker costs no more than a cold one downstream.
    """
    period = F.date_trunc(unit, "ts")
    order = F.struct("ts", "event_id") if "event_id" in ticks.columns else F.col("ts")
    return (ticks.groupBy("ticker", period.alias(unit))
            .agg(F.min_by("value", order).alias("open"), F.max("value").alias("high"),
                 F.min("value").alias("low"), F.max_by("value", order).alias("close"),
                 F.count(F.lit(1)).alias("volume")))


def ingest_bars(bars: DataFrame, ticker: str, start: str, end: str, allow_empty: bool = False) -> DataFrame:
    """A3: one ticker, half-open date range, incomplete rows dropped; an empty result fails.

    The filters reach the scan (partition pruning when the bars are written
    with ``partitionBy("ticker")``).
    """
    out = (bars.filter((F.col("ticker") == ticker)
                        & (F.col("date") >= F.to_date(F.lit(start)))
                        & (F.col("date") < F.to_date(F.lit(end))))
            .select("ticker", "date", "price", "volume").na.drop("any"))
    return out if allow_empty else require_rows(out, f"{ticker} from {start} to {end}")


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Explicit empty check (one ``limit(1)`` action)."""
    if not df.limit(1).take(1):
        raise ValueError(f"{what} is empty")
    return df


def processed_table(bars: DataFrame, long: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """A5 + C1: the 37-column processed table per ticker."""
    return join_market_ffill(bars, ingest_instruments(long), keys)

