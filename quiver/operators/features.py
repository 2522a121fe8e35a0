"""Per-series features: returns, lags, rolling and expanding statistics.

All functions are ``DataFrame -> DataFrame`` and only add columns in one
projection, so every frame over (ticker ORDER BY date) shares a single
exchange and sort. Input contract: one row per (ticker, date).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiver.functions.scalar import safe_div, safe_ln
from quiver.functions.windows import (
    KEYS,
    expanding,
    rolling_mean,
    rolling_std,
    rolling_sum,
    series_window,
)


# -- E1 ---------------------------------------------------------------------
def log_returns(df: DataFrame, price: str = "price", keys: Sequence[str] = KEYS) -> DataFrame:
    """log_price, log_return (first difference) and its square."""
    w = series_window(keys)
    lp = safe_ln(price)
    lr = lp - F.lag(lp, 1).over(w)
    return df.withColumns({
        "log_price": lp,
        "log_return": lr,
        "log_return_squared": F.pow(lr, 2),
    })


# -- E2 ---------------------------------------------------------------------
def return_lags(df: DataFrame, lags: Sequence[int] = (1, 2, 3, 5), col: str = "log_return",
                keys: Sequence[str] = KEYS) -> DataFrame:
    w = series_window(keys)
    return df.withColumns({f"return_lag_{n}": F.lag(col, n).over(w) for n in lags})


# -- E3 ---------------------------------------------------------------------
def momentum(df: DataFrame, windows: Sequence[int] = (3, 5, 10), col: str = "log_return",
             keys: Sequence[str] = KEYS) -> DataFrame:
    return df.withColumns({f"momentum_{n}": rolling_sum(col, n, keys) for n in windows})


# -- E4, E5 -----------------------------------------------------------------
def rolling_stats(df: DataFrame, windows: Sequence[int] = (5, 20), col: str = "log_return",
                  keys: Sequence[str] = KEYS) -> DataFrame:
    cols: dict[str, Column] = {}
    for n in windows:
        cols[f"rolling_mean_{n}"] = rolling_mean(col, n, keys)
        cols[f"rolling_std_{n}"] = rolling_std(col, n, keys)
    return df.withColumns(cols)


def volatility_ratio(df: DataFrame) -> DataFrame:
    return df.withColumn("volatility_ratio", safe_div("rolling_std_5", "rolling_std_20"))


# -- E6 ---------------------------------------------------------------------
def volume_momentum(df: DataFrame, n: int = 5, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rolling mean of volume (a mean despite the name); 0 without volume."""
    if "volume" in df.columns:
        return df.withColumn(f"volume_momentum_{n}", rolling_mean("volume", n, keys))
    return df.withColumn(f"volume_momentum_{n}", F.lit(0.0))


# -- E9, E10 ----------------------------------------------------------------
def next_day_return(df: DataFrame, col: str = "log_return", name: str = "next_day_return",
                    keys: Sequence[str] = KEYS) -> DataFrame:
    return df.withColumn(name, F.lead(col, 1).over(series_window(keys)))


def next_day_target(df: DataFrame, col: str = "log_return", corrected: bool = False,
                    keys: Sequence[str] = KEYS) -> DataFrame:
    """1 when the next return is positive, else 0.

    The default reproduces the reference: the last row (no next return) is 0.
    ``corrected=True`` leaves it NULL instead.
    """
    up = F.lead(col, 1).over(series_window(keys)) > 0
    target = up.cast("int") if corrected else F.coalesce(up, F.lit(False)).cast("int")
    return df.withColumn("target", target)


# -- E11 --------------------------------------------------------------------
def moving_averages(df: DataFrame, windows: Sequence[int] = (20, 50), col: str = "price",
                    keys: Sequence[str] = KEYS) -> DataFrame:
    return df.withColumns({f"sma_{n}": rolling_mean(col, n, keys) for n in windows})


# -- E13 --------------------------------------------------------------------
def forward_fill(df: DataFrame, cols: Sequence[str] | None = None,
                 keys: Sequence[str] = KEYS) -> DataFrame:
    """Last known value of every (or the given) column."""
    frame = expanding(keys)
    skip = set(keys) | {"date"}
    cols = [c for c in (cols or df.columns) if c not in skip]
    return df.withColumns({c: F.last(c, ignorenulls=True).over(frame) for c in cols})


# -- E2..E6, E9 together (package feature set) --------------------------------
def lstm_features(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Lags, momentum, rolling statistics, volume mean and next-day target."""
    out = return_lags(df, keys=keys)
    out = momentum(out, keys=keys)
    out = rolling_stats(out, keys=keys)
    out = volatility_ratio(out)
    out = volume_momentum(out, keys=keys)
    return next_day_target(out, keys=keys)


# -- B-series: projections and filters -----------------------------------------
def normalize_price(df: DataFrame) -> DataFrame:
    """B1: rename Close to price when price is absent; fail if neither exists."""
    if "price" not in df.columns and "Close" in df.columns:
        df = df.withColumnRenamed("Close", "price")
    if "price" not in df.columns:
        raise ValueError(f"input needs a 'price' or 'Close' column, got {df.columns}")
    return df


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """B2: drop rows with any missing value (or missing in ``subset``)."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def fill_zero_returns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing returns count as 0."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in cols})


def history_prefix(df: DataFrame, cutoff) -> DataFrame:
    """Rows up to and including ``cutoff`` (a date literal or column)."""
    bound = F.to_date(F.lit(cutoff)) if isinstance(cutoff, str) else cutoff
    return df.filter(F.col("date") <= bound)


def traded_days(df: DataFrame, position: str = "position") -> DataFrame:
    """Rows where a position is held."""
    return df.filter((F.col(position) != 0) & F.col(position).isNotNull())


def feature_columns(df: DataFrame, exclude: Sequence[str] = ("target", "price", "log_price")) -> DataFrame:
    """Every column but the excluded ones."""
    return df.select(*[c for c in df.columns if c not in set(exclude)])


def build_features(df: DataFrame) -> DataFrame:
    """Identity (hook for ``df.transform``); keeps rows and columns."""
    return df.select("*")


def direction_label(col: str | Column) -> Column:
    """> 0 is UP, everything else (including missing) DOWN."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c > 0, F.lit("UP")).otherwise(F.lit("DOWN"))


def percent_returns(df: DataFrame, col: str = "log_return", name: str = "return_pct") -> DataFrame:
    """Log return x 100."""
    return df.withColumn(name, F.col(col) * 100.0)


def threshold_direction(col: str | Column, t: float = 0.55) -> Column:
    """Probability >= t is 1, else 0."""
    c = F.col(col) if isinstance(col, str) else col
    return (c >= t).cast("int")


def three_way_direction(col: str | Column, t: float = 0.55) -> Column:
    """UP at p >= t, DOWN at p <= 1 - t, else NO TRADE."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.when(c >= t, "UP").when(c <= 1 - t, "DOWN").otherwise("NO TRADE"))


def series_row_number(keys: Sequence[str] = KEYS, desc: bool = False) -> Column:
    order = F.col("date").desc() if desc else F.col("date")
    return F.row_number().over(Window.partitionBy(*keys).orderBy(order))
