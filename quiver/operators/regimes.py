"""Volatility, VIX and trend regimes, the ensemble score and its signals.

All rules are ``when`` chains; a NULL comparison falls through to the
``otherwise`` branch exactly like ``np.where`` on NaN does in the reference.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiver.functions.scalar import clip_keep_null
from quiver.functions.windows import KEYS, expanding, guarded, series_window

# Regime labels and the decision thresholds of the rules.
HIGH_VOL, LOW_VOL = "high_vol", "low_vol"
UPTREND, DOWNTREND = "uptrend", "downtrend"
RISK_OFF, LOW_VOL_UP, LOW_VOL_DOWN, NEUTRAL = "risk_off", "low_vol_uptrend", "low_vol_downtrend", "neutral"
HIGH_VIX, NORMAL_VIX, UNKNOWN_VIX = "high_vix", "normal_vix", "unknown_vix"
ENSEMBLE_BUY, ENSEMBLE_SELL = 0.55, 0.45
SCORE_STEP = 0.15
PROB_FLOOR, PROB_CAP = 0.1, 0.9


# -- E12 --------------------------------------------------------------------
def expanding_quantile(col: str, q: float = 0.75, min_periods: int = 252,
                       keys: Sequence[str] = KEYS) -> Column:
    """Exact interpolated quantile of all values so far, from the
    ``min_periods``-th non-missing value on."""
    return guarded(lambda c: F.percentile(c, q), col, min_periods, expanding(keys))


# -- J1 ---------------------------------------------------------------------
def volatility_regime(vol: str = "vol", cutoff: str = "vol_cutoff") -> Column:
    return F.when(F.col(vol) > F.col(cutoff), HIGH_VOL).otherwise(LOW_VOL)


# -- J2 ---------------------------------------------------------------------
def vix_regime(df: DataFrame, level: float = 25.0, col: str = "vix_close") -> Column:
    if col not in df.columns:
        return F.lit(UNKNOWN_VIX)
    return F.when(F.col(col) > level, HIGH_VIX).otherwise(NORMAL_VIX)


# -- J3 ---------------------------------------------------------------------
def trend_regime(fast: str = "sma_20", slow: str = "sma_50") -> Column:
    return F.when(F.col(fast) > F.col(slow), UPTREND).otherwise(DOWNTREND)


# -- J4 / J5 ----------------------------------------------------------------
def market_regime(vol_regime: str = "volatility_regime", trend: str = "trend_regime",
                  vix: str | None = None) -> Column:
    """First match wins: risk_off, low_vol_uptrend, low_vol_downtrend, neutral.

    With ``vix`` (J5) a high-VIX day is risk_off as well.
    """
    risk = F.col(vol_regime) == HIGH_VOL
    if vix is not None:
        risk = risk | (F.col(vix) == HIGH_VIX)
    low = F.col(vol_regime) == LOW_VOL
    return (F.when(risk, RISK_OFF)
            .when(low & (F.col(trend) == UPTREND), LOW_VOL_UP)
            .when(low & (F.col(trend) == DOWNTREND), LOW_VOL_DOWN)
            .otherwise(NEUTRAL))


# -- J6, J7 -----------------------------------------------------------------
def ensemble_score(mean5: str = "rolling_mean_5", std20: str = "rolling_std_20",
                   cutoff: str = "vol_cutoff", sum10: str = "momentum_10") -> Column:
    """sign(mean5) + (std20 < cutoff ? 1 : -1) + sign(sum10); NULL in warm-up."""
    vol_vote = F.when(F.col(std20) < F.col(cutoff), F.lit(1.0)).otherwise(F.lit(-1.0))
    return F.signum(mean5) + vol_vote + F.signum(sum10)


def ensemble_probability(score: str = "ensemble_score") -> Column:
    return clip_keep_null(F.lit(0.5) + F.col(score) * SCORE_STEP, PROB_FLOOR, PROB_CAP)


# -- J8 ---------------------------------------------------------------------
def recommendation(regime: str = "market_regime", prob: str = "ensemble_prob_up") -> Column:
    p = F.col(prob)
    return (F.when(F.col(regime) == RISK_OFF, "NO TRADE (Risk-Off Regime)")
            .when((F.col(regime) == LOW_VOL_UP) & (p > ENSEMBLE_BUY), "BUY - STRONG UP")
            .when(p > ENSEMBLE_BUY, "BUY")
            .when(p < ENSEMBLE_SELL, "SELL / SHORT")
            .otherwise("NO TRADE (Neutral)"))


# -- J9, J10 ----------------------------------------------------------------
def long_only_position(regime: str = "market_regime", prob: str = "ensemble_prob_up") -> Column:
    return F.when((F.col(regime) == LOW_VOL_UP) & (F.col(prob) > ENSEMBLE_BUY), 1).otherwise(0)


def trade_outcome(position: str = "position", nxt: str = "next_day_return") -> Column:
    held = F.col(position) == 1
    return (F.when(held & (F.col(nxt) > 0), 1)
            .when(held & (F.col(nxt) <= 0), 0))


#: Rows of the large and small blocks of ``with_expanding_quantile``.
LARGE, SMALL = 1 << 14, 1 << 7


def _near_quantile(values: Column, below: Column, m: Column, q: float, rows: int) -> tuple[Column, Column]:
    """Of ``m`` sorted values, given without the ``below`` smallest, those that can be
    around the quantile until ``rows`` more are added, and how many are below them."""
    k = F.floor((m - 1) * q)
    low = F.greatest(F.lit(0), k - rows - 4)
    high = F.least(m - 1, k + rows + 4)
    return F.slice(values, (low - below + 1).cast("int"), (high - low + 1).cast("int")), low


def with_expanding_quantile(df: DataFrame, col: str, out: str, q: float = 0.75, min_periods: int = 252,
                            keys: Sequence[str] = KEYS, large: int = LARGE, small: int = SMALL) -> DataFrame:
    """E12 as a column, exact, from order statistics over blocks of rows.

    Same result as ``expanding_quantile`` (Spark's ``percentile`` over a
    growing frame), which re-sorts the frame's values at every row. b rows more
    move the quantile's rank among the values before by at most b + 1, so a
    block needs only the sorted values that close to it: blocks of ``large``
    rows get them from all values before, blocks of ``small`` rows from
    these and the rows between, a row from these and the rows of its block.
    Array expressions on rows that are already together per series: no
    shuffle is added, and no array but the values before a large block
    (none for series up to ``large`` rows) grows with the series.
    """
    names = [c for c in df.columns if c != out and c not in keys]
    v = F.col(col).cast("double")
    rows = df.select(*keys, *names, F.when(~F.isnan(v), v).alias("_v"), (F.row_number().over(series_window(keys)) - 1).alias("_i"))
    kept = F.struct("_i", "_v", F.struct(*names).alias("_r"))
    blocks = rows.groupBy(*keys, F.floor(F.col("_i") / large).alias("_b")).agg(F.array_sort(F.collect_list(kept)).alias("_rows"))
    blocks = blocks.select(*keys, "_b", "_rows", F.transform("_rows", lambda x: x["_v"]).alias("_vals"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_prev", F.sort_array(F.array_compact(F.flatten(F.collect_list("_vals").over(before)))))
    near, low = _near_quantile(F.col("_prev"), F.lit(0), F.size("_prev"), q, large)
    blocks = blocks.select(*keys, "_rows", "_vals", near.alias("_near"), low.alias("_low"), F.size("_prev").alias("_m"))

    c = F.col("_c") * small
    parts = blocks.withColumn("_c", F.explode(F.sequence(F.lit(0), F.floor((F.size("_rows") - 1) / small).cast("int"))))
    parts = parts.select(*keys, F.slice("_rows", c + 1, F.lit(small)).alias("_rows"), F.slice("_vals", c + 1, F.lit(small)).alias("_vals"),
                         "_near", "_low", "_m", F.array_compact(F.slice("_vals", F.lit(1), c)).alias("_more"))
    parts = parts.select(*keys, "_rows", "_vals", "_low", F.sort_array(F.concat("_near", "_more")).alias("_near"),
                         (F.col("_m") + F.size("_more")).alias("_m"))
    near, low = _near_quantile(F.col("_near"), F.col("_low"), F.col("_m"), q, small)
    parts = parts.select(*keys, "_rows", "_vals", near.alias("_near"), low.alias("_low"), "_m")

    one = parts.select(*keys, "_vals", "_near", "_low", "_m", F.posexplode("_rows").alias("_p", "_row"))
    one = one.select(*keys, "_row", "_near", "_low", "_m", F.array_compact(F.slice("_vals", F.lit(1), F.col("_p") + 1)).alias("_more"))
    one = one.select(*keys, "_row", "_low", (F.col("_m") + F.size("_more")).alias("_m"), F.sort_array(F.concat("_near", "_more")).alias("_near"))
    place = (F.col("_m") - 1) * q
    k = F.floor(place)
    a = F.get("_near", (k - F.col("_low")).cast("int"))
    b = F.get("_near", (k - F.col("_low") + 1).cast("int"))
    value = F.when(place == k, a).otherwise(a + (b - a) * (place - k))
    shown = (F.col("_m") >= min_periods) & (F.col("_m") > 0)
    cols = [F.col(n) if n in keys else F.col(f"_row._r.`{n}`").alias(n) for n in df.columns if n != out]
    return one.select(*cols, F.when(shown, value).alias(out))
