"""Ensemble regime backtest (J11) and its aggregates.

One DataFrame plan per call, many tickers at once. The daily table is built
in three projections that all reuse one exchange by ticker: rolling frames,
then the guarded expanding quantile over them, then the rule columns and
running equity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiver.functions.windows import KEYS, expanding, rolling_mean, rolling_std, rolling_sum, series_window
from quiver.operators import regimes as R
from quiver.operators.features import log_returns

GARCH_COL = "garch_conditional_volatility"


def prepare_returns(bars: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """bars -> rows with a log return (the processed-table contract)."""
    return (log_returns(bars, keys=keys)
            .drop("log_price", "log_return_squared")
            .filter(F.col("log_return").isNotNull()))


def ensemble_table(df: DataFrame, keys: Sequence[str] = KEYS, corrected: bool = False,
                   vol_quantile: float = 0.75, min_periods: int = 252) -> DataFrame:
    """Daily regimes, ensemble probability, position and equity curves.

    ``df`` holds (ticker, date, price, log_return[, garch_conditional_volatility]).
    The volatility series is the GARCH column when present, else the rolling
    20-row std of returns (mixed units with the std20 vote, as in the source).

    ``corrected=False`` reproduces the reference: equity uses the same-day
    return while the hit rate uses the next-day return. ``corrected=True``
    uses the next-day return for both.
    """
    w = series_window(keys)
    step1 = df.withColumns({
        "rolling_mean_5": rolling_mean("log_return", 5, keys),
        "rolling_std_20": rolling_std("log_return", 20, keys),
        "momentum_10": rolling_sum("log_return", 10, keys),
        "sma_20": rolling_mean("price", 20, keys),
        "sma_50": rolling_mean("price", 50, keys),
        "next_day_return": F.lead("log_return", 1).over(w),
    })
    vol = GARCH_COL if GARCH_COL in df.columns else "rolling_std_20"
    step2 = R.with_expanding_quantile(step1.withColumn("vol", F.col(vol)), "vol", "vol_cutoff",
                                      vol_quantile, min_periods, keys)
    step3 = step2.withColumns({
        "volatility_regime": R.volatility_regime("vol", "vol_cutoff"),
        "trend_regime": R.trend_regime("sma_20", "sma_50"),
        "ensemble_score": R.ensemble_score(),
    })
    step4 = step3.withColumns({
        "market_regime": R.market_regime(),
        "ensemble_prob_up": R.ensemble_probability(),
    })
    step5 = step4.withColumn("position", R.long_only_position())
    held_return = "next_day_return" if corrected else "log_return"
    step6 = step5.withColumns({
        "trade_correct": R.trade_outcome(),
        "strategy_return": F.col("position") * F.col(held_return),
    })
    frame = expanding(keys)
    buyhold_src = "next_day_return" if corrected else "log_return"
    return step6.withColumns({
        "cum_strategy": F.exp(F.sum(F.coalesce("strategy_return", F.lit(0.0))).over(frame)),
        "cum_buyhold": F.exp(F.sum(F.coalesce(buyhold_src, F.lit(0.0))).over(frame)),
    })


def hit_rate(table: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Trades taken and the share that won, in percent (0 and 0 if none)."""
    return table.groupBy(*keys).agg(
        F.count("trade_correct").alias("num_trades"),
        F.coalesce(F.avg("trade_correct") * 100.0, F.lit(0.0)).alias("hit_rate"),
    )


def latest(table: DataFrame, cols: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """newest row per series, one ``max_by`` over a struct (no second sort)."""
    s = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col("date")).alias("_last")
    return table.groupBy(*keys).agg(s).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in cols])


def ensemble_summary(table: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """J11 result: one row per ticker with the next-day call and trade stats."""
    agg = table.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("days"),
        F.count("trade_correct").alias("num_trades"),
        F.coalesce(F.avg("trade_correct") * 100.0, F.lit(0.0)).alias("hit_rate"),
        F.max_by(F.struct("date", "market_regime", "ensemble_prob_up",
                          "cum_strategy", "cum_buyhold"), F.col("date")).alias("_last"),
    )
    return agg.select(
        *keys, "days", "num_trades", "hit_rate",
        F.col("_last.date").alias("last_date"),
        F.col("_last.market_regime").alias("current_regime"),
        F.col("_last.ensemble_prob_up").alias("ensemble_prob_up"),
        R.recommendation("_last.market_regime", "_last.ensemble_prob_up").alias("recommendation"),
        F.col("_last.cum_strategy").alias("strategy_equity"),
        F.col("_last.cum_buyhold").alias("buy_hold_equity"),
    )


def drawdown_curve(table: DataFrame, equity: str = "cum_strategy", keys: Sequence[str] = KEYS) -> DataFrame:
    """Equity / running maximum - 1."""
    return table.withColumn("drawdown", F.col(equity) / F.max(equity).over(expanding(keys)) - 1.0)


# ---------------------------------------------------------------------------
# Regime-aware backtest
# ---------------------------------------------------------------------------

# Inner thresholds of the regime signal rules.
UP_FALLBACK, DOWN_FALLBACK, DOWNTREND_UP = 0.56, 0.44, 0.65
ARIMA_FLOOR = -0.05
MIN_CONFIDENCE = 0.20


def raw_signal(prob: str = "predicted_probability_up", arima: str = "arima_mean_forecast_percent",
               regime: str = "market_regime", vol: str = GARCH_COL, cutoff: str = "volatility_cutoff",
               upper: float = 0.55, lower: float = 0.45, threshold: float = 0.08) -> Column:
    """J13 before the trend filter: risk filters, then the uptrend and downtrend
    rule lists (ordered exactly as the source loop)."""
    p, a, rg = F.col(prob), F.col(arima), F.col(regime)
    up_rules = (F.when((p > upper) & (a > ARIMA_FLOOR), "UP").when((p < lower) & (a < 0), "DOWN")
                .when(p > UP_FALLBACK, "UP").when(p < DOWN_FALLBACK, "DOWN").otherwise("NO TRADE"))
    down_rules = (F.when((p < lower) & (a < 0), "DOWN").when((p > DOWNTREND_UP) & (a > ARIMA_FLOOR), "UP")
                  .when(p < DOWN_FALLBACK, "DOWN").when(p > UP_FALLBACK, "UP").otherwise("NO TRADE"))
    return (F.when(p.isNull() | a.isNull() | F.col(vol).isNull(), "NO TRADE")
            .when(rg == R.RISK_OFF, "NO TRADE")
            .when(F.col(vol) > F.col(cutoff), "NO TRADE")
            .when(F.abs(p - 0.5) < threshold, "NO TRADE")
            .when(rg == R.LOW_VOL_UP, up_rules)
            .when(rg == R.LOW_VOL_DOWN, down_rules)
            .otherwise("NO TRADE"))


def regime_signal(regime: str = "market_regime", **rules) -> Column:
    """The raw signal (options as there), but none against the trend."""
    decision, rg = raw_signal(regime=regime, **rules), F.col(regime)
    return (F.when((rg == R.LOW_VOL_UP) & (decision == "DOWN"), "NO TRADE")
            .when((rg == R.LOW_VOL_DOWN) & (decision == "UP"), "NO TRADE")
            .otherwise(decision))


def confidence_position(df: DataFrame, prob: str = "predicted_probability_up", signal: str = "_signal",
                        corrected: bool = False) -> DataFrame:
    """confidence = 2|p - 0.5|, size = min(2 * confidence, 1), negative for DOWN.

    As in the source, a confidence below 0.20 relabels the signal NO TRADE
    but keeps the (unsigned) size; ``corrected=True`` sets that size to 0.
    """
    conf = F.abs(F.col(prob) - 0.5) * 2
    traded = F.col(signal).isin("UP", "DOWN")
    label = F.when(traded & (conf < MIN_CONFIDENCE), "NO TRADE").otherwise(F.col(signal))
    size = F.least(conf * 2, F.lit(1.0))
    if corrected:
        size = F.when(conf < MIN_CONFIDENCE, F.lit(0.0)).otherwise(size)
    position = F.when(traded, F.when(label == "DOWN", -size).otherwise(size)).otherwise(F.lit(0.0))
    return df.withColumns({"regime_aware_signal": label, "position": position})


def regime_backtest_table(predictions: DataFrame, forecasts: DataFrame, market: DataFrame,
                          keys: Sequence[str] = KEYS, upper: float = 0.55, lower: float = 0.45,
                          threshold: float = 0.08, vol_quantile: float = 0.75,
                          corrected: bool = False) -> DataFrame:
    """J16 daily table.

    predictions: (keys, date, predicted_probability_up) on evaluation dates.
    forecasts:   (keys, date, arima_mean_forecast_percent).
    market:      (keys, date, log_return, garch col, market_regime, ...) on all dates.
    C4 and C5 are left joins on (ticker, date); the global volatility
    quantile (D2, looks ahead as in the source) is a per-ticker aggregate.
    ``corrected=True`` uses the expanding cutoff known on each date instead
    (Q5) and gives low-confidence relabelled signals no size (Q3).
    """
    w = series_window(keys)
    # the global quantile is a whole-partition window: computed once per
    # ticker in the same pass, no second branch over the market table
    mk = market.withColumns({
        "next_day_log_return": F.lead("log_return").over(w),
        "volatility_cutoff": (F.col("vol_cutoff") if corrected and "vol_cutoff" in market.columns
                              else F.percentile(GARCH_COL, vol_quantile).over(Window.partitionBy(*keys))),
    })
    regime_cols = [c for c in ("volatility_regime", "vix_regime", "trend_regime", "market_regime") if c in mk.columns]
    side = mk.select(*keys, "date", "next_day_log_return", GARCH_COL, *regime_cols, "volatility_cutoff")
    bt = (predictions.join(forecasts.select(*keys, "date", "arima_mean_forecast_percent"), [*keys, "date"], "left")
          .join(side, [*keys, "date"], "left"))
    bt = bt.withColumn("_signal", regime_signal(upper=upper, lower=lower, threshold=threshold))
    bt = confidence_position(bt, corrected=corrected).drop("_signal")
    bt = bt.withColumns({
        "strategy_log_return": F.col("position") * F.col("next_day_log_return"),
        "buy_hold_log_return": F.col("next_day_log_return"),
    })
    fr = expanding(keys)
    bt = bt.withColumns({
        "strategy_equity": F.exp(F.sum(F.coalesce("strategy_log_return", F.lit(0.0))).over(fr)),
        "buy_hold_equity": F.exp(F.sum(F.coalesce("buy_hold_log_return", F.lit(0.0))).over(fr)),
    })
    return bt.withColumn("drawdown", F.col("strategy_equity") / F.max("strategy_equity").over(fr) - 1.0)


def backtest_summary(bt: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per ticker with D3 and D12-D16 in a single aggregation."""
    pos, nxt = F.col("position"), F.col("next_day_log_return")
    traded = pos != 0
    correct = F.when(((pos > 0) & (nxt > 0)) | ((pos < 0) & (nxt < 0)), 1).otherwise(0)
    agg = bt.groupBy(*keys).agg(
        F.count_if(traded).alias("trade_count"),
        F.count(F.lit(1)).alias("_days"),
        F.avg(F.when(traded, correct)).alias("hit_rate_on_trades"),
        F.max_by("strategy_equity", "date").alias("_se"),
        F.max_by("buy_hold_equity", "date").alias("_be"),
        F.avg("strategy_log_return").alias("_m"),
        F.stddev_samp("strategy_log_return").alias("_s"),
        F.min("drawdown").alias("max_drawdown"),
        *[F.count_if(F.col("market_regime") == r).alias(f"{r}_days")
          for r in (R.RISK_OFF, R.LOW_VOL_UP, R.LOW_VOL_DOWN, R.NEUTRAL)],
    )
    return agg.select(
        *keys, "trade_count", (F.col("trade_count") / F.col("_days")).alias("trade_rate"),
        "hit_rate_on_trades", (F.col("_se") - 1.0).alias("strategy_total_return"),
        (F.col("_be") - 1.0).alias("buy_hold_total_return"),
        (F.try_divide(F.col("_m"), F.col("_s")) * F.sqrt(F.lit(252.0))).alias("annualized_sharpe"),
        "max_drawdown", *[f"{r}_days" for r in (R.RISK_OFF, R.LOW_VOL_UP, R.LOW_VOL_DOWN, R.NEUTRAL)])


def market_regimes(df: DataFrame, keys: Sequence[str] = KEYS, vix_level: float = 25.0,
                   vol_quantile: float = 0.75, min_periods: int = 252) -> DataFrame:
    """J5 (J1-J3 on the GARCH column): volatility, VIX and trend regimes and
    the combined regime; the cutoff is the expanding quantile carried forward
    over dates without a volatility value (C2)."""
    step = df.withColumns({
        "sma_20": rolling_mean("price", 20, keys),
        "sma_50": rolling_mean("price", 50, keys),
    })
    step = R.with_expanding_quantile(step, GARCH_COL, "vol_cutoff", vol_quantile, min_periods, keys)
    step = step.withColumn("vol_cutoff", F.last("vol_cutoff", ignorenulls=True).over(expanding(keys)))
    step = step.withColumns({
        "volatility_regime": R.volatility_regime(GARCH_COL, "vol_cutoff"),
        "vix_regime": R.vix_regime(step, vix_level),
        "trend_regime": R.trend_regime(),
    })
    return step.withColumn("market_regime", R.market_regime(vix="vix_regime"))
