"""Registered queries: regimes, ensemble signals and the ensemble backtest."""

from __future__ import annotations

from pyspark.sql import functions as F

from quiver.operators import backtest as B
from quiver.plans.finish import finish
from quiver.plans.registry import register
from quiver.plans.sqltext import W, frame, guarded, guarded_expanding, returns_cte, rnd
from quiver.sources.views import bars, sql_with


def ensemble_ctes(src: str = "bars", base: bool = True) -> list[str]:
    """The ensemble backtest chain as DuckDB CTEs ending in ``ens``."""
    return ([returns_cte(src, "ret")] if base else []) + [
        f"""f1 AS (SELECT *,
    {guarded('avg', 'log_return', 5)} AS rolling_mean_5,
    {guarded('stddev_samp', 'log_return', 20)} AS rolling_std_20,
    {guarded('sum', 'log_return', 10)} AS momentum_10,
    {guarded('avg', 'price', 20)} AS sma_20,
    {guarded('avg', 'price', 50)} AS sma_50,
    lead(log_return) OVER ({W}) AS next_day_return
  FROM ret)""",
        f"""f2 AS (SELECT *, rolling_std_20 AS vol,
    {guarded_expanding('quantile_cont(rolling_std_20, 0.75)', 'rolling_std_20', 252)} AS vol_cutoff
  FROM f1)""",
        """f3 AS (SELECT *,
    CASE WHEN vol > vol_cutoff THEN 'high_vol' ELSE 'low_vol' END AS volatility_regime,
    CASE WHEN sma_20 > sma_50 THEN 'uptrend' ELSE 'downtrend' END AS trend_regime,
    CAST(sign(rolling_mean_5) AS DOUBLE)
      + (CASE WHEN rolling_std_20 < vol_cutoff THEN 1.0 ELSE -1.0 END)
      + CAST(sign(momentum_10) AS DOUBLE) AS ensemble_score
  FROM f2)""",
        """f4 AS (SELECT *,
    CASE WHEN volatility_regime = 'high_vol' THEN 'risk_off'
         WHEN volatility_regime = 'low_vol' AND trend_regime = 'uptrend' THEN 'low_vol_uptrend'
         WHEN volatility_regime = 'low_vol' AND trend_regime = 'downtrend' THEN 'low_vol_downtrend'
         ELSE 'neutral' END AS market_regime,
    CASE WHEN ensemble_score IS NOT NULL
         THEN greatest(least(0.5 + ensemble_score * 0.15, 0.9), 0.1) END AS ensemble_prob_up
  FROM f3)""",
        """f5 AS (SELECT *,
    CASE WHEN market_regime = 'low_vol_uptrend' AND ensemble_prob_up > 0.55 THEN 1 ELSE 0 END AS position
  FROM f4)""",
        """f6 AS (SELECT *,
    CASE WHEN position = 1 AND next_day_return > 0 THEN 1
         WHEN position = 1 AND next_day_return <= 0 THEN 0 END AS trade_correct,
    position * log_return AS strategy_return
  FROM f5)""",
        f"""ens AS (SELECT *,
    exp(sum(coalesce(strategy_return, 0.0)) OVER {frame(None)}) AS cum_strategy,
    exp(sum(coalesce(log_return, 0.0)) OVER {frame(None)}) AS cum_buyhold
  FROM f6)""",
    ]


RECOMMENDATION_SQL = """CASE WHEN current_regime = 'risk_off' THEN 'NO TRADE (Risk-Off Regime)'
         WHEN current_regime = 'low_vol_uptrend' AND ensemble_prob_up > 0.55 THEN 'BUY - STRONG UP'
         WHEN ensemble_prob_up > 0.55 THEN 'BUY'
         WHEN ensemble_prob_up < 0.45 THEN 'SELL / SHORT'
         ELSE 'NO TRADE (Neutral)' END"""

LAST_CTE = """last AS (
  SELECT ticker, count(*) AS days, count(trade_correct) AS num_trades,
         coalesce(avg(trade_correct) * 100.0, 0.0) AS hit_rate,
         max(date) AS last_date,
         arg_max(market_regime, date) AS current_regime,
         arg_max(ensemble_prob_up, date) AS ensemble_prob_up,
         arg_max(cum_strategy, date) AS strategy_equity,
         arg_max(cum_buyhold, date) AS buy_hold_equity
  FROM ens GROUP BY ticker)"""


def _ens_sql(select: str) -> str:
    return sql_with("bars", extra=ensemble_ctes("bars")) + select


def _table(spark, sf_dir):
    return B.ensemble_table(B.prepare_returns(bars(spark, sf_dir)))


def _daily(key: str, cols: list[str], doubles: list[str]):
    sql = _ens_sql(
        f"SELECT {', '.join(c for c in cols if c not in doubles)}"
        + (", " + rnd(doubles) if doubles else "") + " FROM ens")

    @register(key, sql)
    def build(spark, sf_dir):
        return finish(_table(spark, sf_dir), cols)
    build.__doc__ = f"{key}: daily columns {cols} of the ensemble backtest on bars."
    return build


_daily("expanding_quantile", ["ticker", "date", "rolling_std_20", "vol_cutoff"],
       ["rolling_std_20", "vol_cutoff"])
_daily("volatility_regime", ["ticker", "date", "vol", "vol_cutoff", "volatility_regime"],
       ["vol", "vol_cutoff"])
_daily("trend_regime", ["ticker", "date", "sma_20", "sma_50", "trend_regime"], ["sma_20", "sma_50"])
_daily("market_regime", ["ticker", "date", "volatility_regime", "trend_regime", "market_regime"], [])
_daily("ensemble_score", ["ticker", "date", "rolling_mean_5", "momentum_10", "ensemble_score"],
       ["rolling_mean_5", "momentum_10", "ensemble_score"])
_daily("ensemble_probability", ["ticker", "date", "ensemble_score", "ensemble_prob_up"],
       ["ensemble_score", "ensemble_prob_up"])
_daily("long_only_position", ["ticker", "date", "market_regime", "ensemble_prob_up", "position"],
       ["ensemble_prob_up"])
_daily("trade_outcome", ["ticker", "date", "position", "next_day_return", "trade_correct"],
       ["next_day_return"])
_daily("next_day_return", ["ticker", "date", "log_return", "next_day_return"],
       ["log_return", "next_day_return"])
_daily("equity_curves", ["ticker", "date", "strategy_return", "cum_strategy", "cum_buyhold"],
       ["strategy_return", "cum_strategy", "cum_buyhold"])


@register("drawdown_curve", _ens_sql(
    f"SELECT ticker, date, {rnd(['cum_strategy', 'drawdown'])} FROM ("
    f"SELECT ticker, date, cum_strategy, cum_strategy / max(cum_strategy) OVER {frame(None)} - 1.0 AS drawdown "
    "FROM ens) d"))
def q_drawdown_curve(spark, sf_dir):
    """Strategy equity over its running maximum, minus one."""
    return finish(B.drawdown_curve(_table(spark, sf_dir)), ["ticker", "date", "cum_strategy", "drawdown"])


@register("hit_rate", _ens_sql(
    "SELECT ticker, count(trade_correct) AS num_trades, "
    "round(coalesce(avg(trade_correct) * 100.0, 0.0), 6) + 0.0 AS hit_rate FROM ens GROUP BY ticker"))
def q_hit_rate(spark, sf_dir):
    """Trades taken and hit rate in percent per ticker."""
    return finish(B.hit_rate(_table(spark, sf_dir)))


_SUMMARY_COLS = ["ticker", "days", "num_trades", "hit_rate", "last_date", "current_regime",
                 "ensemble_prob_up", "recommendation", "strategy_equity", "buy_hold_equity"]


@register("ensemble_backtest", sql_with("bars", extra=ensemble_ctes("bars") + [LAST_CTE]) + f"""
SELECT ticker, days, num_trades, last_date, current_regime,
       {RECOMMENDATION_SQL} AS recommendation,
       {rnd(['hit_rate', 'ensemble_prob_up', 'strategy_equity', 'buy_hold_equity'])}
FROM last""")
def q_ensemble_backtest(spark, sf_dir):
    """The ensemble regime backtest end to end, one summary row per ticker."""
    return finish(B.ensemble_summary(_table(spark, sf_dir)), _SUMMARY_COLS)


@register("recommendation", sql_with("bars", extra=ensemble_ctes("bars") + [LAST_CTE]) + f"""
SELECT ticker, last_date, current_regime, round(ensemble_prob_up, 6) + 0.0 AS ensemble_prob_up,
       {RECOMMENDATION_SQL} AS recommendation
FROM last""")
def q_recommendation(spark, sf_dir):
    """Next-day recommendation from the newest row of every ticker."""
    s = B.ensemble_summary(_table(spark, sf_dir))
    return finish(s, ["ticker", "last_date", "current_regime", "ensemble_prob_up", "recommendation"])


@register("latest_row", sql_with("bars", extra=ensemble_ctes("bars")) + """
SELECT ticker, max(date) AS date, round(arg_max(price, date), 6) + 0.0 AS price,
       round(arg_max(log_return, date), 6) + 0.0 AS log_return,
       arg_max(market_regime, date) AS market_regime
FROM ens GROUP BY ticker""")
def q_latest_row(spark, sf_dir):
    """the newest row per ticker via max_by over a struct."""
    t = _table(spark, sf_dir)
    return finish(B.latest(t, ["date", "price", "log_return", "market_regime"]))


def reports_from_summary(summary, generated_on: str):
    """A12 + A13 text reports, one row per ticker."""
    pred = F.concat(
        F.lit("=== NEXT DAY ENSEMBLE PREDICTION ===\nCurrent Regime       : "), F.col("current_regime"),
        F.lit("\nEnsemble Prob UP     : "), F.format_string("%.4f", F.round("ensemble_prob_up", 4)),
        F.lit("\nRecommendation       : "), F.col("recommendation"), F.lit("\n"))
    perf = F.concat(
        F.lit("=== TRADE PERFORMANCE SUMMARY ===\nTotal Trades Taken          : "),
        F.col("num_trades").cast("string"),
        F.lit("\nHit Rate (Accuracy)         : "), F.format_string("%.1f", F.round("hit_rate", 1)),
        F.lit("%\nStatus                      : "),
        F.when(F.col("hit_rate") >= 55.0, "ACHIEVED").otherwise("NOT ACHIEVED"),
        F.lit("\nGenerated on: "), F.lit(generated_on), F.lit("\n"))
    return summary.select("ticker", pred.alias("prediction_report"), perf.alias("performance_report"))


REPORT_STAMP = "2026-01-01 00:00"


@register("prediction_report", sql_with("bars", extra=ensemble_ctes("bars") + [LAST_CTE]) + f"""
SELECT ticker,
  '=== NEXT DAY ENSEMBLE PREDICTION ===' || chr(10) || 'Current Regime       : ' || current_regime
  || chr(10) || 'Ensemble Prob UP     : ' || printf('%.4f', round(ensemble_prob_up, 4))
  || chr(10) || 'Recommendation       : ' || ({RECOMMENDATION_SQL}) || chr(10) AS prediction_report
FROM last""")
def q_prediction_report(spark, sf_dir):
    """Next-day recommendation as text with a 4-decimal probability."""
    return reports_from_summary(B.ensemble_summary(_table(spark, sf_dir)), REPORT_STAMP) \
        .select("ticker", "prediction_report")


@register("performance_report", sql_with("bars", extra=ensemble_ctes("bars") + [LAST_CTE]) + f"""
SELECT ticker,
  '=== TRADE PERFORMANCE SUMMARY ===' || chr(10) || 'Total Trades Taken          : ' || CAST(num_trades AS VARCHAR)
  || chr(10) || 'Hit Rate (Accuracy)         : ' || printf('%.1f', round(hit_rate, 1)) || '%'
  || chr(10) || 'Status                      : ' || (CASE WHEN hit_rate >= 55.0 THEN 'ACHIEVED' ELSE 'NOT ACHIEVED' END)
  || chr(10) || 'Generated on: {REPORT_STAMP}' || chr(10) AS performance_report
FROM last""")
def q_performance_report(spark, sf_dir):
    """Trades, hit rate to one decimal and the 55 % status line."""
    return reports_from_summary(B.ensemble_summary(_table(spark, sf_dir)), REPORT_STAMP) \
        .select("ticker", "performance_report")

