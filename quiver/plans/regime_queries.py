"""Registered queries: GARCH-based regimes (J1-J5), the regime-aware
backtest (J12-J16) and its summary metrics (D12-D17).

The probability column of the regime backtest is the ensemble probability
(a deterministic, SQL-expressible score), so the whole chain has a DuckDB
twin; the classifier-driven variant lives in ``classifier_queries``.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quiver.functions.windows import series_window
from quiver.operators import backtest as B
from quiver.operators import recursions as RC
from quiver.plans.backtest_queries import ensemble_ctes
from quiver.plans.feature_queries import chrono_split
from quiver.plans.finish import finish
from quiver.plans.market_queries import processed, processed_ctes
from quiver.plans.model_queries import arma_sql_ctes, garch_sql_ctes, with_recursive
from quiver.plans.registry import register
from quiver.plans.sqltext import W, frame, guarded, returns_cte, rnd
from quiver.session import materialize
from quiver.sources.views import SQL_VIEWS, bars

G = B.GARCH_COL
# Level of the VIX regime on the synthetic fixture: its instrument closes are
# averages of line-item prices (tens of thousands), not index points.
FIXTURE_VIX_LEVEL = 40000.0


def _ret(spark, sf_dir):
    """Returns per ticker, materialised once: they feed several branches."""
    return materialize(B.prepare_returns(bars(spark, sf_dir)))


def regimes_frame(spark, sf_dir):
    """ret + GARCH features + J5 regimes (no VIX column on plain bars)."""
    return B.market_regimes(RC.garch_features(_ret(spark, sf_dir)))


def regime_sql_ctes(src: str = "gm", vix: str | None = None, level: float = FIXTURE_VIX_LEVEL) -> list[str]:
    """J5 twin over ``src`` (ticker, date, price, log_return, garch col[, vix_close]) -> ``mr``."""
    vix_expr = (f"CASE WHEN {vix} > {level} THEN 'high_vix' ELSE 'normal_vix' END" if vix
                else "'unknown_vix'")
    return [
        f"""mr0 AS (SELECT *,
    CASE WHEN count({G}) OVER {frame(None)} >= 252 THEN quantile_cont({G}, 0.75) OVER {frame(None)} END AS vc,
    {guarded('avg', 'price', 20)} AS sma_20, {guarded('avg', 'price', 50)} AS sma_50 FROM {src})""",
        f"mr1 AS (SELECT *, last_value(vc IGNORE NULLS) OVER {frame(None)} AS vol_cutoff FROM mr0)",
        f"""mr2 AS (SELECT *, CASE WHEN {G} > vol_cutoff THEN 'high_vol' ELSE 'low_vol' END AS volatility_regime,
    {vix_expr} AS vix_regime,
    CASE WHEN sma_20 > sma_50 THEN 'uptrend' ELSE 'downtrend' END AS trend_regime FROM mr1)""",
        """mr AS (SELECT *, CASE WHEN volatility_regime = 'high_vol' OR vix_regime = 'high_vix' THEN 'risk_off'
    WHEN volatility_regime = 'low_vol' AND trend_regime = 'uptrend' THEN 'low_vol_uptrend'
    WHEN volatility_regime = 'low_vol' AND trend_regime = 'downtrend' THEN 'low_vol_downtrend'
    ELSE 'neutral' END AS market_regime FROM mr2)""",
    ]


GM_CTE = f"""gm AS (SELECT r.ticker, r.date, r.price, r.log_return, v.{G}
  FROM ret r LEFT JOIN gvol v ON r.ticker = v.ticker AND r.date = v.date)"""


def _regime_base() -> list[str]:
    return [SQL_VIEWS["bars"], returns_cte("bars", "ret"), *garch_sql_ctes(base=False), GM_CTE, *regime_sql_ctes()]


@register("market_regime_garch", with_recursive(*_regime_base()) + f"""
SELECT ticker, date, volatility_regime, vix_regime, trend_regime, market_regime,
  {rnd([G, 'vol_cutoff'])} FROM mr""")
def q_market_regime_garch(spark, sf_dir):
    """J1/J3/J4 on the GARCH column: expanding 75 % cutoff carried forward, trend, combined regime."""
    return finish(regimes_frame(spark, sf_dir), ["ticker", "date", "volatility_regime", "vix_regime",
                                                 "trend_regime", "market_regime", G, "vol_cutoff"])


def _vix_frame(spark, sf_dir):
    p = processed(spark, sf_dir)
    return B.market_regimes(RC.garch_features(p), vix_level=FIXTURE_VIX_LEVEL)


def _vix_base() -> list[str]:
    pc = processed_ctes()
    return [SQL_VIEWS["bars"], SQL_VIEWS["instruments_long"], *pc,
            *garch_sql_ctes(src="processed", base=False),
            f"""gm AS (SELECT r.ticker, r.date, r.price, r.log_return, r.vix_close, v.{G}
  FROM processed r LEFT JOIN gvol v ON r.ticker = v.ticker AND r.date = v.date)""",
            *regime_sql_ctes(vix="vix_close")]


@register("vix_regime", with_recursive(*_vix_base()) + """
SELECT ticker, date, round(vix_close, 6) + 0.0 AS vix_close, vix_regime FROM mr""")
def q_vix_regime(spark, sf_dir):
    """high_vix above the level, else normal_vix (unknown_vix without the column)."""
    return finish(_vix_frame(spark, sf_dir), ["ticker", "date", "vix_close", "vix_regime"])


@register("market_regime_vix", with_recursive(*_vix_base()) + f"""
SELECT ticker, date, volatility_regime, vix_regime, trend_regime, market_regime, {rnd([G])} FROM mr""")
def q_market_regime_vix(spark, sf_dir):
    """GARCH, VIX and trend regimes on the processed table; high VIX is risk_off too."""
    return finish(_vix_frame(spark, sf_dir), ["ticker", "date", "volatility_regime", "vix_regime",
                                              "trend_regime", "market_regime", G])


# ---------------------------------------------------------------------------
# regime-aware backtest
# ---------------------------------------------------------------------------

def backtest_inputs(spark, sf_dir):
    ret = _ret(spark, sf_dir)
    ens = chrono_split(B.ensemble_table(ret))
    predictions = ens.filter(~F.col("is_train")).select(
        "ticker", "date", F.col("ensemble_prob_up").alias("predicted_probability_up"))
    forecasts = RC.rolling_forecast(ret)
    market = B.market_regimes(RC.garch_features(ret))
    return predictions, forecasts, market


def regime_table(spark, sf_dir, **kw):
    return B.regime_backtest_table(*backtest_inputs(spark, sf_dir), **kw)


SIGNAL_SQL = f"""CASE WHEN p IS NULL OR arima_mean_forecast_percent IS NULL OR {G} IS NULL THEN 'NO TRADE'
    WHEN market_regime = 'risk_off' THEN 'NO TRADE'
    WHEN {G} > volatility_cutoff THEN 'NO TRADE'
    WHEN abs(p - 0.5) < 0.08 THEN 'NO TRADE'
    WHEN market_regime = 'low_vol_uptrend' THEN (CASE
      WHEN p > 0.55 AND arima_mean_forecast_percent > -0.05 THEN 'UP'
      WHEN p < 0.45 AND arima_mean_forecast_percent < 0 THEN 'DOWN'
      WHEN p > 0.56 THEN 'UP' WHEN p < 0.44 THEN 'DOWN' ELSE 'NO TRADE' END)
    WHEN market_regime = 'low_vol_downtrend' THEN (CASE
      WHEN p < 0.45 AND arima_mean_forecast_percent < 0 THEN 'DOWN'
      WHEN p > 0.65 AND arima_mean_forecast_percent > -0.05 THEN 'UP'
      WHEN p < 0.44 THEN 'DOWN' WHEN p > 0.56 THEN 'UP' ELSE 'NO TRADE' END)
    ELSE 'NO TRADE' END"""


def backtest_sql_ctes() -> list[str]:
    return [
        SQL_VIEWS["bars"], returns_cte("bars", "ret"), *garch_sql_ctes(base=False), *arma_sql_ctes(base=False),
        *ensemble_ctes("bars", base=False), GM_CTE, *regime_sql_ctes(),
        f"mk AS (SELECT *, lead(log_return) OVER ({W}) AS next_day_log_return FROM mr)",
        f"vcut AS (SELECT ticker, quantile_cont({G}, 0.75) AS volatility_cutoff FROM mk GROUP BY ticker)",
        f"""pred AS (SELECT ticker, date, ensemble_prob_up AS predicted_probability_up FROM (
    SELECT *, row_number() OVER ({W}) AS rn, count(*) OVER (PARTITION BY ticker) AS n FROM ens) t
  WHERE NOT (rn <= floor(n * 0.8)))""",
        f"""bt0 AS (SELECT p.ticker, p.date, p.predicted_probability_up, p.predicted_probability_up AS p,
    f.arima_mean_forecast_percent, m.next_day_log_return, m.{G}, m.volatility_regime, m.vix_regime,
    m.trend_regime, m.market_regime, v.volatility_cutoff
  FROM pred p LEFT JOIN afc f ON p.ticker = f.ticker AND p.date = f.date
  LEFT JOIN mk m ON p.ticker = m.ticker AND p.date = m.date
  LEFT JOIN vcut v ON p.ticker = v.ticker)""",
        f"bt1 AS (SELECT *, {SIGNAL_SQL} AS d0 FROM bt0)",
        """bt2 AS (SELECT *, CASE WHEN market_regime = 'low_vol_uptrend' AND d0 = 'DOWN' THEN 'NO TRADE'
    WHEN market_regime = 'low_vol_downtrend' AND d0 = 'UP' THEN 'NO TRADE' ELSE d0 END AS sig,
    abs(p - 0.5) * 2 AS conf FROM bt1)""",
        """bt3 AS (SELECT *, CASE WHEN sig IN ('UP', 'DOWN') AND conf < 0.2 THEN 'NO TRADE' ELSE sig END
    AS regime_aware_signal FROM bt2)""",
        """bt4 AS (SELECT *, CASE WHEN sig IN ('UP', 'DOWN') THEN (CASE WHEN regime_aware_signal = 'DOWN'
    THEN -least(conf * 2, 1.0) ELSE least(conf * 2, 1.0) END) ELSE 0.0 END AS position FROM bt3)""",
        """bt5 AS (SELECT *, position * next_day_log_return AS strategy_log_return,
    next_day_log_return AS buy_hold_log_return FROM bt4)""",
        f"""bt6 AS (SELECT *, exp(sum(coalesce(strategy_log_return, 0.0)) OVER {frame(None)}) AS strategy_equity,
    exp(sum(coalesce(buy_hold_log_return, 0.0)) OVER {frame(None)}) AS buy_hold_equity FROM bt5)""",
        f"bt AS (SELECT *, strategy_equity / max(strategy_equity) OVER {frame(None)} - 1.0 AS drawdown FROM bt6)",
    ]


_BT_COLS = ["ticker", "date", "regime_aware_signal", "market_regime", "position", "strategy_log_return",
            "strategy_equity", "buy_hold_equity", "drawdown"]


@register("regime_backtest", with_recursive(*backtest_sql_ctes()) + f"""
SELECT ticker, date, regime_aware_signal, market_regime,
  {rnd(['position', 'strategy_log_return', 'strategy_equity', 'buy_hold_equity', 'drawdown'])} FROM bt""")
def q_regime_backtest(spark, sf_dir):
    """Predictions joined with forecasts (C4) and regimes (C5), signals, sizing, equity."""
    return finish(regime_table(spark, sf_dir), _BT_COLS)


@register("regime_signal", with_recursive(*backtest_sql_ctes()) + """
SELECT ticker, date, d0 AS raw_signal, sig AS trend_filtered_signal FROM bt""")
def q_regime_signal(spark, sf_dir):
    """Risk filters, regime rule lists and the trend consistency filter."""
    t = regime_table(spark, sf_dir)
    return finish(t.select("ticker", "date", B.raw_signal().alias("raw_signal"),
                           B.regime_signal().alias("trend_filtered_signal")))


@register("confidence_position", with_recursive(*backtest_sql_ctes()) + f"""
SELECT ticker, date, regime_aware_signal, {rnd(['conf', 'position'])} FROM bt""")
def q_confidence_position(spark, sf_dir):
    """Confidence, size and sign; low confidence relabels but keeps the size (as in the source)."""
    t = regime_table(spark, sf_dir).withColumn(
        "conf", F.abs(F.col("predicted_probability_up") - 0.5) * 2)
    return finish(t, ["ticker", "date", "regime_aware_signal", "conf", "position"])


@register("strategy_returns", with_recursive(*backtest_sql_ctes()) + f"""
SELECT ticker, date, {rnd(['strategy_log_return', 'buy_hold_log_return'])} FROM bt""")
def q_strategy_returns(spark, sf_dir):
    """Position x next-day return, and buy-and-hold = next-day return."""
    return finish(regime_table(spark, sf_dir), ["ticker", "date", "strategy_log_return", "buy_hold_log_return"])


_SUM_COLS = ["trade_rate", "hit_rate_on_trades", "strategy_total_return", "buy_hold_total_return",
             "annualized_sharpe", "max_drawdown"]
_SUMMARY_SQL = f"""SELECT ticker, CAST(trade_count AS BIGINT) AS trade_count, {rnd(_SUM_COLS)},
  CAST(risk_off_days AS BIGINT) AS risk_off_days, CAST(low_vol_uptrend_days AS BIGINT) AS low_vol_uptrend_days,
  CAST(low_vol_downtrend_days AS BIGINT) AS low_vol_downtrend_days, CAST(neutral_days AS BIGINT) AS neutral_days
FROM (
  SELECT ticker, count_if(position <> 0) AS trade_count, count_if(position <> 0) / count(*) AS trade_rate,
    avg(CASE WHEN position <> 0 THEN (CASE WHEN (position > 0 AND next_day_log_return > 0)
        OR (position < 0 AND next_day_log_return < 0) THEN 1 ELSE 0 END) END) AS hit_rate_on_trades,
    arg_max(strategy_equity, date) - 1.0 AS strategy_total_return,
    arg_max(buy_hold_equity, date) - 1.0 AS buy_hold_total_return,
    CASE WHEN stddev_samp(strategy_log_return) <> 0
      THEN avg(strategy_log_return) / stddev_samp(strategy_log_return) END * sqrt(252.0) AS annualized_sharpe,
    min(drawdown) AS max_drawdown,
    count_if(market_regime = 'risk_off') AS risk_off_days,
    count_if(market_regime = 'low_vol_uptrend') AS low_vol_uptrend_days,
    count_if(market_regime = 'low_vol_downtrend') AS low_vol_downtrend_days,
    count_if(market_regime = 'neutral') AS neutral_days
  FROM bt GROUP BY ticker) s"""


@register("backtest_summary", with_recursive(*backtest_sql_ctes()) + _SUMMARY_SQL)
def q_backtest_summary(spark, sf_dir):
    """D17 (with D3, D12-D16): one summary row per ticker of the regime-aware backtest."""
    return finish(B.backtest_summary(regime_table(spark, sf_dir)))


def _summary_part(key: str, cols: list[str], doc: str):
    sel = ", ".join(cols)

    @register(key, with_recursive(*backtest_sql_ctes()) + f"SELECT ticker, {sel} FROM ({_SUMMARY_SQL}) x")
    def build(spark, sf_dir):
        return finish(B.backtest_summary(regime_table(spark, sf_dir)), ["ticker", *cols])
    build.__doc__ = doc
    return build


_summary_part("direction_hit_rate", ["trade_count", "hit_rate_on_trades"],
              "D12: share of long trades with a rise plus short trades with a fall.")
_summary_part("sharpe", ["annualized_sharpe"], "D13: mean / sample std x sqrt(252); NULL when std is 0.")
_summary_part("total_return", ["strategy_total_return", "buy_hold_total_return"],
              "D14: last equity - 1 for strategy and buy-and-hold.")
_summary_part("max_drawdown", ["max_drawdown"], "D15: minimum of equity / running max - 1.")
_summary_part("trade_rate", ["trade_rate"], "D16: trades / days.")


@register("trade_recommendation", with_recursive(*_regime_base(), *ensemble_ctes("bars", base=False)) + f"""
SELECT g.ticker, round(e.p, 6) + 0.0 AS probability,
  CASE WHEN g.cur > g.q THEN 'NO TRADE' WHEN e.p > 0.53 THEN 'TRADE (UP)'
       WHEN e.p < 0.47 THEN 'TRADE (DOWN)' ELSE 'NO TRADE' END AS trade_recommendation
FROM (SELECT ticker, quantile_cont({G}, 0.75) AS q, arg_max({G}, date) AS cur FROM gm GROUP BY ticker) g
JOIN (SELECT ticker, arg_max(ensemble_prob_up, date) AS p FROM ens GROUP BY ticker) e ON g.ticker = e.ticker""")
def q_trade_recommendation(spark, sf_dir):
    """Volatility above its global 75 % quantile -> NO TRADE; p > 0.53 UP; p < 0.47 DOWN."""
    ret = _ret(spark, sf_dir)
    g = RC.garch_features(ret).groupBy("ticker").agg(
        F.percentile(G, 0.75).alias("q"), F.max_by(G, "date").alias("cur"))
    e = B.ensemble_table(ret).groupBy("ticker").agg(F.max_by("ensemble_prob_up", "date").alias("probability"))
    j = g.join(e, "ticker")
    rec = (F.when(F.col("cur") > F.col("q"), "NO TRADE").when(F.col("probability") > 0.53, "TRADE (UP)")
           .when(F.col("probability") < 0.47, "TRADE (DOWN)").otherwise("NO TRADE"))
    return finish(j.select("ticker", "probability", rec.alias("trade_recommendation")))


@register("align_forecasts", with_recursive(SQL_VIEWS["bars"], returns_cte("bars", "ret"),
                                            *arma_sql_ctes(base=False)) + """
SELECT e.ticker, e.date, round(e.log_return, 6) + 0.0 AS log_return,
       round(a.arima_mean_forecast_percent, 6) + 0.0 AS arima_forecast_pct
FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS back FROM ret) e
LEFT JOIN afc a ON e.ticker = a.ticker AND e.date = a.date WHERE e.back <= 30""")
def q_align_forecasts(spark, sf_dir):
    """Forecasts attached to the evaluation dates (last 30 per ticker) by (ticker, date)."""
    ret = _ret(spark, sf_dir)
    last = Window.partitionBy("ticker").orderBy(F.col("date").desc())
    ev = ret.withColumn("_b", F.row_number().over(last)).filter("_b <= 30").select("ticker", "date", "log_return")
    fc = RC.rolling_forecast(ret).select("ticker", "date", F.col("arima_mean_forecast_percent").alias("arima_forecast_pct"))
    return finish(ev.join(fc, ["ticker", "date"], "left"))


@register("join_forecasts", with_recursive(*backtest_sql_ctes()) + """
SELECT ticker, date, round(predicted_probability_up, 6) + 0.0 AS predicted_probability_up,
       round(arima_mean_forecast_percent, 6) + 0.0 AS arima_mean_forecast_percent FROM bt0""")
def q_join_forecasts(spark, sf_dir):
    """C4: classifier-side predictions LEFT JOIN forecasts on (ticker, date)."""
    pred, fc, _ = backtest_inputs(spark, sf_dir)
    j = pred.join(fc.select("ticker", "date", "arima_mean_forecast_percent"), ["ticker", "date"], "left")
    return finish(j, ["ticker", "date", "predicted_probability_up", "arima_mean_forecast_percent"])


@register("join_regimes", with_recursive(*backtest_sql_ctes()) + f"""
SELECT ticker, date, volatility_regime, vix_regime, trend_regime, market_regime,
       {rnd(['next_day_log_return', G])} FROM bt0""")
def q_join_regimes(spark, sf_dir):
    """Predictions LEFT JOIN next-day return, volatility and regime labels (pruned columns)."""
    pred, _, market = backtest_inputs(spark, sf_dir)
    mk = market.withColumn("next_day_log_return", F.lead("log_return").over(series_window()))
    side = mk.select("ticker", "date", "next_day_log_return", G, "volatility_regime", "vix_regime",
                     "trend_regime", "market_regime")
    return finish(pred.join(side, ["ticker", "date"], "left"),
                  ["ticker", "date", "volatility_regime", "vix_regime", "trend_regime", "market_regime",
                   "next_day_log_return", G])
