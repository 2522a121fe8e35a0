"""Registered queries: end-to-end jobs, general forecast orders, the bar stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from quiver.operators import backtest as B
from quiver.operators import recursions as RC
from quiver.plans import jobs as J
from quiver.plans.finish import finish
from quiver.plans.io_queries import scratch, write_price_files
from quiver.plans.backtest_queries import LAST_CTE, RECOMMENDATION_SQL, ensemble_ctes
from quiver.plans.model_queries import arma_sql_ctes, garch_sql_ctes, with_recursive
from quiver.plans.sqltext import returns_cte, rnd
from quiver.plans.registry import register
from quiver.session import materialize
from quiver.plans.regime_queries import FIXTURE_VIX_LEVEL
from quiver.sources.views import SQL_VIEWS, bars, bars_wide, instruments_long, sql_with, table
from quiver.streaming.bars_stream import read_bars, run_bars_stream


@register("predict_job", with_recursive(*arma_sql_ctes()) + """,
pj0 AS (SELECT r.ticker, r.date, r.log_return, a.arima_mean_forecast_percent AS f,
    row_number() OVER (PARTITION BY r.ticker ORDER BY r.date DESC) AS back,
    lead(r.log_return) OVER (PARTITION BY r.ticker ORDER BY r.date) AS nxt
  FROM ret r LEFT JOIN afc a ON r.ticker = a.ticker AND r.date = a.date),
pj AS (SELECT ticker, date, f, (CASE WHEN f > 0 THEN 'UP' ELSE 'DOWN' END)
    = (CASE WHEN nxt > 0 THEN 'UP' ELSE 'DOWN' END) AS correct FROM pj0 WHERE back <= 30)
SELECT ticker, round(avg(CAST(correct AS INTEGER)), 6) + 0.0 AS accuracy,
  round(arg_max(f, date), 6) + 0.0 AS next_day_forecast,
  CASE WHEN arg_max(f, date) > 0 THEN 'UP' ELSE 'DOWN' END AS next_day_direction
FROM pj GROUP BY ticker""".replace("\n,\npj0", ",\npj0"))
def q_predict_job(spark, sf_dir):
    """Price files -> returns -> rolling forecasts on the last 30 dates -> directions,
    correctness, written predictions; accuracy and next-day call per ticker."""
    src = write_price_files(bars(spark, sf_dir), scratch(spark, "predict-in"))
    return finish(J.predict_job(spark, src, scratch(spark, "predict-out")))


@register("forecast_orders")
def q_forecast_orders(spark, sf_dir):
    """Rolling ARMA(2,0,2) forecasts by two-stage regression at every cutoff."""
    return finish(RC.forecast_orders(B.prepare_returns(bars(spark, sf_dir)), (2, 0, 2)))


@register("baseline_report")
def q_baseline_report(spark, sf_dir):
    """Summary statistics, ADF/KPSS, naive and rolling-forecast metrics as long rows."""
    return finish(J.baseline_report(materialize(B.prepare_returns(bars(spark, sf_dir)))))


@register("full_pipeline")
def q_full_pipeline(spark, sf_dir):
    """The notebook pipeline end to end with every stage written as Parquet."""
    return finish(J.full_pipeline(spark, bars(spark, sf_dir), instruments_long(spark, sf_dir), scratch(spark, "pipeline"),
                                  vix_level=FIXTURE_VIX_LEVEL))


@register("ohlcv_bars_stream", sql_with("ticks") + """
SELECT ticker, date_trunc('hour', ts) AS hour, round(arg_min(value, ts), 6) + 0.0 AS open,
  round(max(value), 6) + 0.0 AS high, round(min(value), 6) + 0.0 AS low,
  round(arg_max(value, ts), 6) + 0.0 AS close, count(*) AS volume
FROM ticks GROUP BY 1, 2""")
def q_ohlcv_bars_stream(spark, sf_dir):
    """A4 as a stream: partial bars per micro-batch (availableNow trigger), merged when they are read."""
    schema = table(spark, sf_dir, "events").schema
    out = run_bars_stream(spark, sf_dir, schema, scratch(spark, "bars-stream"), file_glob="events.parquet")
    return finish(read_bars(spark, out).withColumn("volume", F.col("volume").cast("long")))


# ---------------------------------------------------------------------------
# the flagship backtest and the grid estimators on the 125-series fixture
# ---------------------------------------------------------------------------

def _wide_ret(spark, sf_dir):
    return B.prepare_returns(bars_wide(spark, sf_dir))


_WIDE_BASE = [SQL_VIEWS["bars_wide"], returns_cte("bars_wide", "ret")]


@register("ensemble_backtest_wide", "WITH " + ",\n".join(
    [SQL_VIEWS["bars_wide"], *ensemble_ctes("bars_wide"), LAST_CTE]) + f"""
SELECT ticker, days, num_trades, last_date, current_regime,
       {RECOMMENDATION_SQL} AS recommendation,
       {rnd(['hit_rate', 'ensemble_prob_up', 'strategy_equity', 'buy_hold_equity'])}
FROM last""")
def q_ensemble_backtest_wide(spark, sf_dir):
    """J11 on the 125-series fixture (segment x nation): one summary row per series."""
    t = B.ensemble_table(B.prepare_returns(bars_wide(spark, sf_dir)))
    return finish(B.ensemble_summary(t), ["ticker", "days", "num_trades", "hit_rate", "last_date",
                                          "current_regime", "ensemble_prob_up", "recommendation",
                                          "strategy_equity", "buy_hold_equity"])


@register("garch_volatility_wide", with_recursive(*_WIDE_BASE, *garch_sql_ctes(base=False)) + """
SELECT ticker, date, round(garch_conditional_volatility, 6) + 0.0 AS garch_conditional_volatility FROM gvol""")
def q_garch_volatility_wide(spark, sf_dir):
    """I13 on the 125-series fixture (series shorter than the 500-return window stay NULL)."""
    return finish(RC.garch_volatility(_wide_ret(spark, sf_dir)),
                  ["ticker", "date", "garch_conditional_volatility"])


@register("rolling_forecast_wide", with_recursive(*_WIDE_BASE, *arma_sql_ctes(base=False)) + """
SELECT ticker, date, round(arima_mean_forecast_percent, 6) + 0.0 AS arima_mean_forecast_percent FROM afc""")
def q_rolling_forecast_wide(spark, sf_dir):
    """I6 on the 125-series fixture: ARMA(1,1) grid forecasts for every cutoff of every series."""
    return finish(RC.rolling_forecast(_wide_ret(spark, sf_dir)),
                  ["ticker", "date", "arima_mean_forecast_percent"])
