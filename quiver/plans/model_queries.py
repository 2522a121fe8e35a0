"""Registered queries: evaluation reports, forecast and volatility grids.

The DuckDB twins of the grid estimators are recursive CTEs that run the same
recursion step by step; they share the point ids, the rounding used for
ranking and the tie rule (lower point id wins).
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quiver.functions.windows import series_window
from quiver.operators import backtest as B
from quiver.operators import evaluation as EV
from quiver.operators import recursions as RC
from quiver.plans.backtest_queries import ensemble_ctes
from quiver.plans.finish import finish
from quiver.plans.registry import register
from quiver.plans.sqltext import W, frame, returns_cte, rnd
from quiver.session import materialize
from quiver.sources.views import SQL_VIEWS, bars

# ---------------------------------------------------------------------------
# shared inputs
# ---------------------------------------------------------------------------


def _ret(spark, sf_dir):
    return B.prepare_returns(bars(spark, sf_dir))


def _ret_shared(spark, sf_dir):
    """Returns materialised once for plans that read them in several branches."""
    return materialize(_ret(spark, sf_dir))


def with_recursive(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def naive_pairs(ret):
    """I11 input: y = next-day up (last row 0, as in the source), yhat = today up."""
    w = series_window()
    return ret.select("ticker", "date",
                      F.coalesce(F.lead("log_return").over(w) > 0, F.lit(False)).cast("int").alias("y"),
                      (F.col("log_return") > 0).cast("int").alias("yhat"))


NAIVE_CTE = f"""np AS (SELECT ticker, date,
    CAST(coalesce(lead(log_return) OVER ({W}) > 0, false) AS INTEGER) AS y,
    CAST(log_return > 0 AS INTEGER) AS yhat FROM ret)"""


def clf_sql(src: str, keys: str = "ticker") -> str:
    """Weighted classification report over (keys, y, yhat) rows in ``src``."""
    return f"""cm AS (SELECT {keys}, y, yhat, count(*) AS n FROM {src} GROUP BY {keys}, y, yhat),
pc0 AS (SELECT {keys}, label, sum(s) AS support, sum(pc) AS predicted, sum(tp) AS tp FROM (
    SELECT {keys}, y AS label, n AS s, 0 AS pc, CASE WHEN y = yhat THEN n ELSE 0 END AS tp FROM cm
    UNION ALL SELECT {keys}, yhat AS label, 0 AS s, n AS pc, 0 AS tp FROM cm) u GROUP BY {keys}, label),
pc1 AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
    CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM pc0),
pc AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
    ELSE 0.0 END AS f1 FROM pc1),
clf AS (SELECT {keys}, sum(tp) / sum(support) AS accuracy,
    sum(precision * support) / sum(support) AS precision,
    sum(recall * support) / sum(support) AS recall, sum(f1 * support) / sum(support) AS f1
  FROM pc GROUP BY {keys})"""


def reg_sql(src: str, keys: str = "ticker") -> str:
    return f"""reg0 AS (SELECT {keys}, avg(abs(yhat - y)) AS mae, avg((yhat - y) * (yhat - y)) AS mse,
    sum((yhat - y) * (yhat - y)) AS sse, var_pop(y) * count(y) AS sst FROM {src} GROUP BY {keys}),
reg AS (SELECT {keys}, mae, mse, sqrt(mse) AS rmse,
    CASE WHEN sst = 0 THEN (CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END) ELSE 1.0 - sse / sst END AS r2 FROM reg0)"""


_CLF = ["accuracy", "precision", "recall", "f1"]
_REG = ["mae", "mse", "rmse", "r2"]


def _base(*extra: str) -> str:
    return "WITH " + ",\n".join([SQL_VIEWS["bars"], returns_cte("bars", "ret"), *extra]) + "\n"


# ---------------------------------------------------------------------------
# evaluation over naive momentum (I11) and the ensemble probability
# ---------------------------------------------------------------------------

@register("naive_momentum", _base(NAIVE_CTE, clf_sql("np")) + f"SELECT ticker, {rnd(_CLF)} FROM clf")
def q_naive_momentum(spark, sf_dir):
    """tomorrow's direction = today's; weighted classification report per ticker."""
    return finish(EV.classification_report(naive_pairs(_ret(spark, sf_dir))))


_ENS_PAIRS = """ep AS (SELECT ticker, date, CAST(next_day_return > 0 AS INTEGER) AS y,
    CAST(ensemble_prob_up >= 0.55 AS INTEGER) AS yhat, ensemble_prob_up AS p
  FROM ens WHERE next_day_return IS NOT NULL AND ensemble_prob_up IS NOT NULL)"""


def _ens_pairs(spark, sf_dir):
    t = B.ensemble_table(_ret(spark, sf_dir))
    return (t.filter(F.col("next_day_return").isNotNull() & F.col("ensemble_prob_up").isNotNull())
            .select("ticker", "date", (F.col("next_day_return") > 0).cast("int").alias("y"),
                    (F.col("ensemble_prob_up") >= 0.55).cast("int").alias("yhat"),
                    F.col("ensemble_prob_up").alias("p")))


def _ens_sql(*extra: str) -> str:
    return "WITH " + ",\n".join([SQL_VIEWS["bars"], *ensemble_ctes("bars"), _ENS_PAIRS, *extra]) + "\n"


@register("classification_report", _ens_sql(clf_sql("ep")) + f"SELECT ticker, {rnd(_CLF)} FROM clf")
def q_classification_report(spark, sf_dir):
    """Accuracy, weighted precision/recall/F1 of the thresholded ensemble probability."""
    return finish(EV.classification_report(_ens_pairs(spark, sf_dir)))


@register("per_class_report", _base(NAIVE_CTE, clf_sql("np")) + f"""
SELECT ticker, CAST(label AS VARCHAR) AS label, {rnd(['precision', 'recall', 'f1'])}, CAST(support AS BIGINT) AS support
FROM pc WHERE support + predicted > 0
UNION ALL SELECT ticker, 'macro avg', {rnd(['p', 'r', 'f'])}, CAST(s AS BIGINT) FROM (
  SELECT ticker, avg(precision) AS p, avg(recall) AS r, avg(f1) AS f, sum(support) AS s
  FROM pc WHERE support + predicted > 0 GROUP BY ticker) m
UNION ALL SELECT ticker, 'weighted avg', {rnd(['p', 'r', 'f'])}, CAST(s AS BIGINT) FROM (
  SELECT ticker, sum(precision * support) / sum(support) AS p, sum(recall * support) / sum(support) AS r,
         sum(f1 * support) / sum(support) AS f, sum(support) AS s
  FROM pc WHERE support + predicted > 0 GROUP BY ticker) wt""")
def q_per_class_report(spark, sf_dir):
    """Per-class precision, recall, F1 and support plus macro and weighted rows."""
    return finish(EV.per_class_report(naive_pairs(_ret(spark, sf_dir))))


@register("confusion_matrix", _base(NAIVE_CTE) + """,
cm AS (SELECT ticker, y, yhat, count(*) AS n FROM np GROUP BY ALL),
lab AS (SELECT DISTINCT ticker, y AS label FROM cm UNION SELECT DISTINCT ticker, yhat FROM cm)
SELECT a.ticker, a.label AS y, b.label AS yhat, CAST(coalesce(cm.n, 0) AS BIGINT) AS count
FROM lab a JOIN lab b ON a.ticker = b.ticker
LEFT JOIN cm ON cm.ticker = a.ticker AND cm.y = a.label AND cm.yhat = b.label""".replace(
    "\n,\ncm AS", ",\ncm AS"))
def q_confusion_matrix(spark, sf_dir):
    """Counts per (true, predicted) label pair, empty cells as 0."""
    return finish(EV.confusion_matrix(naive_pairs(_ret(spark, sf_dir))))


@register("roc_auc", _ens_sql() + """,
rk AS (SELECT ticker, y, rank() OVER (PARTITION BY ticker ORDER BY p)
         + (count(*) OVER (PARTITION BY ticker, p) - 1) / 2.0 AS r FROM ep),
ag AS (SELECT ticker, sum(CASE WHEN y = 1 THEN r END) AS rs, count_if(y = 1) AS np_, count_if(y = 0) AS nn
       FROM rk GROUP BY ticker)
SELECT ticker, round(CASE WHEN np_ > 0 AND nn > 0 THEN (rs - np_ * (np_ + 1) / 2.0) / (np_ * nn) END, 6)
       + 0.0 AS roc_auc FROM ag""".replace("\n,\nrk", ",\nrk"))
def q_roc_auc(spark, sf_dir):
    """ROC-AUC of the ensemble probability against next-day direction (rank-sum)."""
    return finish(EV.roc_auc(_ens_pairs(spark, sf_dir)))


def _split_targets(ret):
    """Targets (E9) with the chronological 80/20 split flag."""
    from quiver.operators.features import next_day_target
    from quiver.plans.feature_queries import chrono_split
    return chrono_split(next_day_target(ret)).withColumnRenamed("target", "y")


_SPLIT = f"""st AS (SELECT ticker, date, CAST(coalesce(lead(log_return) OVER ({W}) > 0, false) AS INTEGER) AS y,
    row_number() OVER ({W}) <= floor(count(*) OVER (PARTITION BY ticker) * 0.8) AS is_train FROM ret)"""


@register("class_weights", _base(_SPLIT) + """
SELECT ticker, y AS label, round(sum(n) OVER (PARTITION BY ticker) / (count(*) OVER (PARTITION BY ticker) * n), 6)
  + 0.0 AS weight FROM (SELECT ticker, y, count(*) AS n FROM st WHERE is_train GROUP BY ticker, y) c""")
def q_class_weights(spark, sf_dir):
    """Balanced class weights of the training targets per ticker."""
    s = _split_targets(_ret(spark, sf_dir)).filter("is_train")
    return finish(EV.class_weights(s))


@register("majority_baseline", _base(_SPLIT) + """,
cnt AS (SELECT ticker, y, count(*) AS n FROM st WHERE is_train GROUP BY ticker, y),
mode AS (SELECT ticker, arg_max(y, n * 10 - y) AS majority_label FROM cnt GROUP BY ticker)
SELECT s.ticker, m.majority_label, round(avg(CAST(s.y = m.majority_label AS DOUBLE)), 6) + 0.0 AS baseline_accuracy
FROM st s JOIN mode m ON s.ticker = m.ticker WHERE NOT s.is_train GROUP BY s.ticker, m.majority_label"""
          .replace("\n,\ncnt", ",\ncnt"))
def q_majority_baseline(spark, sf_dir):
    """Accuracy on the test split of always predicting the training majority label."""
    s = _split_targets(_ret(spark, sf_dir))
    return finish(EV.majority_baseline(s.filter("is_train"), s.filter("NOT is_train")))


@register("accuracy", _base(f"""dc AS (SELECT ticker,
    (CASE WHEN log_return > 0 THEN 'UP' ELSE 'DOWN' END)
     = (CASE WHEN lead(log_return) OVER ({W}) > 0 THEN 'UP' ELSE 'DOWN' END) AS correct FROM ret)""") + """
SELECT ticker, round(avg(CAST(correct AS INTEGER)), 6) + 0.0 AS accuracy FROM dc GROUP BY ticker""")
def q_accuracy(spark, sf_dir):
    """Share of correct directions (momentum call vs next day) per ticker."""
    w = series_window()
    r = _ret(spark, sf_dir)
    c = (F.when(F.col("log_return") > 0, "UP").otherwise("DOWN")
         == F.when(F.lead("log_return").over(w) > 0, "UP").otherwise("DOWN"))
    return finish(r.withColumn("correct", c).groupBy("ticker").agg(
        F.avg(F.col("correct").cast("int")).alias("accuracy")))


# ---------------------------------------------------------------------------
# AR(1) as SQL (I10) and its regression report
# ---------------------------------------------------------------------------

_AR1 = f"""ar1a AS (SELECT ticker, date, log_return, 100.0 * log_return AS y,
    lag(100.0 * log_return) OVER ({W}) AS x FROM ret),
ar1 AS (SELECT ticker, date, log_return, y,
    CASE WHEN count(y) OVER {frame(None)} >= 60 THEN
      regr_intercept(y, x) OVER {frame(None)} + regr_slope(y, x) OVER {frame(None)} * y END AS ar1_forecast_percent
  FROM ar1a)"""


@register("ar1_forecast", _base(_AR1) + """
SELECT ticker, date, round(ar1_forecast_percent, 6) + 0.0 AS ar1_forecast_percent FROM ar1""")
def q_ar1_forecast(spark, sf_dir):
    """Expanding least-squares AR(1) forecast of the next return (percent)."""
    return finish(RC.ar1_forecast(_ret(spark, sf_dir)), ["ticker", "date", "ar1_forecast_percent"])


@register("regression_report", _base(_AR1, f"""rr AS (SELECT ticker, lead(y) OVER ({W}) AS y,
    ar1_forecast_percent AS yhat FROM ar1)""", "rv AS (SELECT * FROM rr WHERE y IS NOT NULL AND yhat IS NOT NULL)",
                                     reg_sql("rv")) + f"SELECT ticker, {rnd(_REG)} FROM reg")
def q_regression_report(spark, sf_dir):
    """MAE, MSE, RMSE, R^2 of the AR(1) forecast against the next day's return (percent)."""
    f = RC.ar1_forecast(_ret(spark, sf_dir))
    pairs = f.select("ticker", (F.lead("log_return").over(series_window()) * 100.0).alias("y"),
                     F.col("ar1_forecast_percent").alias("yhat")).na.drop()
    return finish(EV.regression_report(pairs))


# ---------------------------------------------------------------------------
# grid recursions: GARCH(1,1) volatility (I13, I14, E16) and ARMA(1,1)
# ---------------------------------------------------------------------------

def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"CAST({float(v)!r} AS DOUBLE)" if isinstance(v, float) else str(v)
                                     for v in r) + ")" for r in rows)


GARCH_GRID_SQL = f"ggrid(pid, a, b) AS (VALUES {_values([(i, a, b) for i, (a, b) in enumerate(RC.GARCH_GRID)])})"
ARMA_GRID_SQL = f"agrid(pid, phi, theta) AS (VALUES {_values([(i, p, t) for i, (p, t) in enumerate(RC.ARMA_GRID)])})"


def garch_sql_ctes(min_window: int = RC.GARCH_MIN_WINDOW, src: str = "ret", base: bool = True) -> list[str]:
    """Recursive twin of I13 over the return rows in ``src``, ending in
    ``gvol`` (ticker, date, garch_conditional_volatility)."""
    return ([SQL_VIEWS["bars"], returns_cte("bars", "ret")] if base else []) + [
        f"""gr AS (SELECT *, coalesce(r - lag(mean) OVER ({W}), 0.0) AS e FROM (
    SELECT ticker, date, 100.0 * log_return AS r, row_number() OVER ({W}) - 1 AS i,
           avg(100.0 * log_return) OVER {frame(None)} AS mean, var_samp(100.0 * log_return) OVER {frame(None)} AS v FROM {src}) t)""",
        f"""gi AS (SELECT ticker, floor((log2(min(v)) - {RC.LEVEL_MARGIN}) / {RC.LEVEL_STEP})::BIGINT AS jlo,
    ceil((log2(max(v)) + {RC.LEVEL_MARGIN}) / {RC.LEVEL_STEP})::BIGINT AS jhi FROM gr WHERE i >= {min_window} AND v > 0 GROUP BY ticker)""",
        GARCH_GRID_SQL,
        """grec(ticker, pid, a, b, i, r, e, own, p, q) AS (
  SELECT g.ticker, p.pid, p.a, p.b, g.i, g.r, g.e, CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE)
  FROM gr g JOIN gi ON g.ticker = gi.ticker JOIN ggrid p ON true WHERE g.i = 0
  UNION ALL
  SELECT q.ticker, q.pid, q.a, q.b, q.i + 1, g.r, g.e, q.a * (q.e * q.e) + q.b * q.own, q.a * (q.r * q.r) + q.b * q.p,
         q.a * q.r + q.b * q.q
  FROM grec q JOIN gr g ON g.ticker = q.ticker AND g.i = q.i + 1)""",
        f"""gll AS (SELECT ticker, pid, a, b, i, j, p, q, lev, k, sum(-0.5 * (ln(lev * k + own) + (e * e) / (lev * k + own)))
      OVER (PARTITION BY ticker, pid, j ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ll FROM (
    SELECT c.*, l.j, pow(2.0, {RC.LEVEL_STEP} * l.j) AS lev, (1.0 - a - b) * (1.0 - pow(b, i)) / (1.0 - b) + pow(b, i) AS k
    FROM grec c JOIN (SELECT ticker, unnest(generate_series(jlo, jhi)) AS j FROM gi) l ON c.ticker = l.ticker) t)""",
        f"""gbest AS (SELECT t.ticker, t.i, sqrt(greatest(t.lev * t.k + t.p - 2.0 * g.mean * t.q
      + g.mean * g.mean * (t.a * (1.0 - pow(t.b, t.i)) / (1.0 - t.b)), 0.0)) AS vol FROM (
    SELECT * FROM gll WHERE i >= {min_window}
    QUALIFY row_number() OVER (PARTITION BY ticker, i ORDER BY round(ll, 6) DESC, pid, j) = 1) t
  JOIN gr g ON g.ticker = t.ticker AND g.i = t.i)""",
        """gvol AS (SELECT g.ticker, g.date, b.vol AS garch_conditional_volatility
  FROM gr g LEFT JOIN gbest b ON g.ticker = b.ticker AND g.i = b.i)""",
    ]


@register("garch_volatility", with_recursive(*garch_sql_ctes()) + """
SELECT ticker, date, round(garch_conditional_volatility, 6) + 0.0 AS garch_conditional_volatility FROM gvol""")
def q_garch_volatility(spark, sf_dir):
    """Expanding-window GARCH(1,1) conditional volatility (percent), grid estimator."""
    v = RC.garch_volatility(_ret(spark, sf_dir))
    return finish(v, ["ticker", "date", "garch_conditional_volatility"])


_GF = ["garch_conditional_volatility", "garch_volatility_change", "garch_volatility_lag_1", "garch_volatility_lag_2"]
_GF_SQL = f"""SELECT ticker, date, {rnd(['log_return', *_GF])} FROM (
  SELECT r.ticker, r.date, r.log_return, v.garch_conditional_volatility,
    v.garch_conditional_volatility - lag(v.garch_conditional_volatility) OVER (PARTITION BY r.ticker ORDER BY r.date)
      AS garch_volatility_change,
    lag(v.garch_conditional_volatility, 1) OVER (PARTITION BY r.ticker ORDER BY r.date) AS garch_volatility_lag_1,
    lag(v.garch_conditional_volatility, 2) OVER (PARTITION BY r.ticker ORDER BY r.date) AS garch_volatility_lag_2
  FROM ret r LEFT JOIN gvol v ON r.ticker = v.ticker AND r.date = v.date) t"""


@register("garch_features", with_recursive(*garch_sql_ctes()) + _GF_SQL)
def q_garch_features(spark, sf_dir):
    """GARCH volatility with its change and two lags, joined to the return rows."""
    return finish(RC.garch_features(_ret(spark, sf_dir)), ["ticker", "date", "log_return", *_GF])


@register("volatility_lags", with_recursive(*garch_sql_ctes()) + _GF_SQL.replace(
    f"SELECT ticker, date, {rnd(['log_return', *_GF])} FROM (",
    f"SELECT ticker, date, {rnd(_GF[1:])} FROM (", 1))
def q_volatility_lags(spark, sf_dir):
    """Conditional-volatility change and its 1- and 2-row lags."""
    return finish(RC.garch_features(_ret(spark, sf_dir)), ["ticker", "date", *_GF[1:]])


def arma_sql_ctes(min_rows: int = RC.ARMA_MIN_ROWS, base: bool = True) -> list[str]:
    """Recursive twin of I6 ending in ``afc`` (ticker, date, i, y, arima_mean_forecast_percent)."""
    return ([SQL_VIEWS["bars"], returns_cte("bars", "ret")] if base else []) + [
        f"ar AS (SELECT ticker, date, 100.0 * log_return AS y, row_number() OVER ({W}) - 1 AS i FROM ret)",
        ARMA_GRID_SQL,
        """arec(ticker, pid, phi, theta, i, y, a, c) AS (
  SELECT a.ticker, p.pid, p.phi, p.theta, a.i, a.y, CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE)
  FROM ar a JOIN agrid p ON true WHERE a.i = 0
  UNION ALL
  SELECT q.ticker, q.pid, q.phi, q.theta, q.i + 1, a.y, a.y - q.phi * q.y - q.theta * q.a, (1.0 - q.phi) - q.theta * q.c
  FROM arec q JOIN ar a ON a.ticker = q.ticker AND a.i = q.i + 1)""",
        """asum AS (SELECT ticker, pid, phi, theta, i, y, a, c, sum(a * a) OVER w AS aa, sum(a * c) OVER w AS ac, sum(c * c) OVER w AS cc
  FROM arec WINDOW w AS (PARTITION BY ticker, pid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
        f"""abest AS (SELECT ticker, i, ac / cc + phi * (y - ac / cc) + theta * (a - ac / cc * c) AS f FROM asum
  WHERE i >= {min_rows - 1} QUALIFY row_number() OVER (PARTITION BY ticker, i ORDER BY round(aa - ac * ac / cc, 6), pid) = 1)""",
        """afc AS (SELECT a.ticker, a.date, a.i, a.y, b.f AS arima_mean_forecast_percent
  FROM ar a LEFT JOIN abest b ON a.ticker = b.ticker AND a.i = b.i)""",
    ]


@register("rolling_forecast", with_recursive(*arma_sql_ctes()) + """
SELECT ticker, date, round(arima_mean_forecast_percent, 6) + 0.0 AS arima_mean_forecast_percent FROM afc""")
def q_rolling_forecast(spark, sf_dir):
    """For every date, the ARMA(1,1) grid forecast of the next return fitted through that date."""
    return finish(RC.rolling_forecast(_ret(spark, sf_dir)), ["ticker", "date", "arima_mean_forecast_percent"])


@register("next_day_forecast", with_recursive(*arma_sql_ctes()) + """
SELECT ticker, max(date) AS date, round(arg_max(arima_mean_forecast_percent, date), 6) + 0.0 AS next_day_forecast,
  CASE WHEN arg_max(arima_mean_forecast_percent, date) > 0 THEN 'UP' ELSE 'DOWN' END AS next_day_direction
FROM afc GROUP BY ticker""")
def q_next_day_forecast(spark, sf_dir):
    """I8: the forecast from the whole history (last row) and its direction."""
    f = RC.rolling_forecast(_ret(spark, sf_dir))
    last = f.groupBy("ticker").agg(F.max("date").alias("date"),
                                   F.max_by("arima_mean_forecast_percent", "date").alias("next_day_forecast"))
    return finish(last.withColumn("next_day_direction",
                                  F.when(F.col("next_day_forecast") > 0, "UP").otherwise("DOWN")))


def walk_forward_pairs(ret, test_split: float = 0.2):
    """I7 input: on test dates (last share of rows), the forecast made the day
    before (fit on data strictly before the date) against the actual return."""
    f = RC.rolling_forecast(ret)
    w = series_window()
    n = F.count(F.lit(1)).over(Window.partitionBy("ticker"))
    j = ret.join(f, ["ticker", "date"], "inner").withColumns({
        "_prev": F.lag("arima_mean_forecast_percent").over(w),
        "_rn": F.row_number().over(w), "_n": n})
    return j.filter(F.col("_rn") > F.floor(F.col("_n") * (1 - test_split))).select(
        "ticker", "date", (F.col("log_return") * 100.0).alias("actual"), F.col("_prev").alias("forecast"))


@register("walk_forward", with_recursive(*arma_sql_ctes()) + f""",
wf0 AS (SELECT ticker, date, y AS actual, lag(arima_mean_forecast_percent) OVER ({W}) AS forecast,
    i + 1 AS rn, count(*) OVER (PARTITION BY ticker) AS n FROM afc),
wf AS (SELECT * FROM wf0 WHERE rn > floor(n * (1 - 0.2))),
wfc AS (SELECT ticker, CAST(actual > 0 AS INTEGER) AS y, CAST(forecast > 0 AS INTEGER) AS yhat FROM wf),
wfr AS (SELECT ticker, actual AS y, forecast AS yhat FROM wf),
{clf_sql('wfc')},
{reg_sql('wfr')}
SELECT c.ticker, {', '.join(f'round(c.{m}, 6) + 0.0 AS {m}' for m in _CLF)},
       {', '.join(f'round(r.{m}, 6) + 0.0 AS {m}' for m in _REG)}
FROM clf c JOIN reg r ON c.ticker = r.ticker""".replace("\n,\nwf0", ",\nwf0"))
def q_walk_forward(spark, sf_dir):
    """Walk-forward test on the last 20 %: sign metrics and value metrics per ticker."""
    p = walk_forward_pairs(_ret_shared(spark, sf_dir))
    clf = EV.classification_report(p.select("ticker", (F.col("actual") > 0).cast("int").alias("y"),
                                            (F.col("forecast") > 0).cast("int").alias("yhat")))
    reg = EV.regression_report(p.select("ticker", F.col("actual").alias("y"), F.col("forecast").alias("yhat")))
    return finish(clf.join(reg, "ticker"), ["ticker", *_CLF, *_REG])


@register("rolling_baseline", with_recursive(*arma_sql_ctes()) + f""",
rb0 AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS back FROM afc),
rb AS (SELECT ticker, date, y, arima_mean_forecast_percent AS f FROM rb0
       WHERE back <= 60 AND arima_mean_forecast_percent IS NOT NULL),
rbc AS (SELECT ticker, CAST(coalesce(lead(y) OVER ({W}) > 0, false) AS INTEGER) AS y,
    CAST(f > 0 AS INTEGER) AS yhat FROM rb),
rbr AS (SELECT ticker, y, f AS yhat FROM rb),
{clf_sql('rbc')},
{reg_sql('rbr')}
SELECT c.ticker, {', '.join(f'round(c.{m}, 6) + 0.0 AS {m}' for m in _CLF)},
       {', '.join(f'round(r.{m}, 6) + 0.0 AS {m}' for m in _REG)}
FROM clf c JOIN reg r ON c.ticker = r.ticker""".replace("\n,\nrb0", ",\nrb0"))
def q_rolling_baseline(spark, sf_dir):
    """Rolling forecasts over the last 60 days; direction metrics vs the next day,
    value metrics vs the same day (as in the source)."""
    from quiver.plans.jobs import rolling_baseline_pairs
    clf_in, reg_in = rolling_baseline_pairs(_ret_shared(spark, sf_dir))
    out = EV.classification_report(clf_in).join(EV.regression_report(reg_in), "ticker")
    return finish(out, ["ticker", *_CLF, *_REG])


RECENT_FIT = [SQL_VIEWS["bars"], returns_cte("bars", "ret"), f"""lr AS (SELECT ticker, r, row_number() OVER ({W}) - 1 AS i FROM (
    SELECT ticker, date, 100.0 * log_return AS r FROM ret
    QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) <= 800) t)""",
               "li AS (SELECT ticker, count(*) AS n, avg(r) AS mu, var_samp(r) AS v0 FROM lr GROUP BY ticker)", GARCH_GRID_SQL,
               """lrec(ticker, pid, a, b, i, s2, e) AS (
  SELECT g.ticker, p.pid, p.a, p.b, g.i, li.v0, g.r - li.mu FROM lr g JOIN li ON g.ticker = li.ticker JOIN ggrid p ON true WHERE g.i = 0
  UNION ALL
  SELECT q.ticker, q.pid, q.a, q.b, q.i + 1, li.v0 * (1.0 - q.a - q.b) + q.a * (q.e * q.e) + q.b * q.s2, g.r - li.mu
  FROM lrec q JOIN li ON q.ticker = li.ticker JOIN lr g ON g.ticker = q.ticker AND g.i = q.i + 1)""",
               """lfit AS (SELECT ticker, pid, a, b, sum(-0.5 * (ln(s2) + e * e / s2)) AS ll, sqrt(arg_max(s2, i)) AS vol
  FROM lrec GROUP BY ticker, pid, a, b QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY round(ll, 6) DESC, pid) = 1)"""]


RECENT_FIT_SQL = f"""
SELECT ticker, n, {rnd(['mu', 'omega', 'alpha', 'beta', 'loglik', 'last_volatility'])} FROM (
  SELECT f.ticker, n, mu, v0 * (1 - a - b) AS omega, a AS alpha, b AS beta, ll AS loglik, vol AS last_volatility
  FROM lfit f JOIN li ON f.ticker = li.ticker) t"""


@register("garch_recent_fit", with_recursive(*RECENT_FIT) + RECENT_FIT_SQL)
def q_garch_recent_fit(spark, sf_dir):
    """GARCH(1,1) grid parameters and log-likelihood on the last 800 returns per ticker."""
    return finish(RC.garch_recent_fit(_ret(spark, sf_dir)))
