"""Registered queries: feature matrix, scaling, lookback samples, classifier.

The sample-building steps (I16, H5, E17-E20) have DuckDB twins, and so has the
report (I20) on a probability that needs no fit. The fit (I17) and what is
scored by it (I18-I21, the classifier-driven regime backtest) are tested
against a plain NumPy fit.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quiver.operators import backtest as B
from quiver.operators import classifier as C
from quiver.operators import recursions as RC
from quiver.operators.market import INSTRUMENT_MOMENTUM
from quiver.plans.finish import finish
from quiver.plans.market_queries import processed, processed_ctes
from quiver.plans.model_queries import clf_sql, garch_sql_ctes, with_recursive
from quiver.plans.regime_queries import FIXTURE_VIX_LEVEL
from quiver.plans.registry import register
from quiver.plans.sqltext import W, div, guarded, rnd
from quiver.session import materialize
from quiver.sources.views import SQL_VIEWS

G = B.GARCH_COL
FEATS = list(C.FEATURES)


def features(spark, sf_dir):
    """Processed table + GARCH features -> I16 feature matrix."""
    return C.feature_matrix(RC.garch_features(processed(spark, sf_dir)))


def feature_sql_ctes() -> list[str]:
    mom = ", ".join(f"{guarded('sum', src + '_return', 5)} AS {name}" for name, src in INSTRUMENT_MOMENTUM)
    return [SQL_VIEWS["bars"], SQL_VIEWS["instruments_long"], *processed_ctes(),
            *garch_sql_ctes(src="processed", base=False),
            f"""fm0 AS (SELECT p.*, v.{G} FROM processed p LEFT JOIN gvol v ON p.ticker = v.ticker AND p.date = v.date)""",
            f"""fm1 AS (SELECT ticker, date, log_return, log_return * log_return AS log_return_squared, {G},
    {G} - lag({G}) OVER ({W}) AS garch_volatility_change, lag({G}, 1) OVER ({W}) AS garch_volatility_lag_1,
    lag({G}, 2) OVER ({W}) AS garch_volatility_lag_2,
    {', '.join(f'lag(log_return, {n}) OVER ({W}) AS return_lag_{n}' for n in (1, 2, 3, 5))},
    {', '.join(f"{guarded('sum', 'log_return', n)} AS momentum_{n}" for n in (3, 5, 10))},
    {guarded('avg', 'log_return', 5)} AS rolling_mean_5, {guarded('stddev_samp', 'log_return', 5)} AS rolling_std_5,
    {guarded('avg', 'log_return', 20)} AS rolling_mean_20,
    {guarded('stddev_samp', 'log_return', 20)} AS rolling_std_20,
    {div(guarded('stddev_samp', 'log_return', 5), guarded('stddev_samp', 'log_return', 20))} AS volatility_ratio,
    vix_close, vix_return, vix_close - lag(vix_close) OVER ({W}) AS vix_change, lag(vix_close) OVER ({W}) AS vix_lag_1,
    spy_return, iwm_return, iwm_spy_relative_strength, credit_risk_appetite, xlk_return, qqq_spy_market_strength,
    tech_vs_staples, discretionary_vs_staples, financials_vs_market, industrials_vs_market, tnx_close,
    tnx_close - lag(tnx_close) OVER ({W}) AS rate_change, uup_return, tlt_return, hyg_return, gld_return,
    gold_vs_market, {mom},
    CAST(coalesce(lead(log_return) OVER ({W}) > 0, false) AS INTEGER) AS target FROM fm0)""",
            "fm AS (SELECT * FROM fm1 WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in FEATS) + ")"]


@register("feature_matrix", with_recursive(*feature_sql_ctes()) + f"""
SELECT ticker, date, target, {rnd(FEATS)} FROM fm""")
def q_feature_matrix(spark, sf_dir):
    """I16: the 45 notebook features and the target per (ticker, date), complete rows only."""
    return finish(features(spark, sf_dir), ["ticker", "date", "target", *FEATS])


def _scale_sql(fit_all: bool) -> str:
    sel = "true" if fit_all else "is_train"
    parts = ", ".join(
        f"({c} - avg(CASE WHEN {sel} THEN {c} END) OVER (PARTITION BY ticker)) / "
        f"(CASE WHEN stddev_pop(CASE WHEN {sel} THEN {c} END) OVER (PARTITION BY ticker) = 0 THEN 1.0 "
        f"ELSE stddev_pop(CASE WHEN {sel} THEN {c} END) OVER (PARTITION BY ticker) END) AS {c}" for c in FEATS)
    return f"""sc0 AS (SELECT *, row_number() OVER ({W}) AS rn, count(*) OVER (PARTITION BY ticker) AS n FROM fm),
sc1 AS (SELECT *, rn <= floor(n * 0.8) AS is_train FROM sc0),
sc AS (SELECT ticker, date, is_train, {parts} FROM sc1)"""


@register("standardize", with_recursive(*feature_sql_ctes(), _scale_sql(False)) + f"""
SELECT ticker, date, is_train, {rnd(FEATS)} FROM sc""")
def q_standardize(spark, sf_dir):
    """H5: per-ticker standard scaling fitted on the training rows (population std, 0 -> 1)."""
    s = C.standardize(C.chrono_flags(features(spark, sf_dir)))
    return finish(s, ["ticker", "date", "is_train", *FEATS])


@register("stack_splits", with_recursive(*feature_sql_ctes(), _scale_sql(True)) + f"""
SELECT ticker, date, is_train, {rnd(FEATS)} FROM sc""")
def q_stack_splits(spark, sf_dir):
    """G3 (+ H5 'all rows' mode): one scaled table for train and test rows, no union needed."""
    s = C.standardize(C.chrono_flags(features(spark, sf_dir)), fit_on="all")
    return finish(s, ["ticker", "date", "is_train", *FEATS])


def _digest_sql(frame: str) -> str:
    """Per feature the sum of a window's values times their place (1 for the oldest)."""
    return ", ".join(f"list_sum(list_transform(list({c}) OVER ({W} {frame}), lambda x, i: x * i)) AS w_{c}" for c in FEATS)


def _digest(window: str = "features"):
    """The Spark form of ``_digest_sql`` over the flattened window."""
    steps = F.sequence(F.lit(0), F.lit(C.LOOKBACK - 1))

    def digest(j: int):
        return F.aggregate(steps, F.lit(0.0), lambda a, k: a + F.get(window, k * len(FEATS) + j) * (k + 1))

    return [digest(j).alias(f"w_{c}") for j, c in enumerate(FEATS)]


_WIN = [f"w_{c}" for c in FEATS]
_PAST, _NOW = "ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING", "ROWS BETWEEN 29 PRECEDING AND CURRENT ROW"


@register("lookback_windows", with_recursive(*feature_sql_ctes(), f"""lb AS (SELECT ticker, date, target,
    count(*) OVER ({W} {_PAST}) AS steps, min(date) OVER ({W} {_PAST}) AS window_start,
    max(date) OVER ({W} {_PAST}) AS window_end, {_digest_sql(_PAST)} FROM fm)""") + f"""
SELECT ticker, date, target, window_start, window_end, CAST(steps * 45 AS INTEGER) AS n_values, {rnd(_WIN)} FROM lb WHERE steps = 30""")
def q_lookback_windows(spark, sf_dir):
    """30-row lookback samples (rows i-30..i-1) labelled with target[i]; a digest of each of the 45 features."""
    lw = C.lookback_windows(features(spark, sf_dir))
    return finish(lw.select("ticker", "date", "target", "window_start", "window_end", F.size("features").alias("n_values"), *_digest()))


@register("latest_window", with_recursive(*feature_sql_ctes(), f"""lw AS (SELECT ticker, date,
    min(date) OVER ({W} {_NOW}) AS window_start, count(*) OVER ({W} {_NOW}) AS c, {_digest_sql(_NOW)} FROM fm)""") + f"""
SELECT ticker, date, window_start, {rnd(_WIN)} FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS back FROM lw) t WHERE back = 1 AND c = 30""")
def q_latest_window(spark, sf_dir):
    """The last 30 feature rows of every ticker as the inference sample; a digest of each of the 45 features."""
    lw = C.latest_window(features(spark, sf_dir))
    return finish(lw.select("ticker", "date", "window_start", *_digest()))


@register("validation_tail", with_recursive(*feature_sql_ctes(), f"""s0 AS (SELECT ticker, date,
    row_number() OVER ({W}) AS rn, count(*) OVER (PARTITION BY ticker) AS n FROM fm)""",
                                            f"""s1 AS (SELECT ticker, date, row_number() OVER ({W}) AS k,
    count(*) OVER (PARTITION BY ticker) AS m FROM s0 WHERE rn <= floor(n * 0.8) AND rn > 30)""") + """
SELECT ticker, date, k > floor(m * (1.0 - 0.2)) AS is_validation FROM s1""")
def q_validation_tail(spark, sf_dir):
    """The last 20 % of each ticker's training samples is the validation part."""
    s = C.lookback_windows(C.chrono_flags(features(spark, sf_dir))).filter("is_train")
    return finish(C.validation_tail(s).select("ticker", "date", "is_validation"))


# ---------------------------------------------------------------------------
# model fit and everything scored by it
# ---------------------------------------------------------------------------

_FITS: dict[tuple, tuple] = {}


def _file_state(spark, sf_dir) -> tuple:
    """Number and a hash of names, sizes and times of the input's files."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(sf_dir).select(F.xxhash64("path", "length", "modificationTime").alias("h")))
    return tuple(files.agg(F.count("h"), F.sum(F.col("h").cast("decimal(38,0)"))).first())


def fitted(spark, sf_dir):
    """(model, sample blocks): one fit for the queries of an application that
    read the same, unchanged files. The blocks are written once to the shared
    checkpoint folder, so epochs read them instead of building them anew."""
    key = (spark.sparkContext.applicationId, sf_dir, *_file_state(spark, sf_dir))
    if key not in _FITS:
        blocks = materialize(C.sample_blocks(features(spark, sf_dir)), "sample-blocks")
        _FITS[key] = (C.train_direction(blocks), blocks)
    return _FITS[key]


@register("train_direction")
def q_train_direction(spark, sf_dir):
    """The 30 x 45 weights and the intercept (step -1) after epochs with early stopping."""
    model, _ = fitted(spark, sf_dir)
    return finish(model.table(spark))


@register("training_history")
def q_training_history(spark, sf_dir):
    """Loss and validation loss per epoch; ``best`` marks the weights that stayed."""
    model, _ = fitted(spark, sf_dir)
    return finish(C.training_history(spark, model))


@register("classifier_predictions")
def q_classifier_predictions(spark, sf_dir):
    """Date, truth, probability and direction on the test rows."""
    model, blocks = fitted(spark, sf_dir)
    return finish(C.classifier_predictions(model, blocks))


@register("classifier_metrics")
def q_classifier_metrics(spark, sf_dir):
    """Scores, baseline, ROC-AUC, threshold, class weights, per-class report and confusion matrix as long rows."""
    model, blocks = fitted(spark, sf_dir)
    return finish(C.classifier_metrics(C.classifier_predictions(model, blocks), C.train_targets(blocks)))


_RULE = f"""ru AS (SELECT *, rn <= floor(n * 0.8) AS is_train FROM (SELECT ticker, target AS y, momentum_5,
    row_number() OVER ({W}) AS rn, count(*) OVER (PARTITION BY ticker) AS n FROM fm) t WHERE rn > 30),
rp AS (SELECT ticker, y, p, CAST(p >= 0.55 AS INTEGER) AS yhat FROM (
    SELECT ticker, y, round(0.5 + greatest(-0.4, least(0.4, momentum_5)), 6) AS p FROM ru WHERE NOT is_train) t),
{clf_sql('rp')},
cw AS (SELECT ticker, y, count(*) AS n FROM ru WHERE is_train GROUP BY ticker, y),
mode AS (SELECT ticker, arg_max(y, n * 10 - y) AS m FROM cw GROUP BY ticker),
rk AS (SELECT ticker, y, rank() OVER (PARTITION BY ticker ORDER BY p) + (count(*) OVER (PARTITION BY ticker, p) - 1) / 2.0 AS r FROM rp),
ag AS (SELECT ticker, sum(r) FILTER (WHERE y = 1) AS rs, count_if(y = 1) AS up, count_if(y = 0) AS dn FROM rk GROUP BY ticker),
lab AS (SELECT DISTINCT ticker, y AS label FROM cm UNION SELECT DISTINCT ticker, yhat FROM cm),
seen AS (SELECT * FROM pc WHERE support + predicted > 0),
per AS (SELECT ticker, CAST(label AS VARCHAR) AS label, precision, recall, f1, support FROM seen
  UNION ALL SELECT ticker, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM seen GROUP BY ticker
  UNION ALL SELECT ticker, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support) FROM seen GROUP BY ticker),
long AS (
  {' UNION ALL '.join(f"SELECT ticker, 'scores' AS section, CAST(NULL AS VARCHAR) AS label, '{m}' AS metric, {m} AS value FROM clf" for m in ('accuracy', 'precision', 'recall', 'f1'))}
  UNION ALL SELECT ticker, 'scores', NULL, 'prediction_threshold', 0.55 FROM clf
  UNION ALL SELECT ticker, 'baseline', NULL, 'majority_label', m FROM mode
  UNION ALL SELECT t.ticker, 'baseline', NULL, 'baseline_accuracy', avg(CAST(t.y = mode.m AS DOUBLE)) FROM ru t JOIN mode USING (ticker)
    WHERE NOT is_train GROUP BY t.ticker
  UNION ALL SELECT ticker, 'ranking', NULL, 'roc_auc', CASE WHEN up > 0 AND dn > 0 THEN (rs - up * (up + 1) / 2.0) / (up * dn) END FROM ag
  UNION ALL SELECT ticker, 'class_weights', CAST(y AS VARCHAR), 'weight',
    sum(n) OVER (PARTITION BY ticker) / (count(*) OVER (PARTITION BY ticker) * n) FROM cw
  {' '.join(f"UNION ALL SELECT ticker, 'per_class', label, '{m}', {m} FROM per" for m in ('precision', 'recall', 'f1', 'support'))}
  UNION ALL SELECT a.ticker, 'confusion_matrix', CAST(a.label AS VARCHAR), CAST(b.label AS VARCHAR), coalesce(cm.n, 0)
    FROM lab a JOIN lab b ON a.ticker = b.ticker LEFT JOIN cm ON cm.ticker = a.ticker AND cm.y = a.label AND cm.yhat = b.label)"""


@register("classifier_metrics_rule", with_recursive(*feature_sql_ctes(), _RULE) + """
SELECT ticker, section, label, metric, round(CAST(value AS DOUBLE), 6) + 0.0 AS value FROM long""")
def q_classifier_metrics_rule(spark, sf_dir):
    """I20's report on a probability that needs no fit: 0.5 plus the five-day momentum, within 0.1 and 0.9."""
    rows = C.chrono_flags(features(spark, sf_dir)).where(F.col("_rn") > C.LOOKBACK)
    rows = materialize(rows.select("ticker", F.col("target").alias("y"), "is_train", F.round(
        0.5 + F.greatest(F.lit(-0.4), F.least(F.lit(0.4), "momentum_5")), 6).alias("p")), "rule-samples")
    pred = rows.where("NOT is_train").select("ticker", F.col("y").alias("actual_direction"), F.col("p").alias("predicted_probability_up"),
                                             (F.col("p") >= C.THRESHOLD).cast("int").alias("predicted_direction"))
    return finish(C.classifier_metrics(pred, rows.select("ticker", "y", "is_train")))


@register("next_day_probability")
def q_next_day_probability(spark, sf_dir):
    """Score the latest 30-row window per ticker; UP / DOWN / NO TRADE at 0.55."""
    model, blocks = fitted(spark, sf_dir)
    return finish(C.next_day_probability(model, blocks))


@register("classifier_regime_backtest")
def q_classifier_regime_backtest(spark, sf_dir):
    """J16 with the classifier probability: the notebook's end-to-end regime-aware backtest."""
    model, blocks = fitted(spark, sf_dir)
    pred = C.classifier_predictions(model, blocks).select("ticker", "date", "predicted_probability_up")
    p = processed(spark, sf_dir)
    forecasts = RC.rolling_forecast(p)
    market = B.market_regimes(RC.garch_features(p), vix_level=FIXTURE_VIX_LEVEL)
    bt = B.regime_backtest_table(pred, forecasts, market, upper=0.53, lower=0.47, threshold=0.03)
    return finish(B.backtest_summary(bt))
