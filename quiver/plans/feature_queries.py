"""Registered queries: returns, lags, rolling statistics, projections, scalars."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quiver.functions.scalar import clip_keep_null, safe_ln
from quiver.functions.windows import KEYS, series_window
from quiver.operators import features as X
from quiver.operators import backtest as B
from quiver.plans.backtest_queries import ensemble_ctes
from quiver.plans.finish import finish
from quiver.plans.registry import register
from quiver.plans.sqltext import W, div, guarded, ln, returns_cte, rnd
from quiver.sources.views import bars, sql_with

LP = ln("price")
LR_SQL = f"{LP} - lag({LP}) OVER ({W})"


def _lr_cte(src: str = "bars", name: str = "lr") -> str:
    """All bar rows with log_price and log_return (first row NULL)."""
    return f"""{name} AS (
  SELECT ticker, date, price, volume, {LP} AS log_price, {LR_SQL} AS log_return FROM {src})"""


def _lr(spark, sf_dir):
    return X.log_returns(bars(spark, sf_dir))


@register("log_returns", sql_with("bars", extra=[_lr_cte()]) + f"""
SELECT ticker, date, {rnd(['price', 'log_price', 'log_return'])},
       round(log_return * log_return, 6) + 0.0 AS log_return_squared FROM lr""")
def q_log_returns(spark, sf_dir):
    """Log price, log return and squared log return per ticker."""
    return finish(_lr(spark, sf_dir), ["ticker", "date", "price", "log_price", "log_return",
                                       "log_return_squared"])


@register("return_lags", sql_with("bars", extra=[_lr_cte()]) + f"""
SELECT ticker, date, {rnd(['log_return', 'return_lag_1', 'return_lag_2', 'return_lag_3', 'return_lag_5'])}
FROM (SELECT ticker, date, log_return,
  lag(log_return, 1) OVER ({W}) AS return_lag_1, lag(log_return, 2) OVER ({W}) AS return_lag_2,
  lag(log_return, 3) OVER ({W}) AS return_lag_3, lag(log_return, 5) OVER ({W}) AS return_lag_5
  FROM lr) t""")
def q_return_lags(spark, sf_dir):
    """Returns 1, 2, 3 and 5 rows back."""
    return finish(X.return_lags(_lr(spark, sf_dir)),
                  ["ticker", "date", "log_return", "return_lag_1", "return_lag_2", "return_lag_3",
                   "return_lag_5"])


@register("momentum", sql_with("bars", extra=[_lr_cte()]) + f"""
SELECT ticker, date, {rnd(['momentum_3', 'momentum_5', 'momentum_10'])}
FROM (SELECT ticker, date, {guarded('sum', 'log_return', 3)} AS momentum_3,
  {guarded('sum', 'log_return', 5)} AS momentum_5, {guarded('sum', 'log_return', 10)} AS momentum_10
  FROM lr) t""")
def q_momentum(spark, sf_dir):
    """Rolling sums of return over 3, 5 and 10 rows (missing in warm-up)."""
    return finish(X.momentum(_lr(spark, sf_dir)), ["ticker", "date", "momentum_3", "momentum_5",
                                                  "momentum_10"])


_RS = ["rolling_mean_5", "rolling_std_5", "rolling_mean_20", "rolling_std_20"]
_RS_SQL = f"""rs AS (SELECT *, {guarded('avg', 'log_return', 5)} AS rolling_mean_5,
  {guarded('stddev_samp', 'log_return', 5)} AS rolling_std_5,
  {guarded('avg', 'log_return', 20)} AS rolling_mean_20,
  {guarded('stddev_samp', 'log_return', 20)} AS rolling_std_20 FROM lr)"""


@register("rolling_stats", sql_with("bars", extra=[_lr_cte(), _RS_SQL]) + f"""
SELECT ticker, date, {rnd(_RS)} FROM rs""")
def q_rolling_stats(spark, sf_dir):
    """Rolling mean and sample std of returns over 5 and 20 rows."""
    return finish(X.rolling_stats(_lr(spark, sf_dir)), ["ticker", "date", *_RS])


@register("volatility_ratio", sql_with("bars", extra=[_lr_cte(), _RS_SQL]) + f"""
SELECT ticker, date, {rnd(['volatility_ratio'])}
FROM (SELECT ticker, date, {div('rolling_std_5', 'rolling_std_20')} AS volatility_ratio FROM rs) t""")
def q_volatility_ratio(spark, sf_dir):
    """E5: std5 / std20 (NULL on a zero denominator)."""
    return finish(X.volatility_ratio(X.rolling_stats(_lr(spark, sf_dir))),
                  ["ticker", "date", "volatility_ratio"])


@register("volume_momentum_5", sql_with("bars") + f"""
SELECT ticker, date, round({guarded('avg', 'volume', 5)}, 6) + 0.0 AS volume_momentum_5 FROM bars""")
def q_volume_momentum(spark, sf_dir):
    """Rolling 5-row mean of volume."""
    return finish(X.volume_momentum(bars(spark, sf_dir)), ["ticker", "date", "volume_momentum_5"])


@register("next_day_target", sql_with("bars", extra=[_lr_cte()]) + f"""
SELECT ticker, date, CAST(coalesce(lead(log_return) OVER ({W}) > 0, false) AS INTEGER) AS target FROM lr""")
def q_next_day_target(spark, sf_dir):
    """1 when the next return is positive, else 0 (last row 0, as in the source)."""
    return finish(X.next_day_target(_lr(spark, sf_dir)), ["ticker", "date", "target"])


@register("moving_averages", sql_with("bars") + f"""
SELECT ticker, date, {rnd(['sma_20', 'sma_50'])}
FROM (SELECT ticker, date, {guarded('avg', 'price', 20)} AS sma_20, {guarded('avg', 'price', 50)} AS sma_50
      FROM bars) t""")
def q_moving_averages(spark, sf_dir):
    """20- and 50-row mean of price."""
    return finish(X.moving_averages(bars(spark, sf_dir)), ["ticker", "date", "sma_20", "sma_50"])


_FEATS = ["return_lag_1", "return_lag_2", "return_lag_3", "return_lag_5", "momentum_3", "momentum_5",
          "momentum_10", "rolling_mean_5", "rolling_std_5", "rolling_mean_20", "rolling_std_20",
          "volatility_ratio", "volume_momentum_5"]


@register("lstm_features", sql_with("bars", extra=[_lr_cte()]) + f"""
SELECT ticker, date, target, {rnd(['log_return', *_FEATS])} FROM (
  SELECT ticker, date, log_return,
    lag(log_return, 1) OVER ({W}) AS return_lag_1, lag(log_return, 2) OVER ({W}) AS return_lag_2,
    lag(log_return, 3) OVER ({W}) AS return_lag_3, lag(log_return, 5) OVER ({W}) AS return_lag_5,
    {guarded('sum', 'log_return', 3)} AS momentum_3, {guarded('sum', 'log_return', 5)} AS momentum_5,
    {guarded('sum', 'log_return', 10)} AS momentum_10,
    {guarded('avg', 'log_return', 5)} AS rolling_mean_5, {guarded('stddev_samp', 'log_return', 5)} AS rolling_std_5,
    {guarded('avg', 'log_return', 20)} AS rolling_mean_20,
    {guarded('stddev_samp', 'log_return', 20)} AS rolling_std_20,
    {div(guarded('stddev_samp', 'log_return', 5), guarded('stddev_samp', 'log_return', 20))} AS volatility_ratio,
    {guarded('avg', 'volume', 5)} AS volume_momentum_5,
    CAST(coalesce(lead(log_return) OVER ({W}) > 0, false) AS INTEGER) AS target
  FROM lr) t""")
def q_lstm_features(spark, sf_dir):
    """E2-E6 + E9 in one projection: the package feature set (one shared sort)."""
    return finish(X.lstm_features(_lr(spark, sf_dir)), ["ticker", "date", "target", "log_return", *_FEATS])


@register("normalize_price", sql_with("bars") + """
SELECT ticker, date, round(price, 6) + 0.0 AS price, round(volume, 6) + 0.0 AS volume FROM bars""")
def q_normalize_price(spark, sf_dir):
    """B1: a bar table with 'Close' is renamed to 'price' (and checked at plan time)."""
    raw = bars(spark, sf_dir).withColumnRenamed("price", "Close")
    return finish(X.normalize_price(raw), ["ticker", "date", "price", "volume"])


@register("drop_incomplete", sql_with("bars", extra=[_lr_cte()]) + f"""
SELECT ticker, date, {rnd(['price', 'log_return'])} FROM lr WHERE log_return IS NOT NULL""")
def q_drop_incomplete(spark, sf_dir):
    """B2: rows with any missing value dropped (the first row of every series)."""
    df = _lr(spark, sf_dir).select("ticker", "date", "price", "log_return")
    return finish(X.drop_incomplete(df))


@register("fill_zero_returns", sql_with("bars", extra=[_lr_cte()]) + """
SELECT ticker, date, round(coalesce(log_return, 0.0), 6) + 0.0 AS log_return FROM lr""")
def q_fill_zero(spark, sf_dir):
    """Missing returns count as 0."""
    return finish(X.fill_zero_returns(_lr(spark, sf_dir), ["log_return"]), ["ticker", "date", "log_return"])


HISTORY_CUTOFF = "1998-12-31"


@register("history_prefix", sql_with("bars") + f"""
SELECT ticker, date, round(price, 6) + 0.0 AS price FROM bars WHERE date <= DATE '{HISTORY_CUTOFF}'""")
def q_history_prefix(spark, sf_dir):
    """All rows up to and including a cutoff date (pushed to the scan as a date filter)."""
    return finish(X.history_prefix(bars(spark, sf_dir), HISTORY_CUTOFF), ["ticker", "date", "price"])


@register("traded_days", sql_with("bars", extra=ensemble_ctes("bars")) + f"""
SELECT ticker, date, position, {rnd(['ensemble_prob_up', 'next_day_return'])} FROM ens WHERE position <> 0""")
def q_traded_days(spark, sf_dir):
    """Backtest days on which a position is held."""
    t = B.ensemble_table(B.prepare_returns(bars(spark, sf_dir)))
    return finish(X.traded_days(t), ["ticker", "date", "position", "ensemble_prob_up", "next_day_return"])


@register("feature_columns", sql_with("bars", extra=[_lr_cte()]) + f"""
SELECT ticker, date, volume, {rnd(['log_return'])}, round(log_return * log_return, 6) + 0.0 AS log_return_squared
FROM lr""")
def q_feature_columns(spark, sf_dir):
    """Every column but the excluded ones (price, log_price, target)."""
    return finish(X.feature_columns(_lr(spark, sf_dir)))


@register("build_features", sql_with("bars") + """
SELECT ticker, date, round(price, 6) + 0.0 AS price, round(volume, 6) + 0.0 AS volume FROM bars""")
def q_build_features(spark, sf_dir):
    """Identity transformation; rows and columns unchanged."""
    return finish(X.build_features(bars(spark, sf_dir)))


@register("direction_label", sql_with("bars", extra=[_lr_cte()]) + f"""
SELECT ticker, date, round(log_return, 6) + 0.0 AS log_return,
  CASE WHEN log_return > 0 THEN 'UP' ELSE 'DOWN' END AS direction FROM lr""")
def q_direction_label(spark, sf_dir):
    """> 0 is UP, else (also missing) DOWN."""
    df = _lr(spark, sf_dir).withColumn("direction", X.direction_label("log_return"))
    return finish(df, ["ticker", "date", "log_return", "direction"])


@register("direction_correct", sql_with("bars", extra=[_lr_cte()]) + f"""
SELECT ticker, date, predicted_direction, actual_direction,
       predicted_direction = actual_direction AS correct FROM (
  SELECT ticker, date,
    CASE WHEN log_return > 0 THEN 'UP' ELSE 'DOWN' END AS predicted_direction,
    CASE WHEN lead(log_return) OVER ({W}) > 0 THEN 'UP' ELSE 'DOWN' END AS actual_direction
  FROM lr) t""")
def q_direction_correct(spark, sf_dir):
    """Momentum prediction vs next day's direction (last row counts as DOWN, as in the source)."""
    w = series_window()
    df = _lr(spark, sf_dir).withColumns({
        "predicted_direction": X.direction_label("log_return"),
        "actual_direction": X.direction_label(F.lead("log_return").over(w)),
    }).withColumn("correct", F.col("predicted_direction") == F.col("actual_direction"))
    return finish(df, ["ticker", "date", "predicted_direction", "actual_direction", "correct"])


@register("percent_returns", sql_with("bars", extra=[_lr_cte()]) + """
SELECT ticker, date, round(log_return * 100.0, 6) + 0.0 AS return_pct FROM lr""")
def q_percent_returns(spark, sf_dir):
    """Log return in percent."""
    return finish(X.percent_returns(_lr(spark, sf_dir)), ["ticker", "date", "return_pct"])


@register("threshold_direction", sql_with("bars", extra=ensemble_ctes("bars")) + """
SELECT ticker, date, CAST(ensemble_prob_up >= 0.55 AS INTEGER) AS direction FROM ens""")
def q_threshold_direction(spark, sf_dir):
    """Probability >= 0.55 -> 1 else 0 (NULL stays NULL)."""
    t = B.ensemble_table(B.prepare_returns(bars(spark, sf_dir)))
    return finish(t.withColumn("direction", X.threshold_direction("ensemble_prob_up")),
                  ["ticker", "date", "direction"])


@register("three_way_direction", sql_with("bars", extra=ensemble_ctes("bars")) + """
SELECT ticker, date, CASE WHEN ensemble_prob_up >= 0.55 THEN 'UP'
  WHEN ensemble_prob_up <= 1 - 0.55 THEN 'DOWN' ELSE 'NO TRADE' END AS direction FROM ens""")
def q_three_way_direction(spark, sf_dir):
    """UP / DOWN / NO TRADE from a probability and threshold 0.55."""
    t = B.ensemble_table(B.prepare_returns(bars(spark, sf_dir)))
    return finish(t.withColumn("direction", X.three_way_direction("ensemble_prob_up")),
                  ["ticker", "date", "direction"])


@register("scalar_math", sql_with("bars", extra=[_lr_cte()]) + f"""
SELECT ticker, date, {rnd(['ln_price', 'exp_return', 'sq_return', 'sqrt_price', 'sign_return',
                            'abs_return', 'min_return', 'clipped'])} FROM (
  SELECT ticker, date, {LP} AS ln_price, exp(log_return) AS exp_return,
    pow(log_return, 2) AS sq_return, sqrt(price) AS sqrt_price,
    CAST(sign(log_return) AS DOUBLE) AS sign_return, abs(log_return) AS abs_return,
    least(log_return, 0.0) AS min_return,
    CASE WHEN log_return IS NOT NULL THEN greatest(least(0.5 + log_return, 0.9), 0.1) END AS clipped
  FROM lr) t""")
def q_scalar_math(spark, sf_dir):
    """H1: ln, exp, square, sqrt, sign, abs, minimum and clip to [0.1, 0.9]."""
    r = F.col("log_return")
    df = _lr(spark, sf_dir).select(
        "ticker", "date", safe_ln("price").alias("ln_price"), F.exp(r).alias("exp_return"),
        F.pow(r, 2).alias("sq_return"), F.sqrt("price").alias("sqrt_price"),
        F.signum(r).alias("sign_return"), F.abs(r).alias("abs_return"),
        F.least(r, F.lit(0.0)).alias("min_return"),
        clip_keep_null(F.lit(0.5) + r, 0.1, 0.9).alias("clipped"))
    return finish(df)


@register("scalar_logic", sql_with("bars", extra=[_lr_cte()]) + """
SELECT ticker, date,
  CASE WHEN log_return > 0.05 THEN 'big_up' WHEN log_return > 0 THEN 'up'
       WHEN log_return IS NULL THEN 'missing' ELSE 'down' END AS bucket,
  CAST(log_return > 0 AS INTEGER) AS up_int, log_return IS NULL AS is_missing FROM lr""")
def q_scalar_logic(spark, sf_dir):
    """H2: nested when, select-by-conditions with default, boolean->int, is-missing."""
    r = F.col("log_return")
    df = _lr(spark, sf_dir).select(
        "ticker", "date",
        F.when(r > 0.05, "big_up").when(r > 0, "up").when(r.isNull(), "missing")
        .otherwise("down").alias("bucket"),
        (r > 0).cast("int").alias("up_int"), r.isNull().alias("is_missing"))
    return finish(df)


@register("scalar_string", sql_with("bars") + """
SELECT ticker, date, upper(lower(ticker)) AS upper_ticker,
  trim(split_part(line, ':', -1)) AS after_colon,
  contains(line, 'Prob') AS has_prob, printf('%.2f%%', round(sqrt(price), 2)) AS pct_text
FROM (SELECT *, 'Ensemble Prob UP     : ' || printf('%.4f', round(sqrt(price) / 1000.0, 4)) AS line FROM bars) t""")
def q_scalar_string(spark, sf_dir):
    """H3: upper-case, text after the last ':', trim, substring test, number formatting."""
    line = F.concat(F.lit("Ensemble Prob UP     : "),
                    F.format_string("%.4f", F.round(F.sqrt("price") / 1000.0, 4)))
    df = bars(spark, sf_dir).withColumn("line", line).select(
        "ticker", "date", F.upper(F.lower("ticker")).alias("upper_ticker"),
        F.trim(F.substring_index("line", ":", -1)).alias("after_colon"),
        F.col("line").contains("Prob").alias("has_prob"),
        F.format_string("%.2f%%", F.round(F.sqrt("price"), 2)).alias("pct_text"))
    return finish(df)


@register("scalar_date", sql_with("bars") + """
SELECT ticker, date, CAST(strftime(date, '%Y-%m-%d') AS DATE) AS parsed,
       strftime(CAST(date AS TIMESTAMP), '%Y-%m-%d %H:%M') AS stamp FROM bars""")
def q_scalar_date(spark, sf_dir):
    """H4: parse a date from text and format a timestamp."""
    df = bars(spark, sf_dir).select(
        "ticker", "date", F.to_date(F.date_format("date", "yyyy-MM-dd")).alias("parsed"),
        F.date_format(F.col("date").cast("timestamp"), "yyyy-MM-dd HH:mm").alias("stamp"))
    return finish(df)


@register("last_n_per_ticker", sql_with("bars") + """
SELECT ticker, date, round(price, 6) + 0.0 AS price FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM bars) t WHERE rn <= 30""")
def q_last_n(spark, sf_dir):
    """the last 30 rows per ticker (window group limit, no global sort)."""
    df = bars(spark, sf_dir).withColumn("rn", X.series_row_number(desc=True)).filter("rn <= 30")
    return finish(df, ["ticker", "date", "price"])


@register("head_n", sql_with("bars") + """
SELECT ticker, date, round(price, 6) + 0.0 AS price FROM bars ORDER BY ticker, date LIMIT 10""")
def q_head_n(spark, sf_dir):
    """first rows for display (a top-k report: the limit is the feature)."""
    return finish(bars(spark, sf_dir).orderBy("ticker", "date").limit(10), ["ticker", "date", "price"])


@register("append_rows", sql_with("bars") + f"""
SELECT ticker, date, round(price, 6) + 0.0 AS price FROM bars WHERE date <= DATE '{HISTORY_CUTOFF}'
UNION ALL
SELECT ticker, date, round(price, 6) + 0.0 AS price FROM bars WHERE date > DATE '{HISTORY_CUTOFF}'""")
def q_append_rows(spark, sf_dir):
    """G1: new observations appended to history (unionByName)."""
    b = bars(spark, sf_dir).select("ticker", "date", "price")
    old = b.filter(F.col("date") <= F.to_date(F.lit(HISTORY_CUTOFF)))
    new = b.filter(F.col("date") > F.to_date(F.lit(HISTORY_CUTOFF)))
    return finish(old.unionByName(new))


@register("return_summary", sql_with("bars", extra=[returns_cte("bars", "ret")]) + f"""
SELECT ticker, count(*) AS n, {rnd(['mean_return', 'std_return', 'min_return', 'max_return', 'up_share'])}
FROM (SELECT ticker, count(*) OVER (PARTITION BY ticker) AS n,
        avg(log_return) OVER (PARTITION BY ticker) AS mean_return,
        stddev_samp(log_return) OVER (PARTITION BY ticker) AS std_return,
        min(log_return) OVER (PARTITION BY ticker) AS min_return,
        max(log_return) OVER (PARTITION BY ticker) AS max_return,
        avg(CAST(log_return > 0 AS INTEGER)) OVER (PARTITION BY ticker) AS up_share FROM ret) t
GROUP BY ticker, mean_return, std_return, min_return, max_return, up_share""")
def q_return_summary(spark, sf_dir):
    """Count, mean, sample std, min, max and share of up days per ticker."""
    r = B.prepare_returns(bars(spark, sf_dir))
    df = r.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n"), F.avg("log_return").alias("mean_return"),
        F.stddev_samp("log_return").alias("std_return"), F.min("log_return").alias("min_return"),
        F.max("log_return").alias("max_return"),
        F.avg((F.col("log_return") > 0).cast("int")).alias("up_share"))
    return finish(df)


@register("global_quantile", sql_with("bars", extra=ensemble_ctes("bars")) + """
SELECT ticker, round(quantile_cont(rolling_std_20, 0.75), 6) + 0.0 AS vol_q75 FROM ens GROUP BY ticker""")
def q_global_quantile(spark, sf_dir):
    """75 % quantile of volatility over the whole history (exact, interpolated)."""
    t = B.ensemble_table(B.prepare_returns(bars(spark, sf_dir)))
    return finish(t.groupBy("ticker").agg(F.percentile("rolling_std_20", 0.75).alias("vol_q75")))


@register("regime_counts", sql_with("bars", extra=ensemble_ctes("bars")) + """
SELECT ticker, CAST(count_if(market_regime = 'risk_off') AS BIGINT) AS risk_off_days,
  CAST(count_if(market_regime = 'low_vol_uptrend') AS BIGINT) AS low_vol_uptrend_days,
  CAST(count_if(market_regime = 'low_vol_downtrend') AS BIGINT) AS low_vol_downtrend_days,
  CAST(count_if(market_regime = 'neutral') AS BIGINT) AS neutral_days FROM ens GROUP BY ticker""")
def q_regime_counts(spark, sf_dir):
    """D3: days per regime (0 when absent)."""
    t = B.ensemble_table(B.prepare_returns(bars(spark, sf_dir)))
    return finish(regime_counts(t))


def regime_counts(t, keys=KEYS):
    return t.groupBy(*keys).agg(*[
        F.count_if(F.col("market_regime") == r).alias(f"{r}_days")
        for r in ("risk_off", "low_vol_uptrend", "low_vol_downtrend", "neutral")])


@register("chrono_split", sql_with("bars", extra=[returns_cte("bars", "ret")]) + """
SELECT ticker, date, rn <= CAST(floor(n * 0.8) AS BIGINT) AS is_train FROM (
  SELECT ticker, date, row_number() OVER (PARTITION BY ticker ORDER BY date) AS rn,
         count(*) OVER (PARTITION BY ticker) AS n FROM ret) t""")
def q_chrono_split(spark, sf_dir):
    """First int(n * 0.8) rows of every series are training rows."""
    r = B.prepare_returns(bars(spark, sf_dir))
    return finish(chrono_split(r).select("ticker", "date", "is_train"))


def chrono_split(df, train_share: float = 0.8, keys=KEYS):
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return df.withColumn("is_train", X.series_row_number(keys) <= F.floor(n * train_share))
