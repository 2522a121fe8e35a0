"""End-to-end jobs (I22, J17, A14) composed from the operators.

Intermediate tables are written as Parquet to the caller's output folder;
every step is a DataFrame plan, the writes are the only actions besides the
classifier fit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quiver.functions.windows import series_window
from quiver.operators import backtest as B
from quiver.operators import classifier as C
from quiver.operators import evaluation as EV
from quiver.operators import market as M
from quiver.operators import recursions as RC
from quiver.operators import timeseries as TS
from quiver.operators.features import direction_label, log_returns, normalize_price
from quiver.sources import files as IO

FORECAST_WINDOW = 30
PREDICTION_SCHEMA = ("date date, price double, volume double, log_price double, "
                     "log_return double, log_return_squared double, arima_forecast_pct double, "
                     "predicted_direction string, actual_direction string, correct boolean, ticker string")


def predict_frame(prices: DataFrame, window: int = FORECAST_WINDOW) -> DataFrame:
    """I22 core: returns, rolling forecasts on the last ``window`` dates,
    predicted and actual direction (last row counts as DOWN, as in the
    source) and correctness."""
    df = log_returns(normalize_price(prices)).filter(F.col("log_return").isNotNull())
    fc = RC.rolling_forecast(df).select("ticker", "date", F.col("arima_mean_forecast_percent")
                                        .alias("arima_forecast_pct"))
    last = Window.partitionBy("ticker").orderBy(F.col("date").desc())
    w = series_window()
    res = (df.withColumn("_back", F.row_number().over(last)).filter(F.col("_back") <= window)
           .join(fc, ["ticker", "date"], "left")
           .withColumns({"predicted_direction": direction_label("arima_forecast_pct"),
                         "actual_direction": direction_label(F.lead("log_return").over(w))}))
    return res.withColumn("correct", F.col("predicted_direction") == F.col("actual_direction")).drop("_back")


def predict_job(spark: SparkSession, input_path: str, output_path: str) -> DataFrame:
    """Price files -> prediction table (written) + accuracy and next-day call per ticker."""
    prices = IO.read_price_file(spark, input_path).withColumnRenamed("Volume", "volume")
    if "Close" not in prices.columns:
        prices = prices.withColumnRenamed("price", "Close")
    res = predict_frame(prices.select("ticker", "date", "Close", "volume"))
    IO.write_table(res, output_path, fmt="csv")
    table = IO.read_table(spark, output_path, fmt="csv", schema=PREDICTION_SCHEMA)
    acc = table.groupBy("ticker").agg(
        F.avg(F.col("correct").cast("int")).alias("accuracy"),
        F.max_by("arima_forecast_pct", "date").alias("next_day_forecast"))
    return acc.withColumn("next_day_direction", direction_label("next_day_forecast"))


def baseline_report(returns: DataFrame, window: int = 60) -> DataFrame:
    """Summary statistics, stationarity tests, naive and rolling-forecast
    metrics as long rows (ticker, section, metric, value)."""
    r = returns.filter(F.col("log_return").isNotNull())
    summary = r.groupBy("ticker").agg(
        F.avg("log_return").alias("mean"), F.stddev_samp("log_return").alias("std"),
        F.min("log_return").alias("min"), F.max("log_return").alias("max"),
        F.avg((F.col("log_return") > 0).cast("double")).alias("up_share"),
        F.count(F.lit(1)).cast("double").alias("trading_days"))
    series = r.select("ticker", "date", F.col("log_return").alias("value"))
    adf = TS.adf_test(series).select("ticker", F.col("statistic").alias("adf_statistic"),
                                     F.col("p_value").alias("adf_p_value"))
    kpss = TS.kpss_test(series).select("ticker", F.col("statistic").alias("kpss_statistic"),
                                       F.col("p_value").alias("kpss_p_value"))
    w = series_window()
    naive = EV.classification_report(r.select(
        "ticker", F.coalesce(F.lead("log_return").over(w) > 0, F.lit(False)).cast("int").alias("y"),
        (F.col("log_return") > 0).cast("int").alias("yhat")))
    fc = RC.rolling_forecast(r)
    last = Window.partitionBy("ticker").orderBy(F.col("date").desc())
    ev = (r.join(fc, ["ticker", "date"]).withColumn("_b", F.row_number().over(last))
          .filter((F.col("_b") <= window) & F.col("arima_mean_forecast_percent").isNotNull()))
    y = F.col("log_return") * 100.0
    clf = EV.classification_report(ev.select(
        "ticker", F.coalesce(F.lead(y).over(w) > 0, F.lit(False)).cast("int").alias("y"),
        (F.col("arima_mean_forecast_percent") > 0).cast("int").alias("yhat")))
    reg = EV.regression_report(ev.select("ticker", y.alias("y"), F.col("arima_mean_forecast_percent").alias("yhat")))

    def longf(df: DataFrame, section: str) -> DataFrame:
        keys = [c for c in df.columns if c != "ticker"]
        items = F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).cast("double").alias("value")) for k in keys])
        return df.select("ticker", F.lit(section).alias("section"), F.explode(items).alias("_m")).select(
            "ticker", "section", "_m.metric", "_m.value")

    return (longf(summary, "data_summary").unionByName(longf(adf.join(kpss, "ticker"), "stationarity"))
            .unionByName(longf(naive, "naive_direction")).unionByName(longf(clf, "arima_direction"))
            .unionByName(longf(reg, "arima_magnitude")))


def full_pipeline(spark: SparkSession, bars: DataFrame, instruments: DataFrame, out_dir: str,
                  vix_level: float = 25.0) -> DataFrame:
    """Ingest -> returns -> market join -> stationarity -> GARCH ->
    features -> classifier -> forecasts -> regime backtest; every stage
    written under ``out_dir``. Returns the backtest summary."""
    proc = M.join_market_ffill(bars, M.ingest_instruments(instruments))
    IO.write_table(proc, f"{out_dir}/processed")
    proc = spark.read.parquet(f"{out_dir}/processed")
    stat = TS.stationarity_report(proc)
    IO.write_table(stat, f"{out_dir}/stationarity", partition_by=())
    garch = RC.garch_features(proc)
    IO.write_table(garch, f"{out_dir}/garch")
    garch = spark.read.parquet(f"{out_dir}/garch")
    feats = C.feature_matrix(garch)
    IO.write_table(C.sample_blocks(feats), f"{out_dir}/samples")
    samples = spark.read.parquet(f"{out_dir}/samples")
    model = C.train_direction(samples)
    IO.save_params(model.table(spark), f"{out_dir}/model", "direction")
    pred = C.classifier_predictions(model, samples).select("ticker", "date", "predicted_probability_up")
    fc = RC.rolling_forecast(proc)
    market = B.market_regimes(garch, vix_level=vix_level)
    bt = B.regime_backtest_table(pred, fc, market, upper=0.53, lower=0.47, threshold=0.03)
    IO.write_table(bt, f"{out_dir}/backtest")
    summary = B.backtest_summary(spark.read.parquet(f"{out_dir}/backtest"))
    IO.write_table(summary, f"{out_dir}/summary", partition_by=())
    return spark.read.parquet(f"{out_dir}/summary")


def rolling_baseline_pairs(returns: DataFrame, window: int = 60, corrected: bool = False):
    """I12 inputs on the last ``window`` dates with a forecast: direction pairs
    (next day's move vs the forecast sign) and value pairs. The source compares
    the forecast made on day d (for d+1) with day d's return; ``corrected=True``
    compares it with day d+1's return."""
    r = returns.filter(F.col("log_return").isNotNull())
    fc = RC.rolling_forecast(r)
    last = Window.partitionBy("ticker").orderBy(F.col("date").desc())
    w = series_window()
    y = F.col("log_return") * 100.0
    ev = (r.join(fc, ["ticker", "date"]).withColumn("_b", F.row_number().over(last))
          .withColumn("_next", F.lead(y).over(w))
          .filter((F.col("_b") <= window) & F.col("arima_mean_forecast_percent").isNotNull()))
    clf = ev.select("ticker", F.coalesce(F.lead(y).over(w) > 0, F.lit(False)).cast("int").alias("y"),
                    (F.col("arima_mean_forecast_percent") > 0).cast("int").alias("yhat"))
    truth = F.col("_next") if corrected else y
    reg = ev.select("ticker", truth.alias("y"), F.col("arima_mean_forecast_percent").alias("yhat")).na.drop()
    return clf, reg
