"""Registered queries: sources and sinks as round trips over the real tables.

Each builder writes a table derived from the landed data to a fresh folder
under the session's shared checkpoint location, reads it back through the
source under test and returns what it read; the SQL twin computes the
expected content directly.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quiver.operators import backtest as B
from quiver.operators import evaluation as EV
from quiver.operators import recursions as RC
from quiver.operators.features import normalize_price
from quiver.plans.backtest_queries import LAST_CTE, RECOMMENDATION_SQL, ensemble_ctes, reports_from_summary
from quiver.plans.finish import finish
from quiver.plans.market_queries import MCOLS, RATIO_COLS, _market, market_ctes, processed, processed_ctes
from quiver.plans.model_queries import RECENT_FIT, RECENT_FIT_SQL, with_recursive, NAIVE_CTE, _base, clf_sql, naive_pairs
from quiver.plans.registry import register
from quiver.plans.sqltext import rnd
from quiver.session import ensure_checkpoint_dir, shared_path
from quiver.sources import files as IO
from quiver.sources.views import bars, sql_with


def scratch(spark, name: str) -> str:
    ensure_checkpoint_dir(spark)
    return shared_path(spark, f"quiver-io/{name}-{uuid.uuid4().hex[:12]}")


def write_price_files(b, path: str) -> str:
    """Bars as downloaded price files: one folder per ticker, a three-row
    header file plus header-less data files (Close, High, Low, Open, Volume)."""
    data = b.select("ticker", F.date_format("date", "yyyy-MM-dd").alias("Price"),
                    F.col("price").cast("string").alias("Close"), F.lit("").alias("High"),
                    F.lit("").alias("Low"), F.lit("").alias("Open"), F.col("volume").cast("string").alias("Volume"))
    data.write.mode("overwrite").partitionBy("ticker").option("header", "false").csv(path)
    hdr = F.array(
        F.array(*[F.lit(x) for x in ("Price", "Close", "High", "Low", "Open", "Volume")]),
        F.array(F.lit("Ticker"), *[F.col("ticker")] * 5),
        F.array(*[F.lit(x) for x in ("Date", "", "", "", "", "")]))
    heads = (b.select("ticker").distinct().select("ticker", F.posexplode(hdr).alias("_k", "_r"))
             .select("ticker", *[F.col("_r")[i].alias(n) for i, n in
                                 enumerate(("Price", "Close", "High", "Low", "Open", "Volume"))]))
    heads.write.mode("append").partitionBy("ticker").option("header", "false").csv(path)
    return path


@register("read_price_file", sql_with("bars") + """
SELECT ticker, date, round(price, 6) + 0.0 AS price, round(volume, 6) + 0.0 AS volume FROM bars""")
def q_read_price_file(spark, sf_dir):
    """A1 + B1: price files with a three-row header read back by content, Close renamed to price."""
    path = write_price_files(bars(spark, sf_dir), scratch(spark, "prices"))
    got = normalize_price(IO.read_price_file(spark, path))
    return finish(got.select("ticker", "date", "price", F.col("Volume").alias("volume")))


@register("read_table_csv", sql_with("bars") + """
SELECT ticker, date, round(price, 6) + 0.0 AS price, round(volume, 6) + 0.0 AS volume FROM bars""")
def q_read_table_csv(spark, sf_dir):
    """A2: a table written as CSV with a header and read back with an explicit schema."""
    path = scratch(spark, "table") + ".csv"
    IO.write_table(bars(spark, sf_dir), path, fmt="csv", partition_by=())
    got = IO.read_table(spark, path, "ticker string, date date, price double, volume double")
    return finish(got)


_PROCESSED = ["ticker", "date", "price", "volume", *MCOLS, *RATIO_COLS, "log_return"]


@register("write_processed", sql_with("bars", "instruments_long", extra=processed_ctes()) + f"""
SELECT ticker, date, {rnd(_PROCESSED[2:])} FROM processed""")
def q_write_processed(spark, sf_dir):
    """The processed table written as Parquet partitioned by ticker, read back."""
    path = IO.write_table(processed(spark, sf_dir), scratch(spark, "processed"))
    return finish(IO.read_table(spark, path), _PROCESSED)


@register("materialize_once", sql_with("bars") + """
SELECT ticker, date, round(price, 6) + 0.0 AS price FROM bars""")
def q_materialize_once(spark, sf_dir):
    """A second build of an existing output is skipped (mode 'ignore')."""
    path = scratch(spark, "once")
    b = bars(spark, sf_dir).select("ticker", "date", "price")
    IO.materialize_once(b, path)
    IO.materialize_once(b.withColumn("price", F.col("price") * 2), path)
    return finish(IO.read_table(spark, path), ["ticker", "date", "price"])


@register("market_reference_copy", sql_with("instruments_long", extra=market_ctes()) + f"""
SELECT date, {rnd(MCOLS + RATIO_COLS)} FROM mkt""")
def q_market_reference_copy(spark, sf_dir):
    """The instrument table stored unchanged beside the processed one."""
    path = IO.materialize_once(_market(spark, sf_dir), scratch(spark, "market"), partition_by=())
    return finish(IO.read_table(spark, path), ["date", *MCOLS, *RATIO_COLS])


_CLF = ["accuracy", "precision", "recall", "f1"]


@register("json_metrics_io", _base(NAIVE_CTE, clf_sql("np")) + f"SELECT ticker, {rnd(_CLF)} FROM clf")
def q_json_metrics_io(spark, sf_dir):
    """Metrics written as JSON with sorted keys and read back equal."""
    m = EV.classification_report(naive_pairs(B.prepare_returns(bars(spark, sf_dir))))
    path = IO.write_json_sorted(m, scratch(spark, "metrics"))
    got = IO.read_json(spark, path, "accuracy double, f1 double, precision double, recall double, ticker string")
    return finish(got, ["ticker", *_CLF])


def _reports(spark, sf_dir):
    s = B.ensemble_summary(B.ensemble_table(B.prepare_returns(bars(spark, sf_dir))))
    rep = reports_from_summary(s, "2026-01-01 00:00")
    path = IO.write_text_reports(rep, "prediction_report", scratch(spark, "reports"))
    return IO.parse_report(spark, path)


_PARSED_SQL = sql_with("bars", extra=ensemble_ctes("bars") + [LAST_CTE]) + f"""
SELECT ticker, round(ensemble_prob_up, 4) + 0.0 AS probability_up, {RECOMMENDATION_SQL} AS recommendation
FROM last"""


@register("parse_report", _PARSED_SQL)
def q_parse_report(spark, sf_dir):
    """A10: probability and recommendation parsed back from the report text files."""
    return finish(_reports(spark, sf_dir))


@register("serve_table", sql_with("bars", extra=ensemble_ctes("bars") + [LAST_CTE]) + f"""
SELECT ticker, CASE WHEN round(ensemble_prob_up, 4) >= 0.5 THEN 'UP' ELSE 'DOWN' END AS prediction,
  round(ensemble_prob_up, 4) + 0.0 AS probability_up, {RECOMMENDATION_SQL} AS recommendation FROM last""")
def q_serve_table(spark, sf_dir):
    """Response rows (UP when probability >= 0.5) served from the parsed reports."""
    return finish(IO.serve_table(_reports(spark, sf_dir)))


@register("runs_log", _base(NAIVE_CTE, clf_sql("np")) + f"""
SELECT 'naive' AS run_id, ticker, {rnd(_CLF)} FROM clf
UNION ALL SELECT 'naive-again' AS run_id, ticker, {rnd(_CLF)} FROM clf""")
def q_runs_log(spark, sf_dir):
    """Two runs appended to a run log, then compared side by side (pivot)."""
    path = scratch(spark, "runs")
    m = EV.classification_report(naive_pairs(B.prepare_returns(bars(spark, sf_dir))))
    IO.append_run(m, path, "naive", "metric")
    IO.append_run(m, path, "naive-again", "metric")
    return finish(IO.compare_runs(spark, path, _CLF), ["run_id", "ticker", *_CLF])


@register("model_store", with_recursive(*RECENT_FIT) + RECENT_FIT_SQL)
def q_model_store(spark, sf_dir):
    """Fitted GARCH parameters saved with their model type and loaded back (wrong type rejected)."""
    fit = RC.garch_recent_fit(B.prepare_returns(bars(spark, sf_dir)))
    path = IO.save_params(fit, scratch(spark, "garch"), "garch11")
    try:
        IO.load_params(spark, path, "arma11")
        raise AssertionError("a parameter table of the wrong model type was accepted")
    except TypeError:
        pass
    return finish(IO.load_params(spark, path, "garch11"))

