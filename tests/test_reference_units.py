"""Unit tests mirroring the reference's own tests (metrics, identity
features, JSON round trip, service responses, model store)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quiver.operators import evaluation as EV
from quiver.operators.features import build_features
from quiver.sources import files as IO


def _pairs(spark, y, yhat):
    return spark.createDataFrame([("A", int(a), int(b)) for a, b in zip(y, yhat)], "ticker string, y int, yhat int")


def test_build_features_identity(spark):
    df = spark.createDataFrame([(400.0, 405.0, 398.0, 403.0, 1_000_000), (401.0, 406.0, 399.0, 404.0, 1_100_000),
                                (402.0, 407.0, 400.0, 405.0, 1_200_000)],
                               "Open double, High double, Low double, Close double, Volume long")
    out = build_features(df)
    assert out.count() == 3 and out.columns == df.columns and out.schema == df.schema


def test_classification_report_keys_and_perfect(spark):
    r = EV.classification_report(_pairs(spark, [1, 0, 1, 1, 0], [1, 0, 1, 1, 0])).first()
    assert set(r.asDict()) == {"ticker", "accuracy", "precision", "recall", "f1"}
    assert r.accuracy == pytest.approx(1.0) and r.f1 == pytest.approx(1.0)


def test_classification_report_imperfect(spark):
    r = EV.classification_report(_pairs(spark, [1, 0, 1, 0, 1], [1, 0, 0, 0, 1])).first()
    # sklearn weighted averages for this case
    assert r.accuracy == pytest.approx(0.8)
    assert r.precision == pytest.approx(0.8666666666666667)
    assert r.recall == pytest.approx(0.8)
    assert r.f1 == pytest.approx(0.8)
    assert all(isinstance(v, float) for k, v in r.asDict().items() if k != "ticker")


def test_weighted_recall_equals_accuracy(spark):
    r = EV.classification_report(_pairs(spark, [1, 1, 0, 0, 1, 0, 1], [0, 1, 1, 0, 1, 1, 1])).first()
    assert r.recall == pytest.approx(r.accuracy)


def test_zero_division_gives_zero(spark):
    # class 1 is never predicted: its precision is 0, not an error
    pc = EV.per_class(_pairs(spark, [1, 0, 0], [0, 0, 0])).filter("label = 1").first()
    assert pc.precision == 0.0 and pc.f1 == 0.0


def test_regression_report_perfect(spark):
    df = spark.createDataFrame([("A", v, v) for v in (1.0, 2.0, 3.0)], "ticker string, y double, yhat double")
    r = EV.regression_report(df).first()
    assert set(r.asDict()) == {"ticker", "mae", "mse", "rmse", "r2"}
    assert r.mae == pytest.approx(0.0) and r.r2 == pytest.approx(1.0)


def test_regression_report_constant_truth(spark):
    df = spark.createDataFrame([("A", 1.0, 2.0), ("A", 1.0, 1.0)], "ticker string, y double, yhat double")
    assert EV.regression_report(df).first().r2 == 0.0


def test_confusion_matrix_keeps_empty_cells(spark):
    cm = EV.confusion_matrix(_pairs(spark, [1, 1, 1], [1, 1, 0])).orderBy("y", "yhat").collect()
    assert [(r.y, r.yhat, r["count"]) for r in cm] == [(0, 0, 0), (0, 1, 0), (1, 0, 1), (1, 1, 2)]


def test_roc_auc_single_class_is_null(spark):
    df = spark.createDataFrame([("A", 1, 0.2), ("A", 1, 0.7)], "ticker string, y int, p double")
    assert EV.roc_auc(df).first().roc_auc is None


def test_roc_auc_ties(spark):
    df = spark.createDataFrame([("A", 0, 0.1), ("A", 1, 0.1), ("A", 0, 0.3), ("A", 1, 0.8)], "ticker string, y int, p double")
    # pairs: (0.1 vs 0.1) tie 0.5, (0.1 vs 0.8) 1, (0.3 vs 0.1) 0, (0.3 vs 0.8) 1 -> 2.5 / 4
    assert EV.roc_auc(df).first().roc_auc == pytest.approx(0.625)


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([("A", 1), ("A", 1), ("A", 1), ("A", 0)], "ticker string, y int")
    w = {r.label: r.weight for r in EV.class_weights(df).collect()}
    assert w[1] == pytest.approx(4 / 6) and w[0] == pytest.approx(2.0)


def test_json_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(0.87, [0, 1])], "accuracy double, labels array<int>")
    path = IO.write_json_sorted(df, str(tmp_path / "nested" / "metrics"))
    back = IO.read_json(spark, path, "accuracy double, labels array<int>").first()
    assert back.accuracy == 0.87 and back.labels == [0, 1]


def _report(tmp_path, spark, lines):
    d = tmp_path / "ticker=QQQ"
    d.mkdir(parents=True)
    (d / "r.txt").write_text("\n".join(lines))
    return IO.serve_table(IO.parse_report(spark, str(tmp_path))).first()


def test_serve_up(spark, tmp_path):
    r = _report(tmp_path, spark, ["=== NEXT DAY ENSEMBLE PREDICTION ===", "Ensemble Prob UP     : 0.6500",
                                  "Recommendation       : BUY"])
    assert (r.ticker, r.prediction, r.probability_up, r.recommendation) == ("QQQ", "UP", 0.65, "BUY")


def test_serve_down(spark, tmp_path):
    r = _report(tmp_path, spark, ["Ensemble Prob UP : 0.4000", "Recommendation : SELL / SHORT"])
    assert r.prediction == "DOWN" and r.recommendation == "SELL / SHORT"


def test_serve_bad_number_and_missing(spark, tmp_path):
    r = _report(tmp_path, spark, ["Ensemble Prob UP : not-a-number"])
    assert r.probability_up == 0.0 and r.recommendation == "UNKNOWN" and r.prediction == "DOWN"


def test_params_store_rejects_wrong_type(spark, tmp_path):
    df = spark.createDataFrame([("A", 0.1)], "ticker string, alpha double")
    path = IO.save_params(df, str(tmp_path / "p"), "garch11")
    with pytest.raises(TypeError):
        IO.load_params(spark, path, "arma11")
    assert IO.load_params(spark, path, "garch11").first().alpha == 0.1


def test_price_file_header_rows_dropped(spark, tmp_path):
    p = tmp_path / "qqq.csv"
    p.write_text("Price,Close,High,Low,Open,Volume\nTicker,QQQ,QQQ,QQQ,QQQ,QQQ\nDate,,,,,\n"
                 "2024-01-02,400.5,401,399,400,1000\n2024-01-03,bad,401,399,400,1100\n")
    rows = IO.read_price_file(spark, str(p)).orderBy("date").collect()
    assert [r.date for r in rows] == [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    assert rows[0].Close == 400.5 and rows[1].Close is None


def test_price_file_one_row_header_loses_no_data(spark, tmp_path):
    p = tmp_path / "one.csv"
    p.write_text("Date,Close\n2024-01-02,1.0\n2024-01-03,2.0\n2024-01-04,3.0\n")
    assert IO.read_price_file(spark, str(p), columns=("Close",)).count() == 3


def test_materialize_once_keeps_first(spark, tmp_path):
    path = str(tmp_path / "once")
    IO.materialize_once(spark.range(3).withColumn("v", F.lit(1)), path, partition_by=())
    IO.materialize_once(spark.range(5).withColumn("v", F.lit(2)), path, partition_by=())
    assert spark.read.parquet(path).count() == 3


def test_price_file_columns_by_name(spark, tmp_path):
    p = tmp_path / "ohlc.csv"
    p.write_text("Date,Open,High,Low,close,Volume\n2024-01-02,10,12,9,11,1000\n")
    row = IO.read_price_file(spark, str(p)).first()
    assert (row.Close, row.High, row.Low, row.Open, row.Volume) == (11, 12, 9, 10, 1000)
    p = tmp_path / "pv.csv"
    p.write_text("Date,price,volume\n2024-01-02,11,1000\n")
    row = IO.read_price_file(spark, str(p)).first()
    assert (row.price, row.Volume, row.High) == (11, 1000, None)
    p = tmp_path / "none.csv"
    p.write_text("Date,Open\n2024-01-02,11\n")
    with pytest.raises(ValueError):
        IO.read_price_file(spark, str(p))


def test_forecast_orders_general_and_finite(spark):
    import numpy as np

    from quiver.operators import recursions as RC

    day = dt.date(2020, 1, 1)
    cubic = [(7, day + dt.timedelta(i), float(i) ** 3 / 100) for i in range(201)]
    df = spark.createDataFrame(cubic[:-1], "ticker bigint, date date, log_return double")
    got = RC.forecast_orders(df, (0, 3, 0)).orderBy("date").collect()
    assert abs(got[-1].forecast_percent - 200.0 ** 3) < 1e-3  # a bigint key, third differences
    noise = np.random.default_rng(2).normal(size=400) / 100
    df = spark.createDataFrame([(7, day + dt.timedelta(i), float(x)) for i, x in enumerate(noise)], df.schema)
    for order in ((0, 0, 3), (1, 0, 2)):
        out = RC.forecast_orders(df, order).orderBy("date").collect()
        assert all(r.forecast_percent is not None and np.isfinite(r.forecast_percent) for r in out[RC.ARMA_MIN_ROWS:])


def test_absent_instruments_are_skipped_and_empty_bars_fail(spark):
    from quiver.operators import market as M

    day = dt.date(2024, 1, 2)
    long = spark.createDataFrame([(n, day + dt.timedelta(i), 10.0 + i) for n in ("vix", "spy") for i in range(4)], "name string, date date, close double")
    assert M.ingest_instruments(long).count() == 3
    bars = spark.createDataFrame([("A", day, 1.0, 1.0)], "ticker string, date date, price double, volume double")
    assert M.ingest_bars(bars, "A", "2024-01-01", "2025-01-01").count() == 1
    with pytest.raises(ValueError):
        M.ingest_bars(bars, "B", "2024-01-01", "2025-01-01")
