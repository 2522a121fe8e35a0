"""Edge fixtures, golden rows and invariants of the window operators."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from quiver.operators import backtest as B
from quiver.operators import features as X
from quiver.operators import market as M
from tests.conftest import SF01, series_df

D0 = dt.date(2024, 1, 1)


def day(i):
    return D0 + dt.timedelta(days=i)


# Golden rows: consecutive closes of the reference's checked-in prediction
# file with their expected log price / return / square and direction labels.
GOLDEN = [
    ("2024-11-15", 492.647705078125, 6.199794324436564, None, 0.310468962088686),
    ("2024-11-18", 496.0704650878906, 6.206717983343865, 0.006923658907301622, -0.046564025153708374),
    ("2024-11-19", 499.4832763671875, 6.213574116781744, 0.006856133437878498, 0.02527950946600291),
    ("2024-11-20", 499.1955871582031, 6.212997977188829, -0.0005761395929146929, 0.08888934834715702),
    ("2024-11-21", 500.9913024902344, 6.21658874063524, 0.0035907634464109606, 0.032936561373523625),
    ("2024-11-22", 501.79486083984375, 6.218191392428789, 0.0016026517935490148, 0.0647890516463576),
]
GOLDEN_LABELS = [("UP", "UP", True), ("DOWN", "UP", False), ("UP", "DOWN", False), ("UP", "UP", True),
                 ("UP", "UP", True)]


def test_golden_log_returns_and_directions(spark):
    rows = [("QQQ", dt.date.fromisoformat(d), p, f) for d, p, _, _, f in GOLDEN]
    df = spark.createDataFrame(rows, "ticker string, date date, price double, forecast double")
    out = X.log_returns(df).withColumns({
        "pred": X.direction_label("forecast"),
        "act": X.direction_label(F.lead("log_return").over(X.series_window())),
    }).orderBy("date").collect()
    for r, (_, _, lp, lr, _) in zip(out, GOLDEN):
        assert r.log_price == pytest.approx(lp, abs=1e-12)
        if lr is not None:
            assert r.log_return == pytest.approx(lr, abs=1e-12)
            assert r.log_return_squared == pytest.approx(lr * lr, abs=1e-15)
    for r, (pred, act, ok) in zip(out[:5], GOLDEN_LABELS):
        assert (r.pred, r.act, r.pred == r.act) == (pred, act, ok)


def test_zero_negative_and_null_prices_give_null_not_nan(spark):
    df = series_df(spark, [("A", day(0), 10.0, 1.0), ("A", day(1), 0.0, 1.0), ("A", day(2), -5.0, 1.0),
                           ("A", day(3), None, 1.0), ("A", day(4), 12.0, 1.0)])
    out = X.log_returns(df).orderBy("date").collect()
    assert out[1].log_price is None and out[2].log_price is None and out[3].log_price is None
    assert all(r.log_return is None for r in out[1:])
    assert not any(isinstance(v, float) and math.isnan(v) for r in out for v in r)


def test_guarded_rolling_needs_full_window(spark):
    df = series_df(spark, [("A", day(i), float(100 + i), 1.0) for i in range(8)])
    out = X.rolling_stats(X.log_returns(df)).orderBy("date").collect()
    assert [r.rolling_mean_5 is None for r in out] == [True] * 5 + [False] * 3
    assert all(r.rolling_std_20 is None for r in out)


def test_null_inside_window_blanks_the_window(spark):
    prices = [100.0, 101.0, 102.0, None, 104.0, 105.0, 106.0, 107.0, 108.0, 109.0, 110.0, 111.0]
    df = series_df(spark, [("A", day(i), p, 1.0) for i, p in enumerate(prices)])
    out = X.momentum(X.log_returns(df), (3,)).orderBy("date").collect()
    # returns at rows 3 and 4 are missing -> any 3-row window touching them is missing
    assert [r.momentum_3 is None for r in out] == [True] * 7 + [False] * 5


def test_constant_series_volatility_ratio_is_null(spark):
    df = series_df(spark, [("A", day(i), 50.0, 1.0) for i in range(30)])
    out = X.volatility_ratio(X.rolling_stats(X.log_returns(df))).orderBy("date").collect()
    assert out[-1].rolling_std_20 == 0.0 and out[-1].volatility_ratio is None


def test_next_day_target_last_row_zero_or_null(spark):
    df = series_df(spark, [("A", day(i), float(100 + i), 1.0) for i in range(4)])
    lr = X.log_returns(df)
    faithful = X.next_day_target(lr).orderBy("date").collect()
    corrected = X.next_day_target(lr, corrected=True).orderBy("date").collect()
    assert faithful[-1].target == 0 and corrected[-1].target is None


def test_one_row_ticker(spark):
    df = series_df(spark, [("ONE", day(0), 10.0, 1.0)])
    t = B.ensemble_table(B.prepare_returns(df))
    assert t.count() == 0
    assert B.hit_rate(t).count() == 0


def test_forward_fill_and_asof(spark):
    left = spark.createDataFrame([("A", day(i)) for i in range(5)], "ticker string, date date")
    right = spark.createDataFrame([("A", day(1), 1.0), ("A", day(3), 3.0)], "ticker string, date date, v double")
    got = [r.v for r in M.asof_fill(left, right, "v").orderBy("date").collect()]
    assert got == [None, 1.0, 1.0, 3.0, 3.0]
    j = left.join(right, ["ticker", "date"], "left")
    assert [r.v for r in X.forward_fill(j, ["v"]).orderBy("date").collect()] == got


def test_ohlcv_bars(spark):
    t = spark.createDataFrame([
        ("A", dt.datetime(2024, 1, 1, 9, 5), 10.0, 1), ("A", dt.datetime(2024, 1, 1, 9, 50), 12.0, 2),
        ("A", dt.datetime(2024, 1, 1, 9, 20), 8.0, 3), ("A", dt.datetime(2024, 1, 1, 10, 1), 9.0, 4)],
        "ticker string, ts timestamp, value double, event_id long")
    bars = M.ohlcv_bars(t).orderBy("hour").collect()
    assert (bars[0].open, bars[0].high, bars[0].low, bars[0].close, bars[0].volume) == (10.0, 12.0, 8.0, 12.0, 3)
    assert bars[1].volume == 1


def _ens(spark, sf=SF01):
    from quiver.sources.views import bars
    return B.ensemble_table(B.prepare_returns(bars(spark, sf)))


def test_no_look_ahead_in_window_features(spark):
    """Truncating the future never changes a past row of any window feature."""
    from quiver.sources.views import bars
    full = B.ensemble_table(B.prepare_returns(bars(spark, SF01)))
    cut = B.ensemble_table(B.prepare_returns(bars(spark, SF01).filter(F.col("date") <= "1999-06-30")))
    cols = ["rolling_std_20", "vol_cutoff", "market_regime", "ensemble_prob_up", "position", "cum_strategy"]
    a = full.filter(F.col("date") <= "1999-06-30").select("ticker", "date", *cols)
    b = cut.select("ticker", "date", *cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_equity_and_drawdown_invariants(spark):
    t = B.drawdown_curve(_ens(spark))
    assert t.filter(F.col("drawdown") > 1e-12).count() == 0
    first = t.withColumn("_k", F.row_number().over(X.series_window())).filter("_k = 1")
    bad = first.filter(F.abs(F.col("cum_buyhold") - F.exp("log_return")) > 1e-9 * F.col("cum_buyhold"))
    assert bad.count() == 0
