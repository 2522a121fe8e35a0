"""Brute-force checks of the one-pass estimators and statistical tests on
small fixtures, plus the classifier sample builder."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quiver.operators import recursions as RC
from quiver.operators import timeseries as TS

D0 = dt.date(2020, 1, 1)


def _series(spark, x, ticker="A", col="log_return"):
    rows = [(ticker, D0 + dt.timedelta(days=i), float(v)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, f"ticker string, date date, {col} double")


def test_garch_one_pass_equals_refit_per_cutoff(spark):
    rng = np.random.default_rng(1)
    r = rng.standard_t(5, size=90) * 0.01
    W = 40
    for size in (RC.BLOCK_ROWS, 16):  # one block, and blocks whose halo is the rest of the series
        got = {row.date: row.garch_conditional_volatility
               for row in RC.garch_volatility(_series(spark, r), min_window=W, block_rows=size).collect()}
        assert len(got) == len(r) and all(got[D0 + dt.timedelta(days=T)] is None for T in range(W))
        pct = r * 100
        e = np.array([0.0, *[pct[t] - pct[:t].mean() for t in range(1, len(pct))]])
        variances = [pct[:T + 1].var(ddof=1) for T in range(W, len(pct))]
        lo = math.floor((math.log2(min(variances)) - RC.LEVEL_MARGIN) / RC.LEVEL_STEP)
        hi = math.ceil((math.log2(max(variances)) + RC.LEVEL_MARGIN) / RC.LEVEL_STEP)
        for T in range(W, len(r), 7):
            # brute force: every grid point on the prefix through T on its own, pick the best
            best = None
            for a, b in RC.GARCH_GRID:
                for j in range(lo, hi + 1):
                    level = 2.0 ** (RC.LEVEL_STEP * j)
                    s2, ll, final = level, 0.0, level
                    for t in range(T + 1):
                        if t:
                            s2 = level * (1 - a - b) + a * e[t - 1] ** 2 + b * s2
                            final = level * (1 - a - b) + a * (pct[t - 1] - pct[:T + 1].mean()) ** 2 + b * final
                        ll -= 0.5 * (math.log(s2) + e[t] ** 2 / s2)
                    if best is None or round(ll, 6) > best[0]:
                        best = (round(ll, 6), math.sqrt(final))
            assert got[D0 + dt.timedelta(days=T)] == pytest.approx(best[1], rel=1e-9)


def test_arma_one_pass_equals_refit_per_cutoff(spark):
    rng = np.random.default_rng(2)
    e = rng.normal(size=120)
    y = np.zeros(120)
    for t in range(1, 120):
        y[t] = 0.5 * y[t - 1] + e[t] + 0.3 * e[t - 1]
    r = y / 100.0 + 0.01
    pct = r * 100

    def residuals(x, phi, theta, mean):
        out = np.zeros(len(x))
        for t in range(1, len(x)):
            out[t] = x[t] - mean - phi * (x[t - 1] - mean) - theta * out[t - 1]
        return out

    for size in (RC.BLOCK_ROWS, 25):
        got = {row.date: row.arima_mean_forecast_percent
               for row in RC.rolling_forecast(_series(spark, r), block_rows=size).collect()}
        assert len(got) == 120 and got[D0 + dt.timedelta(days=58)] is None
        for T in range(59, 120, 30):
            x, best = pct[:T + 1], None
            for phi, theta in RC.ARMA_GRID:
                # residuals are linear in the mean: two runs give the line, least squares the mean
                a = residuals(x, phi, theta, 0.0)
                c = a - residuals(x, phi, theta, 1.0)
                mean = float(a @ c / (c @ c))
                own = residuals(x, phi, theta, mean)
                sse = round(float(own @ own), 6)
                if best is None or sse < best[0]:
                    best = (sse, mean + phi * (x[-1] - mean) + theta * own[-1])
            assert got[D0 + dt.timedelta(days=T)] == pytest.approx(best[1], rel=1e-7)


def test_forecasts_follow_a_mean_that_moves(spark):
    rng = np.random.default_rng(8)
    y = rng.normal(size=1500)
    y[300:] += 3.0
    got = RC.rolling_forecast(_series(spark, y / 100)).orderBy("date").collect()
    f = np.array([np.nan if r.arima_mean_forecast_percent is None else r.arima_mean_forecast_percent for r in got])
    plain = np.array([y[:t + 1].mean() for t in range(len(y))])
    late = slice(300, len(y) - 1)
    assert np.mean((y[1:][late] - f[:-1][late]) ** 2) <= np.mean((y[1:][late] - plain[:-1][late]) ** 2)
    assert f[600:].mean() > 2.6  # a mean frozen at the first 60 rows gives 2.5


def test_volatility_follows_a_scale_that_moves(spark):
    rng = np.random.default_rng(9)
    y = rng.normal(size=2600)
    y[500:] *= 5.0
    got = RC.garch_volatility(_series(spark, y / 100)).orderBy("date").collect()
    vol = np.array([r.garch_conditional_volatility for r in got[1000:]])
    assert vol.mean() == pytest.approx(5.0, rel=0.05)


def test_awkward_series(spark):
    rows = [("A", D0 + dt.timedelta(days=i), 0.0) for i in range(70)] + [(None, D0, 0.1), ("B", D0, None), ("C", D0, 0.2)]
    df = spark.createDataFrame(rows, "ticker string, date date, log_return double")
    f = {(r.ticker, r.date): r.arima_mean_forecast_percent for r in RC.rolling_forecast(df).collect()}
    assert len(f) == 72 and f["A", D0 + dt.timedelta(days=69)] == pytest.approx(0.0) and f[None, D0] is None
    v = RC.garch_volatility(df, min_window=20).collect()
    assert len(v) == 72 and all(r.garch_conditional_volatility is None for r in v)
    assert RC.rolling_forecast(df.limit(0)).count() == 0 and RC.garch_volatility(df.limit(0)).count() == 0


def test_a_long_series_spreads_over_tasks(spark):
    """A million rows of one ticker: no group holds more than a block and its halo."""
    n = 1_000_000
    df = spark.range(n).select(F.lit("A").alias("ticker"), F.date_add(F.lit("1970-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
                               (F.randn(3) / 100).alias("log_return"))
    sizes = RC.row_blocks(RC.garch_rows(df, 500, ["ticker"], "log_return")).groupBy("block").count()
    assert sizes.agg(F.max("count"), F.count("*")).first() == (RC.BLOCK_ROWS + RC.HALO, n // RC.BLOCK_ROWS + 1)
    out = RC.garch_volatility(df).agg(F.count("garch_conditional_volatility"), F.avg("garch_conditional_volatility")).first()
    assert out[0] == n - 500 and out[1] == pytest.approx(1.0, rel=0.05)


def test_sig_round_over_all_magnitudes(spark):
    from quiver.functions.scalar import sig_round
    xs = [1.23456789123e-140, 1.23456789123e140, -9.87654321987e300, 0.0]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(sig_round("x")).collect()]
    assert got == [pytest.approx(float(f"{x:.7e}"), rel=1e-12) for x in xs]


def _kpss_numpy(x):
    n = len(x)
    e = x - x.mean()
    covlags = int(n ** (2.0 / 9.0))
    s0 = (e ** 2).sum() / n
    s1 = 0.0
    for i in range(1, covlags + 1):
        p = np.dot(e[i:], e[:n - i]) / (n / 2.0)
        s0 += p
        s1 += i * p
    lags = min(int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3)), n - 1)
    s = (e ** 2).sum()
    for i in range(1, lags + 1):
        s += 2 * np.dot(e[i:], e[:n - i]) * (1 - i / (lags + 1.0))
    stat = ((np.cumsum(e) ** 2).sum() / n ** 2) / (s / n)
    return stat, float(np.interp(stat, TS.KPSS_CRIT, TS.KPSS_PVALS)), lags


@pytest.mark.parametrize("kind", ["noise", "trend"])
def test_kpss_matches_numpy(spark, kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=300) + (np.linspace(0, 3, 300) if kind == "trend" else 0)
    df = _series(spark, x, col="value")
    r = TS.kpss_test(df).first()
    stat, p, lags = _kpss_numpy(x)
    assert r.statistic == pytest.approx(stat, rel=1e-9)
    assert r.p_value == pytest.approx(p, rel=1e-9) and r.lags_used == lags


def test_kpss_of_a_million_rows(spark):
    """Beyond 262,144 rows the first stage has over 15 lags."""
    n = 1_000_000
    df = spark.range(n).select(F.lit("A").alias("ticker"), F.date_add(F.lit("1970-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
                               (F.sin(F.col("id") / 3.0) + F.randn(5)).alias("value")).cache()
    x = np.array([r.value for r in df.orderBy("date").select("value").collect()])
    e = x - x.mean()
    gamma = [np.dot(e[j:], e[:n - j]) for j in range(1, int(n ** (2.0 / 9.0)) + 1)]
    s0 = (e @ e) / n + sum(g / (n / 2.0) for g in gamma)
    s1 = sum(j * g / (n / 2.0) for j, g in enumerate(gamma, 1))
    lags = min(int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3)), n - 1)
    total = e @ e + sum(2 * np.dot(e[j:], e[:n - j]) * (1 - j / (lags + 1.0)) for j in range(1, lags + 1))
    r = TS.kpss_test(df).first()
    assert len(gamma) > 15 and r.lags_used == lags and r.observations == n
    assert r.statistic == pytest.approx(((np.cumsum(e) ** 2).sum() / n ** 2) / (total / n), rel=1e-6)


def test_adf_matches_numpy_ols(spark):
    rng = np.random.default_rng(4)
    x = np.cumsum(rng.normal(size=250)) * 0.1 + rng.normal(size=250)
    r = TS.adf_test(_series(spark, x, col="value")).first()
    n = len(x)
    maxlag = min(int(math.ceil(12 * (n / 100) ** 0.25)), n // 2 - 2)
    xd = np.diff(x)

    def design(L):
        m = len(xd) - L
        cols = [np.ones(m), x[L:L + m]] + [xd[L - j:L - j + m] for j in range(1, L + 1)]
        return xd[L:], np.column_stack(cols)

    y, X = design(maxlag)
    best = min((-2 * (-len(y) / 2 * (math.log(2 * math.pi) + math.log(
        float(np.sum((y - X[:, :p + 2] @ np.linalg.lstsq(X[:, :p + 2], y, rcond=None)[0]) ** 2)) / len(y)) + 1))
        + 2 * (p + 2), p) for p in range(maxlag + 1))[1]
    y, X = design(best)
    b = np.linalg.lstsq(X, y, rcond=None)[0]
    s2 = float(np.sum((y - X @ b) ** 2)) / (len(y) - X.shape[1])
    t = b[1] / math.sqrt(s2 * np.linalg.inv(X.T @ X)[1, 1])
    assert r.lags_used == best and r.observations == len(y)
    assert r.statistic == pytest.approx(t, rel=1e-7)
    assert r.p_value == pytest.approx(TS.mackinnon_p(t), rel=1e-9)


def test_mackinnon_surface_edges():
    assert TS.mackinnon_p(3.0) == 1.0 and TS.mackinnon_p(-20.0) == 0.0
    assert 0.0 < TS.mackinnon_p(-2.86) < 0.1 < TS.mackinnon_p(-1.0) < 1.0


def test_acf_pacf_match_yule_walker(spark):
    rng = np.random.default_rng(5)
    e = rng.normal(size=400)
    x = np.zeros(400)
    for t in range(2, 400):
        x[t] = 0.5 * x[t - 1] - 0.3 * x[t - 2] + e[t]
    df = _series(spark, x, col="value")
    acf = {r.lag: r.acf for r in TS.acf(df, nlags=10).collect()}
    c = x - x.mean()
    ref = [np.dot(c[k:], c[:len(c) - k]) / np.dot(c, c) for k in range(11)]
    assert all(acf[k] == pytest.approx(ref[k], abs=1e-12) for k in range(11))
    pac = {r.lag: r.pacf for r in TS.pacf(df, nlags=10).collect()}
    for k in (1, 2, 5):
        R = np.array([[ref[abs(i - j)] for j in range(k)] for i in range(k)])
        phi = np.linalg.solve(R, np.array(ref[1:k + 1]))
        assert pac[k] == pytest.approx(phi[-1], abs=1e-10)


def test_lookback_windows_shape_and_order(spark):
    from quiver.operators import classifier as C
    rows = [("A", D0 + dt.timedelta(days=i), float(i), float(10 * i)) for i in range(8)]
    df = spark.createDataFrame(rows, "ticker string, date date, f1 double, f2 double")
    w = C.lookback_windows(df, ["f1", "f2"], lookback=3).orderBy("date").collect()
    assert len(w) == 5  # rows 3..7
    assert w[0].features == [0.0, 0.0, 1.0, 10.0, 2.0, 20.0]
    short = spark.createDataFrame(rows[:2], "ticker string, date date, f1 double, f2 double")
    assert C.lookback_windows(short, ["f1", "f2"], lookback=3).count() == 0


def _two_stage(x, p, q, long_ar):
    """Forecast of the next x from all of x: both regressions by lstsq on every prefix."""
    def fit(rows, y):
        return np.linalg.lstsq(np.array(rows), np.array(y), rcond=None)[0]

    n = len(x)
    e = np.full(n, np.nan)
    if q:
        z = {t: np.array([1.0, *x[t - long_ar:t][::-1]]) for t in range(long_ar, n)}
        for t in range(2 * (long_ar + 1) + long_ar, n):
            e[t] = x[t] - z[t] @ fit([z[s] for s in range(long_ar, t)], [x[s] for s in range(long_ar, t)])

    def row(t):
        return [1.0, *[x[t - i] for i in range(1, p + 1)], *[e[t - i] for i in range(1, q + 1)]]

    use = [t for t in range(p, n) if t >= q and np.isfinite(row(t)).all()]
    return float(np.array(row(n)) @ fit([row(t) for t in use], [x[t] for t in use]))


@pytest.mark.parametrize("order", [(1, 1, 0), (2, 0, 2), (0, 2, 1)])
def test_forecast_orders_equal_regressions_per_cutoff(spark, order):
    p, d, q = order
    rng = np.random.default_rng(6)
    r = np.cumsum(rng.normal(size=130)) / 100.0 if d else rng.normal(size=130) / 100.0
    df = _series(spark, r)
    y = r * 100
    for size in (RC.BLOCK_ROWS, 20):
        got = {row.date: row.forecast_percent for row in RC.forecast_orders(df, order, long_ar=5, block_rows=size).collect()}
        assert len(got) == 130 and got[D0 + dt.timedelta(days=d + 58)] is None
        for T in (d + 59, 100, 129):
            expect = _two_stage(np.diff(y[:T + 1], n=d), p, q, 5)
            for i in range(d):  # undo the differences
                expect += np.diff(y[:T + 1], n=i)[-1]
            assert got[D0 + dt.timedelta(days=T)] == pytest.approx(expect, rel=1e-5, abs=1e-6)


def test_forecast_orders_come_near_the_true_model(spark):
    """ARMA(2, 2): squared error within 5 % of the forecasts that know the parameters."""
    rng = np.random.default_rng(12)
    n, phi, theta = 4000, (0.5, -0.3), (0.4, 0.2)
    e, y = rng.normal(size=n), np.zeros(n)
    for t in range(2, n):
        y[t] = 1.0 + phi[0] * (y[t - 1] - 1) + phi[1] * (y[t - 2] - 1) + e[t] + theta[0] * e[t - 1] + theta[1] * e[t - 2]
    f = np.array([r.forecast_percent for r in RC.forecast_orders(_series(spark, y / 100)).orderBy("date").collect()], float)
    assert np.mean((y[1001:] - f[1000:-1]) ** 2) < 1.05 * np.mean(e[1001:] ** 2)


def _features(spark, n=260, tickers=("A", "B"), seed=7):
    """Two features and a target that the features of the row before foretell."""
    rng = np.random.default_rng(seed)
    rows = []
    for t in tickers:
        x = rng.normal(size=(n, 2)) * [1.0, 5.0] + [0.0, 100.0]
        y = (np.concatenate(([0.0], x[:-1, 0])) + 0.5 * rng.normal(size=n) > 0).astype(int)
        rows += [(t, D0 + dt.timedelta(days=i), float(x[i, 0]), float(x[i, 1]), int(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "ticker string, date date, f1 double, f2 double, target int")


def _numpy_samples(df, lookback):
    """All lookback samples of every ticker by plain NumPy: X, y, weight, use, key."""
    out = []
    for t, g in df.toPandas().sort_values("date").groupby("ticker"):
        n, cut = len(g), math.floor(len(g) * 0.8)
        x, y = g[["f1", "f2"]].to_numpy(), g["target"].to_numpy()
        sd = x[:cut].std(axis=0)
        x = (x - x[:cut].mean(axis=0)) / np.where(sd == 0, 1, sd)
        train = np.arange(lookback, cut)
        for i in range(lookback, n):
            k = i - lookback + 1
            use = 3 if i >= cut else 2 if k > math.floor(len(train) * 0.8) else 1
            same, classes = (y[train] == y[i]).sum(), len(set(y[train]))
            out.append((x[i - lookback:i].ravel(), y[i], len(train) / (classes * same) if same else 1.0, use, (t, g["date"].iloc[i])))
    return out


def _numpy_fit(samples, epochs, patience, rate, l2):
    X, y, c, use = (np.array([s[k] for s in samples]) for k in range(4))
    w = np.zeros(X.shape[1] + 1)
    one = np.column_stack((X, np.ones(len(X))))
    m, v = np.zeros_like(w), np.zeros_like(w)
    train, val = use == 1, use == 2
    best, history = (math.inf, 0, w), []

    def bce(w):
        z = one @ w
        return np.log1p(np.exp(z)) - y * z

    for e in range(epochs + 1):
        n = train.sum()
        loss = bce(w)
        if e:
            history.append((e, (c * loss)[train].sum() / n + l2 / 2 * (w[:-1] ** 2).sum(), loss[val].mean()))
            if history[-1][2] < best[0]:
                best = (history[-1][2], e, w)
            elif e - best[1] >= patience:
                break
        g = one[train].T @ (c * (1 / (1 + np.exp(-one @ w)) - y))[train] / n + l2 * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** (e + 1))) / (np.sqrt(v / (1 - 0.999 ** (e + 1))) + 1e-8)
    return best, history


def test_epochs_agree_with_a_numpy_fit_and_stop_early(spark):
    from quiver.operators import classifier as C

    df = _features(spark)
    for lookback, block in ((3, 512), (7, 32)):
        blocks = C.sample_blocks(df, ["f1", "f2"], lookback=lookback, block=block).cache()
        samples = _numpy_samples(df, lookback)
        got = blocks.select("ticker", F.explode(F.arrays_zip("date", "use", "weight", "row")).alias("r"), "begin").where("r.row >= begin")
        assert sorted((r.ticker, r.r.date, r.r.use, round(r.r.weight, 9)) for r in got.collect() if r.r.use) == sorted(
            (*s[4], s[3], round(s[2], 9)) for s in samples)
        model = C.train_direction(blocks, 2, lookback, epochs=60, patience=4, rate=0.3, l2=1e-3)
        best, history = _numpy_fit(samples, 60, 4, 0.3, 1e-3)
        assert len(model.history) == len(history) < 60 and model.best_epoch == best[1]
        assert np.allclose(np.array(model.history, float), np.array(history), atol=1e-9)
        assert np.allclose(np.append(model.weights.ravel(), model.intercept), best[2], atol=1e-9)
        loss = {r.epoch: r for r in C.training_history(spark, model).collect()}
        assert loss[best[1]].best and sum(r.best for r in loss.values()) == 1
        p = {(r.ticker, r.date): r.predicted_probability_up for r in C.classifier_predictions(model, blocks).collect()}
        for x, _, _, use, key in samples:
            assert (key in p) == (use == 3)
            if use == 3:
                assert p[key] == pytest.approx(1 / (1 + math.exp(-(x @ best[2][:-1] + best[2][-1]))), abs=1e-9)
        back = C.DirectionModel.from_table(model.table(spark))
        assert np.array_equal(back.weights, model.weights) and back.intercept == model.intercept


def test_next_day_probability_uses_the_last_rows(spark):
    from quiver.operators import classifier as C

    for n in (63, 64, 65, 96):  # the window ends before, at and after a block's border
        df = _features(spark, n, ("A",))
        blocks = C.sample_blocks(df, ["f1", "f2"], lookback=5, block=32)
        model = C.DirectionModel(np.arange(10.0).reshape(5, 2) / 10 - 0.4, 0.1, [], 1)
        row, = C.next_day_probability(model, blocks).collect()
        x = C.standardize(C.chrono_flags(df), ["f1", "f2"]).orderBy("date").select("f1", "f2").toPandas().to_numpy()[-5:]
        assert row.date == D0 + dt.timedelta(days=n - 1)
        assert row.lstm_garch_probability_up == pytest.approx(1 / (1 + math.exp(-(float((x * model.weights).sum()) + 0.1))), rel=1e-9)
    assert C.next_day_probability(model, C.sample_blocks(_features(spark, 4, ("A",)), ["f1", "f2"], lookback=5)).count() == 0


def test_training_of_awkward_input(spark):
    from quiver.operators import classifier as C

    short = C.sample_blocks(_features(spark, 4), ["f1", "f2"], lookback=5)
    model = C.train_direction(short, 2, 5)
    assert model.history == [] and not model.weights.any() and C.classifier_predictions(model, short).count() == 0
    one_class = C.sample_blocks(_features(spark, 80).withColumn("target", F.lit(1)), ["f1", "f2"], lookback=5, validation=0.0)
    model = C.train_direction(one_class, 2, 5, epochs=3)
    assert [h[2] for h in model.history] == [None] * 3 and model.best_epoch == 3 and model.intercept > 0


def test_sample_table_is_not_a_table_of_windows(spark):
    """Each row is stored once, and the lookback rows of a block a second time."""
    from quiver.operators import classifier as C

    n = 2000
    blocks = C.sample_blocks(_features(spark, n, ("A",)), ["f1", "f2"], lookback=30)
    values = blocks.agg(F.sum(F.size("x"))).first()[0]
    assert 2 * n <= values <= 2 * n * 1.1
