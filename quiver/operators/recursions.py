"""Expanding-window model fits as one pass per series (grid estimators).

The reference refits a time-series model on every prefix of the history
(O(n^2) work, one process). Here the residual and variance recursions of a
fixed parameter point are run once, and running scores over them give the best
point at *every* cutoff. Means and scales are those of the cutoff, too:

* ARMA residuals are linear in the mean, e_t = a_t - mean * c_t, so running
  sums of a^2, a*c and c^2 give the best mean and its squared error at every
  cutoff in closed form.
* GARCH variances are linear in the long-run variance and, for the constant
  mean, quadratic: s2_t = level * k_t + p_t - 2 * mean * q_t + mean^2 * v_t.
  The likelihood ranks a grid of (alpha, beta, level); levels are powers of
  two apart by ``LEVEL_STEP`` around the running variances. Its residuals
  take the mean of the rows before; the reported variance takes the mean of
  all rows up to the cutoff.

This is a grid estimator: it answers the same question with the same shape
as the maximum-likelihood fits, not with the libraries' exact numbers.

Series are cut into blocks of ``BLOCK_ROWS`` rows, each with the ``HALO`` rows
before it. No coefficient exceeds 0.94, and 0.94 ** HALO is below the last bit
of a double, so a recursion started at the halo has forgotten its start when
the block begins: blocks run in parallel, whatever the length of the series.
Scores are summed per block, added up in order by a window over (series,
point), and a second pass over the blocks goes on from these sums.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quiver.functions.windows import KEYS, expanding, series_window

#: Rows of a block, and rows before it that its recursions start from.
BLOCK_ROWS, HALO = 2048, 600

# The GARCH(1,1) grid (alpha, beta) with alpha + beta < 1; the last
# points, of persistence 0.998, are those that fit a scale that moves for good.
GARCH_GRID = (*((a, b) for a in (0.05, 0.1, 0.2) for b in (0.6, 0.7, 0.8, 0.9, 0.94) if round(a + b, 9) < 1.0),
              (0.058, 0.94), (0.098, 0.9), (0.198, 0.8))
# The ARMA(1,1) grid, phi and theta from -0.9 to 0.9 in steps of 0.1.
ARMA_STEPS = tuple(round(-0.9 + 0.1 * k, 1) for k in range(19))
ARMA_GRID = tuple((phi, theta) for phi in ARMA_STEPS for theta in ARMA_STEPS)
GARCH_MIN_WINDOW = 500
ARMA_MIN_ROWS = 60
#: Long-run variances are 2 ** (LEVEL_STEP * j), from the smallest running variance / 2 ** LEVEL_MARGIN to the largest * 2 ** LEVEL_MARGIN.
LEVEL_STEP, LEVEL_MARGIN = 0.5, 4


def _best_by(score: np.ndarray, maximize: bool) -> np.ndarray:
    """Best grid point per row, ranking on the score rounded to 6 decimals and
    breaking ties by the lower point id (the rule shared with the SQL twin)."""
    s = np.round(score, 6)
    return np.argmax(s, axis=1) if maximize else np.argmin(s, axis=1)


def row_blocks(df: DataFrame, size: int = BLOCK_ROWS, halo: int = HALO) -> DataFrame:
    """``df`` (with ``row``, counted from 0 per series) with ``block``; the last
    ``halo`` rows before a block are there a second time, as its rows."""
    own = F.floor(F.col("row") / size)
    ahead = F.floor((F.col("row") + halo) / size)
    return df.withColumn("block", F.explode(F.sequence(own, ahead)))


def _by_blocks(blocks: DataFrame, keys: Sequence[str], totals, emit, sums: Sequence[str], out_schema: str) -> DataFrame:
    """Two passes over (series, block) groups: ``totals`` gives rows (point,
    *sums) of a block, ``emit`` its output from the sums of all blocks before."""
    kinds = ", ".join(f"{k} {blocks.schema[k].dataType.simpleString()}" for k in keys)
    part = blocks.groupBy(*keys, "block").applyInPandas(
        totals, f"{kinds}, block bigint, point int, {', '.join(f'{c} double' for c in sums)}")
    before = Window.partitionBy(*keys, "point").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = part.select(*keys, "block", "point", *[F.coalesce(F.sum(c).over(before), F.lit(0.0)).alias(c) for c in sums])
    return blocks.groupBy(*keys, "block").cogroup(starts.groupBy(*keys, "block")).applyInPandas(emit, f"{kinds}, {out_schema}")


def _block_rows(pdf: pd.DataFrame, size: int) -> tuple[pd.DataFrame, int]:
    """The rows in order and the number of halo rows before the block's own."""
    pdf = pdf.sort_values("row").reset_index(drop=True)
    return pdf, int((pdf["row"] < pdf["block"].iloc[0] * size).sum())


def _totals_frame(pdf: pd.DataFrame, keys: Sequence[str], **sums: np.ndarray) -> pd.DataFrame:
    n = len(next(iter(sums.values())))
    first = {k: pd.Series([pdf[k].iloc[0]] * n, dtype=object) for k in keys}
    return pd.DataFrame({**first, "block": np.full(n, pdf["block"].iloc[0]), "point": np.arange(n, dtype=np.int32), **sums})


# -- GARCH(1,1) ---------------------------------------------------------------
def _garch_paths(pdf: pd.DataFrame, halo: int, grid=GARCH_GRID) -> dict[str, np.ndarray]:
    """Coefficient paths of a block's own rows: k, p, q, v [rows, (alpha, beta)], the
    likelihood's own p from its residuals, and the residuals e."""
    a, b = np.array([g[0] for g in grid]), np.array([g[1] for g in grid])
    r, e = pdf["r"].to_numpy(float), pdf["e"].to_numpy(float)
    state, paths = np.zeros((3, len(grid))), np.zeros((len(r), 3, len(grid)))
    inputs = np.stack((e * e, r * r, r), 1)
    for t in range(1, len(r)):
        state = a * inputs[t - 1][:, None] + b * state
        paths[t] = state
    paths, t = paths[halo:], pdf["row"].to_numpy(float)[halo:, None]
    gone = b ** t
    u = (1.0 - gone) / (1.0 - b)
    return {"k": (1.0 - a - b) * u + gone, "own": paths[:, 0], "p": paths[:, 1], "q": paths[:, 2], "v": a * u,
            "e": e[halo:]}


def _garch_scores(x: dict[str, np.ndarray], levels: np.ndarray) -> np.ndarray:
    """Log-likelihood terms [rows, (alpha, beta) x level]."""
    s2 = x["k"][:, :, None] * levels + x["own"][:, :, None]
    ll = -0.5 * (np.log(s2) + (x["e"] * x["e"])[:, None, None] / s2)
    return ll.reshape(len(ll), -1)


def _levels(pdf: pd.DataFrame) -> np.ndarray:
    lo, hi = pdf["level_lo"].iloc[0], pdf["level_hi"].iloc[0]
    return np.zeros(0) if pd.isna(lo) or pd.isna(hi) else 2.0 ** (LEVEL_STEP * np.arange(lo, hi + 1))


def garch_rows(returns: DataFrame, min_window: int, keys: Sequence[str], col: str) -> DataFrame:
    """(keys, date, r percent, row, e, mean, level_lo, level_hi): residuals
    against the mean of the rows before, the mean up to each row, and the range of
    levels that the running variances from the ``min_window``-th row on span."""
    w, fr = series_window(keys), expanding(keys)
    src = returns.filter(F.col(col).isNotNull()).select(*keys, "date", (F.col(col) * 100.0).alias("r"))
    src = src.select("*", (F.row_number().over(w) - 1).cast("long").alias("row"), F.avg("r").over(fr).alias("mean"),
                     F.var_samp("r").over(fr).alias("var"))
    whole = Window.partitionBy(*keys)
    judged = F.when((F.col("row") >= min_window) & (F.col("var") > 0), F.col("var"))
    src = src.select("*", F.coalesce(F.col("r") - F.lag("mean").over(w), F.lit(0.0)).alias("e"),
                     F.min(judged).over(whole).alias("_lo"), F.max(judged).over(whole).alias("_hi"))
    return src.select(*keys, "date", "r", "row", "e", "mean",
                      F.floor((F.log2("_lo") - LEVEL_MARGIN) / LEVEL_STEP).alias("level_lo"),
                      F.ceil((F.log2("_hi") + LEVEL_MARGIN) / LEVEL_STEP).alias("level_hi"))


def _garch_totals(keys: Sequence[str], size: int):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, halo = _block_rows(pdf, size)
        levels = _levels(pdf)
        if halo == len(pdf) or not len(levels):
            return _totals_frame(pdf, keys, ll=np.zeros(0))
        return _totals_frame(pdf, keys, ll=_garch_scores(_garch_paths(pdf, halo), levels).sum(0))
    return fn


def _garch_emit(keys: Sequence[str], size: int, min_window: int):
    def fn(pdf: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return pd.DataFrame({c: [] for c in [*keys, "date", "garch_conditional_volatility", "garch_point"]})
        pdf, halo = _block_rows(pdf, size)
        out = pdf[[*keys, "date"]].iloc[halo:].astype(object)
        vol, point = np.full(len(out), np.nan), np.full(len(out), -1)
        levels = _levels(pdf)
        if len(out) and len(levels):
            x = _garch_paths(pdf, halo)
            run = start.sort_values("point")["ll"].to_numpy() + np.cumsum(_garch_scores(x, levels), axis=0)
            best = _best_by(run, maximize=True)
            i, ab, mean = np.arange(len(out)), best // len(levels), pdf["mean"].to_numpy(float)[halo:]
            s2 = levels[best % len(levels)] * x["k"][i, ab] + x["p"][i, ab] - 2.0 * mean * x["q"][i, ab] + mean * mean * x["v"][i, ab]
            shown = pdf["row"].to_numpy()[halo:] >= min_window
            vol[shown], point[shown] = np.sqrt(np.maximum(s2, 0.0))[shown], best[shown]
        out["garch_conditional_volatility"] = vol
        out["garch_point"] = point
        return out
    return fn


def garch_volatility(returns: DataFrame, min_window: int = GARCH_MIN_WINDOW,
                     keys: Sequence[str] = KEYS, col: str = "log_return", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per date from the (min_window+1)-th return on, the conditional
    volatility (percent) of the best GARCH(1,1) grid point fitted on all
    history through that date."""
    rows = garch_rows(returns, min_window, keys, col)
    out = _by_blocks(row_blocks(rows, block_rows), keys, _garch_totals(keys, block_rows), _garch_emit(keys, block_rows, min_window),
                     ["ll"], "date date, garch_conditional_volatility double, garch_point int")
    return out.withColumn("garch_conditional_volatility",
                          F.when(F.col("garch_point") >= 0, F.col("garch_conditional_volatility")))


def garch_features(returns: DataFrame, min_window: int = GARCH_MIN_WINDOW,
                   keys: Sequence[str] = KEYS) -> DataFrame:
    """I14 = I13 + E16: volatility joined back with its change and two lags."""
    vol = garch_volatility(returns, min_window, keys).drop("garch_point")
    w = series_window(keys)
    g = F.col("garch_conditional_volatility")
    joined = returns.join(vol, [*keys, "date"], "left")
    return joined.withColumns({
        "garch_volatility_change": g - F.lag(g).over(w),
        "garch_volatility_lag_1": F.lag(g, 1).over(w),
        "garch_volatility_lag_2": F.lag(g, 2).over(w),
    })


def _garch_fit_group(keys: Sequence[str]):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date")
        r = pdf["r"].to_numpy(dtype=float)
        v0, e = r.var(ddof=1), r - r.mean()
        alpha, beta = np.array([g[0] for g in GARCH_GRID]), np.array([g[1] for g in GARCH_GRID])
        s2, total = np.full(len(GARCH_GRID), v0), np.zeros(len(GARCH_GRID))
        for t in range(len(r)):
            if t:
                s2 = v0 * (1.0 - alpha - beta) + alpha * (e[t - 1] * e[t - 1]) + beta * s2
            total -= 0.5 * (np.log(s2) + e[t] * e[t] / s2)
        best = int(_best_by(total[None, :], maximize=True)[0])
        a, b = GARCH_GRID[best]
        row = {k: pdf[k].iloc[0] for k in keys}
        row.update(n=len(r), mu=float(r.mean()), omega=float(v0 * (1 - a - b)), alpha=a, beta=b,
                   loglik=float(total[best]), last_volatility=float(np.sqrt(s2[best])))
        return pd.DataFrame([row])
    return fn


def garch_recent_fit(returns: DataFrame, last_n: int = 800, keys: Sequence[str] = KEYS) -> DataFrame:
    """GARCH(1,1) grid fit on the last ``last_n`` returns: one row per
    ticker (groups are bounded by ``last_n`` rows by construction)."""
    newest_first = Window.partitionBy(*keys).orderBy(F.col("date").desc())
    src = (returns.filter(F.col("log_return").isNotNull())
           .withColumn("_rn", F.row_number().over(newest_first))
           .filter(F.col("_rn") <= last_n)
           .select(*keys, "date", (F.col("log_return") * 100.0).alias("r")))
    key_schema = ", ".join(f"{k} {src.schema[k].dataType.simpleString()}" for k in keys)
    schema = (f"{key_schema}, n long, mu double, omega double, alpha double, beta double, "
              "loglik double, last_volatility double")
    return src.groupBy(*keys).applyInPandas(_garch_fit_group(keys), schema)


# -- ARMA(1,1) ----------------------------------------------------------------
_PHI, _THETA = (np.array([g[k] for g in ARMA_GRID]) for k in (0, 1))


def _arma_paths(pdf: pd.DataFrame, halo: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(y, a, c, sum of c^2 through the row) of a block's own rows; a and c are
    the parts of the residual e = a - mean * c, both 0 at the first row of a series."""
    y, t = pdf["y"].to_numpy(float), pdf["row"].to_numpy(float)[halo:, None]
    last, a = np.zeros(len(_PHI)), np.zeros((len(y), len(_PHI)))
    for i in range(1, len(y)):
        last = y[i] - _PHI * y[i - 1] - _THETA * last
        a[i] = last
    h = -_THETA
    k = (1.0 - _PHI) / (1.0 - h)
    c = k * (1.0 - h ** t)
    n = t + 1.0
    cc = k * k * (n - 2.0 * (1.0 - h ** n) / (1.0 - h) + (1.0 - h ** (2.0 * n)) / (1.0 - h * h))
    return y[halo:], a[halo:], c, cc


def _arma_totals(keys: Sequence[str], size: int):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, halo = _block_rows(pdf, size)
        if halo == len(pdf):
            return _totals_frame(pdf, keys, aa=np.zeros(0), ac=np.zeros(0))
        _, a, c, _ = _arma_paths(pdf, halo)
        return _totals_frame(pdf, keys, aa=(a * a).sum(0), ac=(a * c).sum(0))
    return fn


def _arma_emit(keys: Sequence[str], size: int, min_rows: int):
    def fn(pdf: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return pd.DataFrame({c: [] for c in [*keys, "date", "arima_mean_forecast_percent", "arma_point"]})
        pdf, halo = _block_rows(pdf, size)
        out = pdf[[*keys, "date"]].iloc[halo:].astype(object)
        fc, point = np.full(len(out), np.nan), np.full(len(out), -1)
        if len(out):
            y, a, c, cc = _arma_paths(pdf, halo)
            start = start.sort_values("point")
            aa = start["aa"].to_numpy() + np.cumsum(a * a, axis=0)
            ac = start["ac"].to_numpy() + np.cumsum(a * c, axis=0)
            first = pdf["row"].to_numpy()[halo:] == 0  # no residual yet
            cc[first] = 1.0
            best = _best_by(aa - ac * ac / cc, maximize=False)
            i = np.arange(len(out))
            mean = (ac / cc)[i, best]
            f = mean + _PHI[best] * (y - mean) + _THETA[best] * (a[i, best] - mean * c[i, best])
            shown = pdf["row"].to_numpy()[halo:] >= min_rows - 1
            fc[shown], point[shown] = f[shown], best[shown]
        out["arima_mean_forecast_percent"] = fc
        out["arma_point"] = point
        return out
    return fn


def rolling_forecast(returns: DataFrame, min_rows: int = ARMA_MIN_ROWS, keys: Sequence[str] = KEYS,
                     col: str = "log_return", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """For every date, the one-step-ahead forecast (percent) of the best
    ARMA(1,1) grid point, with its best mean, fitted on all history through that
    date; NULL while fewer than ``min_rows`` returns exist."""
    src = returns.filter(F.col(col).isNotNull()).select(
        *keys, "date", (F.col(col) * 100.0).alias("y"), (F.row_number().over(series_window(keys)) - 1).cast("long").alias("row"))
    out = _by_blocks(row_blocks(src, block_rows), keys, _arma_totals(keys, block_rows), _arma_emit(keys, block_rows, min_rows),
                     ["aa", "ac"], "date date, arima_mean_forecast_percent double, arma_point int")
    return out.withColumn("arima_mean_forecast_percent",
                          F.when(F.col("arma_point") >= 0, F.col("arima_mean_forecast_percent")))


def ar1_forecast(returns: DataFrame, min_rows: int = ARMA_MIN_ROWS, keys: Sequence[str] = KEYS,
                 col: str = "log_return") -> DataFrame:
    """Order (1,0,0) as pure SQL — expanding least squares of y_t on
    y_{t-1} (percent), forecast = intercept + slope * y_T; NULL before
    ``min_rows`` returns."""
    w = series_window(keys)
    y = F.col(col) * 100.0
    base = returns.filter(F.col(col).isNotNull()).withColumns({"_y": y, "_x": F.lag(y).over(w)})
    fr = expanding(keys)
    out = base.withColumns({
        "ar_slope": F.regr_slope("_y", "_x").over(fr),
        "ar_intercept": F.regr_intercept("_y", "_x").over(fr),
        "_n": F.count("_y").over(fr),
    })
    fc = F.when(F.col("_n") >= min_rows, F.col("ar_intercept") + F.col("ar_slope") * F.col("_y"))
    return out.withColumn("ar1_forecast_percent", fc).drop("_y", "_x", "_n")


# -- ARMA(p, q) of any order by two-stage regression ----------------------------
def _products(z: np.ndarray, x: np.ndarray, ok: np.ndarray) -> np.ndarray:
    """Upper products of the regressors and their products with x, per row; 0 for rows not used."""
    i, j = np.triu_indices(z.shape[1])
    return np.column_stack((z[:, i] * z[:, j], z * x[:, None])) * ok[:, None]


def _coefficients(sums: np.ndarray, k: int) -> np.ndarray:
    """Least-squares coefficients per row of summed products, with a ridge far below the data's scale."""
    i, j = np.triu_indices(k)
    gram = np.empty((len(sums), k, k))
    gram[:, i, j] = gram[:, j, i] = sums[:, :len(i)]
    gram[:, range(k), range(k)] += 1e-10 * np.trace(gram, axis1=1, axis2=2)[:, None] / k + 1e-300
    return np.linalg.solve(gram, sums[:, len(i):, None])[:, :, 0]


def _lags(v: np.ndarray, n: int) -> np.ndarray:
    """[rows, n] of the values 1..n rows before; NaN before the first."""
    return np.column_stack([np.concatenate((np.full(min(k, len(v)), np.nan), v[:len(v) - k])) for k in range(1, n + 1)]) \
        if n else np.zeros((len(v), 0))


def _design(pdf: pd.DataFrame, parts: Sequence[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(regressors, x, rows that can be used): a constant and the lags of the columns in ``parts``."""
    z = np.column_stack([np.ones(len(pdf)), *[_lags(pdf[c].to_numpy(float), n) for c, n in parts]])
    x = pdf["x"].to_numpy(float)
    ok = np.isfinite(z).all(1) & np.isfinite(x)
    return np.where(ok[:, None], z, 0.0), np.where(ok, x, 0.0), ok


def _regression(blocks: DataFrame, keys: Sequence[str], size: int, parts: Sequence[tuple[str, int]], value, out: str) -> DataFrame:
    """Expanding least squares of x on the lags in ``parts``: ``value`` (rows,
    halo, sums of products through each own row) gives the column ``out``."""
    def totals(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, halo = _block_rows(pdf, size)
        if halo == len(pdf):
            return _totals_frame(pdf, keys, total=np.zeros(0))
        return _totals_frame(pdf, keys, total=_products(*_design(pdf, parts))[halo:].sum(0))

    def emit(pdf: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        columns = [*keys, "date", "row", "x", "level"]
        if not len(pdf):
            return pd.DataFrame({c: [] for c in [*columns, out]})
        pdf, halo = _block_rows(pdf, size)
        got = pdf[columns].iloc[halo:].astype({k: object for k in [*keys, "date"]})
        got[out] = value(pdf, halo, start.sort_values("point")["total"].to_numpy() + np.cumsum(
            _products(*_design(pdf, parts))[halo:], axis=0)) if len(got) else []
        return got

    return _by_blocks(blocks, keys, totals, emit, ["total"], f"date date, row bigint, x double, level double, {out} double")


def forecast_orders(returns: DataFrame, order: tuple[int, int, int] = (2, 0, 2), min_rows: int = ARMA_MIN_ROWS,
                    keys: Sequence[str] = KEYS, col: str = "log_return", long_ar: int = 10, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The rolling forecast (percent) for a general (p, d, q) order by two
    regressions (Hannan and Rissanen): an autoregression of ``long_ar`` lags
    gives the innovations, then the differenced series is regressed on its p lags
    and q lagged innovations. Both are fitted anew at every cutoff from
    running sums of products; an innovation uses the coefficients of the
    row before it, so no value looks ahead. NULL before ``min_rows`` differences."""
    p, d, q = order
    w, y = series_window(keys), F.col("y")
    src = returns.filter(F.col(col).isNotNull()).select(*keys, "date", (F.col(col) * 100.0).alias("y"))
    lagged = [F.lag(y, i).over(w) * float((-1) ** i * math.comb(d, i)) for i in range(1, d + 1)]
    x, level = y, F.lit(0.0)
    for term in lagged:
        x = x + term
    for i in range(d):  # what the next difference is added to
        level = level + F.lag(y, i).over(w) * float((-1) ** i * math.comb(d, i + 1))
    rows = src.select(*keys, "date", x.alias("x"), level.alias("level"), (F.row_number().over(w) - 1).cast("long").alias("row"))
    halo = max(long_ar, p, q) + 1
    if q:
        k = long_ar + 1

        def innovations(pdf: pd.DataFrame, halo: int, sums: np.ndarray) -> np.ndarray:
            z, own, ok = (a[halo:] for a in _design(pdf, [("x", long_ar)]))
            first = _products(*_design(pdf, [("x", long_ar)]))[halo:halo + 1]
            before = np.concatenate((sums[:1] - first, sums[:-1]))
            enough = pdf["row"].to_numpy()[halo:] >= d + 2 * k + long_ar
            return np.where(ok & enough, own - (z * _coefficients(before, k)).sum(1), np.nan)

        rows = _regression(row_blocks(rows, block_rows, halo), keys, block_rows, [("x", long_ar)], innovations, "e")
    else:
        rows = rows.withColumn("e", F.lit(0.0))
    parts = [("x", p), ("e", q)]

    def forecasts(pdf: pd.DataFrame, halo: int, sums: np.ndarray) -> np.ndarray:
        v = {c: pdf[c].to_numpy(float) for c in ("x", "e", "level")}
        ahead = np.column_stack([np.ones(len(pdf)), *[np.column_stack((v[c], _lags(v[c], n - 1))) for c, n in parts if n]])[halo:]
        f = (ahead * _coefficients(sums, 1 + p + q)).sum(1) + v["level"][halo:]
        return np.where(pdf["row"].to_numpy()[halo:] >= d + min_rows - 1, f, np.nan)

    out = _regression(row_blocks(rows, block_rows, halo), keys, block_rows, parts, forecasts, "forecast_percent")
    known = ~F.isnan("forecast_percent")
    return out.select(*keys, "date", F.when(known, F.col("forecast_percent")).alias("forecast_percent"))
