"""Stationarity tests, autocorrelation and partial autocorrelation per series.

Heavy lifting stays in Spark: lag columns and running sums over one
(key ORDER BY date) sort. ADF cross-product moments are differences of prefix
sums of lagged products; the KPSS Bartlett-weighted autocovariance sum comes
from prefix sums and one shifted-index equi-join. Only the per-series small solves (a few dozen numbers per
key) run in pandas, on rows that are already one per key.

Input contract: (keys..., date, value) with one row per (key, date).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quiver.functions.scalar import normal_cdf
from quiver.functions.windows import KEYS, expanding, series_window

# MacKinnon (1994) approximate p-value surface for the
# Dickey-Fuller tau statistic, constant term, one series (N = 1).
TAU_MAX_C, TAU_MIN_C, TAU_STAR_C = 2.74, -18.83, -1.61
TAU_C_SMALLP = (2.1659, 1.4412, 0.038269)
TAU_C_LARGEP = (1.7339, 0.93202, -0.12745, -0.010368)

# KPSS level-stationarity critical values (Kwiatkowski,
# Phillips, Schmidt and Shin 1992, Table 1) at 10 %, 5 %, 2.5 % and 1 %.
KPSS_CRIT = (0.347, 0.463, 0.574, 0.739)
KPSS_PVALS = (0.10, 0.05, 0.025, 0.01)
# Automatic bandwidth rule of Hobijn, Franses and Ooms (1998).
KPSS_GAMMA = 1.1447

Z975 = 1.959963984540054


def _prep(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    w = series_window(keys)
    part = Window.partitionBy(*keys)
    base = df.filter(F.col(value).isNotNull()).select(*keys, "date", F.col(value).alias("_v"))
    return base.withColumns({
        "_n": F.count(F.lit(1)).over(part),
        "_i": F.row_number().over(w),
        "_c": F.col("_v") - F.avg("_v").over(part),
    })


# ---------------------------------------------------------------------------
# ADF
# ---------------------------------------------------------------------------

def mackinnon_p(stat: float) -> float:
    if stat > TAU_MAX_C:
        return 1.0
    if stat < TAU_MIN_C:
        return 0.0
    coef = TAU_C_SMALLP if stat <= TAU_STAR_C else TAU_C_LARGEP
    z = sum(c * stat ** k for k, c in enumerate(coef))
    return 0.5 * (1.0 + math.erf(z / math.sqrt(2.0)))


def mackinnon_p_col(t) -> F.Column:
    """Same surface as a column expression (normal CDF by the A&S approximation)."""
    small = F.lit(TAU_C_SMALLP[0]) + F.lit(TAU_C_SMALLP[1]) * t + F.lit(TAU_C_SMALLP[2]) * t * t
    large = (F.lit(TAU_C_LARGEP[0]) + F.lit(TAU_C_LARGEP[1]) * t + F.lit(TAU_C_LARGEP[2]) * t * t
             + F.lit(TAU_C_LARGEP[3]) * t * t * t)
    return (F.when(t > TAU_MAX_C, F.lit(1.0)).when(t < TAU_MIN_C, F.lit(0.0))
            .when(t <= TAU_STAR_C, normal_cdf(small)).otherwise(normal_cdf(large)))


def adf_lag0(df: DataFrame, value: str = "value", keys: Sequence[str] = KEYS) -> DataFrame:
    """Dickey-Fuller regression without lagged differences, all in SQL
    aggregates: dy on (1, y_{t-1}); tau = slope / se."""
    w = series_window(keys)
    base = df.filter(F.col(value).isNotNull()).select(*keys, "date", F.col(value).alias("_v"))
    base = base.withColumns({"_dy": F.col("_v") - F.lag("_v").over(w), "_lv": F.lag("_v").over(w)})
    agg = base.groupBy(*keys).agg(
        F.regr_count("_dy", "_lv").alias("observations"), F.regr_slope("_dy", "_lv").alias("_b"),
        F.regr_sxx("_dy", "_lv").alias("_sxx"), F.regr_syy("_dy", "_lv").alias("_syy"),
        F.regr_sxy("_dy", "_lv").alias("_sxy"))
    ssr = F.col("_syy") - F.col("_sxy") * F.col("_sxy") / F.col("_sxx")
    se = F.sqrt(ssr / (F.col("observations") - 2) / F.col("_sxx"))
    out = agg.withColumn("statistic", F.col("_b") / se)
    out = out.withColumn("p_value", mackinnon_p_col(F.col("statistic")))
    return out.select(*keys, "statistic", "p_value", F.col("observations").cast("long").alias("observations"),
                      (F.col("p_value") <= 0.05).alias("stationary"))


def _maxlag_expr(n):
    return F.least(F.ceil(F.lit(12.0) * F.pow(n / 100.0, 0.25)), F.floor(n / 2) - 2).cast("int")


def adf_test(df: DataFrame, value: str = "value", keys: Sequence[str] = KEYS) -> DataFrame:
    """Augmented Dickey-Fuller with constant, lag length by AIC over
    0..maxlag on a common sample, then the refit with the chosen lag.

    The regressors are shifts of one series, so every cross-product sum over
    a sample t = s..n is a difference of prefix sums of lagged products:
    sum dy_{t-a} dy_{t-b} = C_{b-a}(n-a) - C_{b-a}(s-1-a) with
    C_k(v) = sum_{u<=v} dy_u dy_{u-k}, and likewise for the level column.
    Spark computes the 2L+5 running sums in one sorted pass (O(n L) per
    series) and keeps the <= 2L+3 boundary rows each series needs; the AIC
    lag choice and the refit solve (k x k) systems per series from them.
    One small action sizes the lag columns: the largest ``maxlag`` over all
    series (a single integer computed from series lengths).
    """
    base = _prep(df, value, keys)
    w = series_window(keys)
    fr = expanding(keys)
    base = base.withColumns({"_dy": F.col("_c") - F.lag("_c").over(w), "_lv": F.lag("_c").over(w),
                             "_ml": _maxlag_expr(F.col("_n"))})
    lmax = base.groupBy(*keys).agg(F.max("_ml").alias("m")).agg(F.max("m")).first()[0] or 0
    lmax = max(int(lmax), 0)
    dy0 = F.coalesce(F.col("_dy"), F.lit(0.0))
    lv0 = F.coalesce(F.col("_lv"), F.lit(0.0))
    lagged = base.withColumns({f"_d{j}": F.coalesce(F.lag("_dy", j).over(w), F.lit(0.0))
                               for j in range(1, lmax + 1)})
    dlag = [dy0] + [F.col(f"_d{j}") for j in range(1, lmax + 1)]
    sums = {"_A": F.sum(lv0).over(fr), "_B": F.sum(lv0 * lv0).over(fr), "_E": F.sum(dy0).over(fr)}
    sums.update({f"_H{j}": F.sum(lv0 * dlag[j]).over(fr) for j in range(lmax + 1)})
    sums.update({f"_C{k}": F.sum(dy0 * dlag[k]).over(fr) for k in range(lmax + 1)})
    pref = lagged.withColumns(sums)
    keep = (F.col("_i") >= F.col("_n") - lmax) | (F.col("_i") <= F.col("_ml") + 1)
    cols = ["_i", "_n", "_ml", "_A", "_B", "_E", *[f"_H{j}" for j in range(lmax + 1)],
            *[f"_C{k}" for k in range(lmax + 1)]]
    edges = pref.filter(keep).select(*keys, *cols)
    key_schema = ", ".join(f"{k} {edges.schema[k].dataType.simpleString()}" for k in keys)
    dyi = lmax + 2

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.set_index("_i")
        n, ml = int(pdf["_n"].iloc[0]), int(pdf["_ml"].iloc[0])

        def at(col, idx):
            return float(pdf.at[idx, col]) if idx >= 1 else 0.0

        def moments(s0):
            size = lmax + 3
            m = np.zeros((size, size))

            def put(r, c, v):
                m[r, c] = m[c, r] = v

            put(0, 0, n - s0 + 1)
            put(0, 1, at("_A", n) - at("_A", s0 - 1))
            put(1, 1, at("_B", n) - at("_B", s0 - 1))
            for j in range(0, lmax + 1):
                col = dyi if j == 0 else 1 + j
                put(0, col, at("_E", n - j) - at("_E", s0 - 1 - j))
                put(1, col, at(f"_H{j}", n) - at(f"_H{j}", s0 - 1))
            for a in range(0, lmax + 1):
                for b in range(a, lmax + 1):
                    ca, cb = (dyi if a == 0 else 1 + a), (dyi if b == 0 else 1 + b)
                    put(ca, cb, at(f"_C{b - a}", n - a) - at(f"_C{b - a}", s0 - 1 - a))
            return m

        row = {k_: pdf[k_].iloc[0] for k_ in keys}
        mat = moments(ml + 2)
        nobs, yy = mat[0, 0], mat[dyi, dyi]
        best = (math.inf, 0)
        for p in range(0, ml + 1):
            k = p + 2
            try:
                b = np.linalg.solve(mat[:k, :k], mat[:k, dyi])
            except np.linalg.LinAlgError:
                continue
            ssr = max(yy - float(b @ mat[:k, dyi]), 1e-300)
            llf = -nobs / 2.0 * (math.log(2 * math.pi) + math.log(ssr / nobs) + 1.0)
            best = min(best, (-2.0 * llf + 2.0 * k, p))
        p = best[1]
        k = p + 2
        mat = moments(p + 2)
        nobs, yy = mat[0, 0], mat[dyi, dyi]
        stat = pv = math.nan
        try:
            inv = np.linalg.inv(mat[:k, :k])
            b = inv @ mat[:k, dyi]
            s2 = (yy - float(b @ mat[:k, dyi])) / (nobs - k)
            stat = float(b[1] / math.sqrt(s2 * inv[1, 1]))
            pv = mackinnon_p(stat)
        except (np.linalg.LinAlgError, ValueError, ZeroDivisionError):
            pass
        row.update(statistic=stat, p_value=pv, lags_used=p, observations=int(nobs))
        return pd.DataFrame([row])

    res = edges.groupBy(*keys).applyInPandas(
        solve, f"{key_schema}, statistic double, p_value double, lags_used int, observations long")
    return res.withColumn("stationary", F.col("p_value") <= 0.05)


# ---------------------------------------------------------------------------
# KPSS
# ---------------------------------------------------------------------------

def kpss_test(df: DataFrame, value: str = "value", keys: Sequence[str] = KEYS,
              nlags: int | None = None) -> DataFrame:
    """KPSS level stationarity; Bartlett long-run variance with the
    automatic lag rule (or a fixed ``nlags``); p-value interpolated in the
    critical-value table and clipped to [0.01, 0.10].

    Both stages sum products with the L rows before, sum_t e_t sum_j w_j e_{t-j}.
    With prefix sums P_t = sum_{k<=t} e_k and Q_t = sum_{k<=t} k e_k, the plain
    and the j-weighted sum over rows t-L..t-1 are dP and t dP - dQ, where d is
    the value at t-1 minus the value at t-L-1. The latter comes from one
    equi-join on the shifted row index: linear in n for any L, no lag columns.
    """
    base = _prep(df, value, keys)
    w, fr = series_window(keys), expanding(keys)
    rows = base.withColumns({"_P": F.sum("_c").over(fr), "_Q": F.sum(F.col("_i") * F.col("_c")).over(fr)})

    def products(rows: DataFrame, plain: str, weighted: str) -> DataFrame:
        """Per series the two sums over the ``_lags`` rows before each row, with _n, _ss and _g0."""
        rows = rows.withColumns({"_P1": F.coalesce(F.lag("_P").over(w), F.lit(0.0)),
                                 "_Q1": F.coalesce(F.lag("_Q").over(w), F.lit(0.0))})
        far = rows.select(*keys, (F.col("_i") + F.col("_lags") + 1).alias("_i"), F.col("_P").alias("_Pf"), F.col("_Q").alias("_Qf"))
        j = rows.join(far, [*keys, "_i"], "left")
        d_p = F.col("_P1") - F.coalesce(F.col("_Pf"), F.lit(0.0))
        d_q = F.col("_Q1") - F.coalesce(F.col("_Qf"), F.lit(0.0))
        return j.groupBy(*keys).agg(
            F.first("_n").alias("_n"), F.first("_lags").alias("_lags"), F.sum(F.col("_P") * F.col("_P")).alias("_ss"),
            F.sum(F.col("_c") * F.col("_c")).alias("_g0"), F.sum(F.col("_c") * d_p).alias(plain),
            F.sum(F.col("_c") * (F.col("_i") * d_p - d_q)).alias(weighted))

    n = F.col("_n")
    if nlags is None:
        first = products(rows.withColumn("_lags", F.floor(F.pow(n, 2.0 / 9.0)).cast("int")), "_sp", "_s1")
        share = (F.col("_s1") / (n / 2.0)) / (F.col("_g0") / n + F.col("_sp") / (n / 2.0))
        auto = F.floor(F.lit(KPSS_GAMMA) * F.pow(share * share, 1.0 / 3.0) * F.pow(n, 1.0 / 3.0))
        chosen = first.select(*keys, F.least(auto, n - 1).cast("int").alias("_lags"))
        rows = rows.join(chosen, list(keys))
    else:
        rows = rows.withColumn("_lags", F.least(F.lit(nlags), n - 1).cast("int"))
    res = products(rows, "_pl", "_wt")
    # the Bartlett weight of lag j is 1 - j / (L + 1)
    res = res.withColumn("_wh", F.col("_pl") - F.col("_wt") / (F.col("_lags") + 1.0))
    wsum = 2.0 * F.coalesce(F.col("_wh"), F.lit(0.0))
    sigma = (F.col("_g0") + F.when(F.col("_lags") > 0, wsum).otherwise(0.0)) / n
    eta = F.col("_ss") / (n * n)
    res = res.withColumn("statistic", eta / sigma)
    x = F.col("statistic")
    c, pv = KPSS_CRIT, KPSS_PVALS
    p = F.when(x <= c[0], F.lit(pv[0]))
    for a in range(3):
        p = p.when(x <= c[a + 1], F.lit(pv[a]) + (x - c[a]) * (pv[a + 1] - pv[a]) / (c[a + 1] - c[a]))
    p = p.otherwise(F.lit(pv[3]))
    return res.select(*keys, "statistic", p.alias("p_value"), F.col("_lags").alias("lags_used"),
                      F.col("_n").cast("long").alias("observations"), (p > 0.05).alias("stationary"))


# ---------------------------------------------------------------------------
# ACF / PACF
# ---------------------------------------------------------------------------

def acf(df: DataFrame, value: str = "value", keys: Sequence[str] = KEYS, nlags: int = 40) -> DataFrame:
    """I4: autocorrelation to ``nlags`` with the 95 % Bartlett band, long form
    (keys, lag, acf, band). One sort for all lag columns, one aggregation."""
    base = _prep(df, value, keys)
    w = series_window(keys)
    lagged = base.withColumns({f"_l{j}": F.lag("_c", j).over(w) for j in range(1, nlags + 1)})
    sums = lagged.groupBy(*keys).agg(
        F.max("_n").alias("_n"), F.sum(F.col("_c") * F.col("_c")).alias("_g0"),
        *[F.sum(F.col("_c") * F.col(f"_l{j}")).alias(f"_g{j}") for j in range(1, nlags + 1)])
    items = [F.struct(F.lit(0).alias("lag"), F.lit(1.0).alias("acf"))] + [
        F.struct(F.lit(j).alias("lag"), (F.coalesce(F.col(f"_g{j}"), F.lit(0.0)) / F.col("_g0")).alias("acf"))
        for j in range(1, nlags + 1)]
    longf = sums.select(*keys, "_n", F.explode(F.array(*items)).alias("_a")).select(
        *keys, "_n", F.col("_a.lag").alias("lag"), F.col("_a.acf").alias("acf"))
    wl = Window.partitionBy(*keys).orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    csum = F.coalesce(F.sum(F.when(F.col("lag") >= 1, F.col("acf") * F.col("acf"))).over(wl), F.lit(0.0))
    var = (F.when(F.col("lag") == 0, F.lit(0.0)).when(F.col("lag") == 1, 1.0 / F.col("_n"))
           .otherwise((1.0 + 2.0 * csum) / F.col("_n")))
    return longf.select(*keys, "lag", "acf", (F.lit(Z975) * F.sqrt(var)).alias("band"))


def durbin_levinson(r) -> F.Column:
    """Partial autocorrelations of lags 0..K from the array r of the
    autocorrelations of lags 0..K: the recursion carries the last order's
    coefficients, its error and the result as one aggregate's state."""
    none = F.array().cast("array<double>")

    def step(s, k):
        before = F.transform(s["phi"], lambda c, j: c * F.get(r, k - 1 - j))
        a = F.try_divide(F.get(r, k) - F.aggregate(before, F.lit(0.0), lambda x, y: x + y), s["v"])
        phi = F.zip_with(s["phi"], F.reverse(s["phi"]), lambda x, y: x - a * y)
        return F.struct(F.concat(phi, F.array(a)).alias("phi"), (s["v"] * (1.0 - a * a)).alias("v"), F.concat(s["pac"], F.array(a)).alias("pac"))

    start = F.struct(none.alias("phi"), F.get(r, F.lit(0)).alias("v"), F.array(F.lit(1.0)).alias("pac"))
    return F.aggregate(F.sequence(F.lit(1), F.size(r) - 1), start, step, lambda s: s["pac"])


def pacf(df: DataFrame, value: str = "value", keys: Sequence[str] = KEYS, nlags: int = 40) -> DataFrame:
    """Partial autocorrelation (Yule-Walker, Durbin-Levinson on the ACF)
    per key, as one expression over the ``nlags + 1`` autocorrelations."""
    a = acf(df, value, keys, nlags).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("lag", "acf"))).alias("_a"))
    a = a.select(*keys, F.transform("_a", lambda x: x["acf"]).alias("_r"))
    return a.select(*keys, F.posexplode(durbin_levinson(F.col("_r"))).alias("lag", "pacf"))


def stack_series(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, date, c1, c2, ...) -> (keys, series, date, value): one job for all series."""
    items = F.array(*[F.struct(F.lit(c).alias("series"), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(*keys, "date", F.explode(items).alias("_s")).select(
        *keys, F.col("_s.series").alias("series"), "date", F.col("_s.value").alias("value"))


def stationarity_report(df: DataFrame, cols: Sequence[str] = ("price", "log_return"),
                        keys: Sequence[str] = KEYS) -> DataFrame:
    """ADF and KPSS on several series of every key, stacked."""
    long = stack_series(df, cols, keys)
    k2 = [*keys, "series"]
    adf = adf_test(long, "value", k2).select(*k2, F.lit("ADF").alias("test"), "statistic", "p_value",
                                              "lags_used", "observations", "stationary")
    kp = kpss_test(long, "value", k2).select(*k2, F.lit("KPSS").alias("test"), "statistic", "p_value",
                                              "lags_used", "observations", "stationary")
    return adf.unionByName(kp)
