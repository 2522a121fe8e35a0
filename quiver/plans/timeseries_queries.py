"""Registered queries: stationarity tests (I1-I3), ACF (I4) and PACF."""

from __future__ import annotations

from pyspark.sql import functions as F

from quiver.functions.scalar import normal_cdf_sql
from quiver.operators import backtest as B
from quiver.operators import timeseries as TS
from quiver.plans.finish import finish
from quiver.plans.registry import register
from quiver.plans.sqltext import W, returns_cte, rnd
from quiver.session import materialize
from quiver.sources.views import SQL_VIEWS, bars

THIRD = repr(1.0 / 3.0)
TWO_NINTHS = repr(2.0 / 9.0)


def _series(spark, sf_dir, col="log_return"):
    """One series per ticker, materialised once: the tests read it in several passes."""
    return materialize(B.prepare_returns(bars(spark, sf_dir)).select("ticker", "date", F.col(col).alias("value")))


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([SQL_VIEWS["bars"], returns_cte("bars", "ret"), *ctes]) + "\n"


def _mackinnon_sql(t: str) -> str:
    s, lg = TS.TAU_C_SMALLP, TS.TAU_C_LARGEP
    small = f"({s[0]} + {s[1]} * {t} + {s[2]} * {t} * {t})"
    large = f"({lg[0]} + {lg[1]} * {t} + {lg[2]} * {t} * {t} + {lg[3]} * {t} * {t} * {t})"
    return (f"CASE WHEN {t} > {TS.TAU_MAX_C} THEN 1.0 WHEN {t} < {TS.TAU_MIN_C} THEN 0.0 "
            f"WHEN {t} <= {TS.TAU_STAR_C} THEN {normal_cdf_sql(small)} ELSE {normal_cdf_sql(large)} END")


@register("adf_lag0", _with(f"""d0 AS (SELECT ticker, log_return - lag(log_return) OVER ({W}) AS dy,
    lag(log_return) OVER ({W}) AS lv FROM ret)""",
                            """d1 AS (SELECT ticker, regr_count(dy, lv) AS observations, regr_slope(dy, lv) AS b,
    regr_sxx(dy, lv) AS sxx, regr_syy(dy, lv) AS syy, regr_sxy(dy, lv) AS sxy FROM d0 GROUP BY ticker)""",
                            """d2 AS (SELECT *, b / sqrt((syy - sxy * sxy / sxx) / (observations - 2) / sxx) AS statistic
  FROM d1)""", f"d3 AS (SELECT *, {_mackinnon_sql('statistic')} AS p_value FROM d2)") + f"""
SELECT ticker, {rnd(['statistic', 'p_value'])}, CAST(observations AS BIGINT) AS observations,
  p_value <= 0.05 AS stationary FROM d3""")
def q_adf_lag0(spark, sf_dir):
    """I1 (lag 0): Dickey-Fuller tau of log returns per ticker from SQL regression aggregates."""
    return finish(TS.adf_lag0(_series(spark, sf_dir)))


@register("adf_test")
def q_adf_test(spark, sf_dir):
    """Augmented Dickey-Fuller on log returns, AIC lag choice, MacKinnon p-value."""
    return finish(TS.adf_test(_series(spark, sf_dir)))


def kpss_sql(src: str, value: str, keys: str = "ticker") -> list[str]:
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys.split(", "))
    on_kb = lambda t: " AND ".join(f"a.{k} = {t}.{k}" for k in keys.split(", "))
    kk = ", ".join(f"kb.{k}" for k in keys.split(", "))
    kl = ", ".join(f"kl.{k}" for k in keys.split(", "))
    part = f"PARTITION BY {keys}"
    return [
        f"""k0 AS (SELECT {keys}, date, row_number() OVER ({part} ORDER BY date) AS i,
    count(*) OVER ({part}) AS n, {value} - avg({value}) OVER ({part}) AS e FROM {src} WHERE {value} IS NOT NULL)""",
        f"k1 AS (SELECT *, sum(e) OVER ({part} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM k0)",
        f"""kb AS (SELECT {keys}, max(n) AS n, sum(s * s) AS ss, sum(e * e) AS g0,
    CAST(floor(pow(max(n), {TWO_NINTHS})) AS INTEGER) AS cl FROM k1 GROUP BY {keys})""",
        f"""kg1 AS (SELECT {', '.join('a.' + k for k in keys.split(', '))}, g.j, sum(a.e * b.e) AS g
  FROM k0 a JOIN kb ON {on_kb('kb')} JOIN LATERAL (SELECT unnest(generate_series(1, kb.cl)) AS j) g ON true
  JOIN k0 b ON {on} AND b.i = a.i + g.j GROUP BY ALL)""",
        f"""ka AS (SELECT {kk}, kb.n, kb.ss, kb.g0, coalesce(sum(kg1.g / (kb.n / 2.0)), 0.0) AS sp,
    coalesce(sum(kg1.j * kg1.g / (kb.n / 2.0)), 0.0) AS s1
  FROM kb LEFT JOIN kg1 ON {' AND '.join(f'kb.{k} = kg1.{k}' for k in keys.split(', '))} GROUP BY ALL)""",
        f"""kl AS (SELECT *, CAST(least(floor(1.1447 * pow((s1 / (g0 / n + sp)) * (s1 / (g0 / n + sp)), {THIRD})
    * pow(n, {THIRD})), n - 1) AS INTEGER) AS lags FROM ka)""",
        f"""kg2 AS (SELECT {', '.join('a.' + k for k in keys.split(', '))}, g.j, sum(a.e * b.e) AS g
  FROM k0 a JOIN kl ON {on_kb('kl')} JOIN LATERAL (SELECT unnest(generate_series(1, kl.lags)) AS j) g ON true
  JOIN k0 b ON {on} AND b.i = a.i + g.j GROUP BY ALL)""",
        f"""kw AS (SELECT {kl}, kl.n, kl.ss, kl.g0, kl.lags,
    coalesce(sum(2.0 * kg2.g * (1.0 - kg2.j / (kl.lags + 1.0))), 0.0) AS w
  FROM kl LEFT JOIN kg2 ON {' AND '.join(f'kl.{k} = kg2.{k}' for k in keys.split(', '))} GROUP BY ALL)""",
        """kr AS (SELECT *, (ss / (n * n)) / ((g0 + CASE WHEN lags > 0 THEN w ELSE 0.0 END) / n) AS statistic FROM kw)""",
        f"""kp AS (SELECT *, CASE WHEN statistic <= 0.347 THEN 0.10
    WHEN statistic <= 0.463 THEN 0.10 + (statistic - 0.347) * (0.05 - 0.10) / (0.463 - 0.347)
    WHEN statistic <= 0.574 THEN 0.05 + (statistic - 0.463) * (0.025 - 0.05) / (0.574 - 0.463)
    WHEN statistic <= 0.739 THEN 0.025 + (statistic - 0.574) * (0.01 - 0.025) / (0.739 - 0.574)
    ELSE 0.01 END AS p_value FROM kr)""",
    ]


@register("kpss_test", _with(*kpss_sql("ret", "log_return")) + f"""
SELECT ticker, {rnd(['statistic', 'p_value'])}, lags AS lags_used, CAST(n AS BIGINT) AS observations,
  p_value > 0.05 AS stationary FROM kp""")
def q_kpss_test(spark, sf_dir):
    """KPSS level test on log returns, automatic Bartlett lag, interpolated p-value."""
    return finish(TS.kpss_test(_series(spark, sf_dir)))


@register("stationarity_report")
def q_stationarity_report(spark, sf_dir):
    """ADF and KPSS on price and on log return for every ticker, stacked."""
    r = materialize(B.prepare_returns(bars(spark, sf_dir)))
    return finish(TS.stationarity_report(r))


@register("stack_results", _with(f"""st AS (SELECT ticker, date, s.series, s.value FROM ret,
    LATERAL (SELECT unnest(['price', 'log_return']) AS series,
                    unnest([price, log_return]) AS value) s)""", *kpss_sql("st", "value", "ticker, series")) + f"""
SELECT ticker, series, 'KPSS' AS test, {rnd(['statistic', 'p_value'])}, lags AS lags_used,
  CAST(n AS BIGINT) AS observations, p_value > 0.05 AS stationary FROM kp""")
def q_stack_results(spark, sf_dir):
    """Test results of several series stacked into one table (KPSS on price and log return)."""
    long = materialize(TS.stack_series(B.prepare_returns(bars(spark, sf_dir)), ["price", "log_return"]))
    k = TS.kpss_test(long, "value", ["ticker", "series"])
    return finish(k.select("ticker", "series", F.lit("KPSS").alias("test"), "statistic", "p_value",
                           "lags_used", "observations", "stationary"))


NL = 40


def acf_sql(src: str, value: str, keys: str) -> list[str]:
    part = f"PARTITION BY {keys}"
    lags = ", ".join(f"lag(c, {j}) OVER ({part} ORDER BY date) AS l{j}" for j in range(1, NL + 1))
    sums = ", ".join(f"sum(c * l{j}) AS g{j}" for j in range(1, NL + 1))
    vals = ", ".join(["1.0"] + [f"coalesce(g{j}, 0.0) / g0" for j in range(1, NL + 1)])
    return [
        f"""a0 AS (SELECT {keys}, date, {value} - avg({value}) OVER ({part}) AS c, count(*) OVER ({part}) AS n
  FROM {src} WHERE {value} IS NOT NULL)""",
        f"a1 AS (SELECT {keys}, n, c, {lags} FROM a0)",
        f"a2 AS (SELECT {keys}, max(n) AS n, sum(c * c) AS g0, {sums} FROM a1 GROUP BY {keys})",
        f"""a3 AS (SELECT {keys}, n, unnest(range(0, {NL + 1})) AS lag, unnest([{vals}]) AS acf FROM a2)""",
        f"""a4 AS (SELECT *, coalesce(sum(CASE WHEN lag >= 1 THEN acf * acf END) OVER ({part} ORDER BY lag
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS cs FROM a3)""",
        f"""acf AS (SELECT {keys}, CAST(lag AS INTEGER) AS lag, acf, {TS.Z975!r} * sqrt(CASE WHEN lag = 0 THEN 0.0
    WHEN lag = 1 THEN 1.0 / n ELSE (1.0 + 2.0 * cs) / n END) AS band FROM a4)""",
    ]


_SQ = """sq AS (SELECT ticker, date, s.series, s.value FROM ret,
    LATERAL (SELECT unnest(['log_return', 'log_return_squared']) AS series,
                    unnest([log_return, log_return * log_return]) AS value) s)"""


def _sq_series(spark, sf_dir):
    r = B.prepare_returns(bars(spark, sf_dir)).withColumn("log_return_squared", F.pow("log_return", 2))
    return materialize(TS.stack_series(r, ["log_return", "log_return_squared"]))


@register("acf", _with(_SQ, *acf_sql("sq", "value", "ticker, series")) + f"""
SELECT ticker, series, lag, {rnd(['acf', 'band'])} FROM acf""")
def q_acf(spark, sf_dir):
    """I4: autocorrelation to lag 40 with the 95 % band, for returns and squared returns."""
    return finish(TS.acf(_sq_series(spark, sf_dir), "value", ["ticker", "series"], NL))


_PACF = ["""pr AS (SELECT ticker, series, list(acf ORDER BY lag) AS r FROM acf GROUP BY ticker, series)""",
         """pk(ticker, series, k, r, phi, v, a) AS (
  SELECT ticker, series, 0, r, CAST([] AS DOUBLE[]), r[1], CAST(1.0 AS DOUBLE) FROM pr
  UNION ALL
  SELECT ticker, series, k + 1, r, list_append(CAST(list_transform(phi, lambda c, j: c - b * phi[k + 1 - j]) AS DOUBLE[]), b), v * (1.0 - b * b), b
  FROM (SELECT *, (r[k + 2] - coalesce(list_sum(list_transform(phi, lambda c, j: c * r[k + 2 - j])), 0.0)) / v AS b FROM pk
        WHERE k < len(r) - 1) t)"""]


@register("pacf", _with(_SQ, *acf_sql("sq", "value", "ticker, series"), *_PACF).replace("WITH ", "WITH RECURSIVE ", 1) + """
SELECT ticker, series, CAST(k AS INTEGER) AS lag, round(a, 6) + 0.0 AS pacf FROM pk""")
def q_pacf(spark, sf_dir):
    """Partial autocorrelation (Yule-Walker / Levinson-Durbin) to lag 40."""
    return finish(TS.pacf(_sq_series(spark, sf_dir), "value", ["ticker", "series"], NL))


@register("pacf_short", _with(_SQ, *acf_sql("sq", "value", "ticker, series")) + f"""
SELECT ticker, series, lag, round(pacf, 6) + 0.0 AS pacf FROM (
  SELECT ticker, series, 1 AS lag, a1 AS pacf FROM (SELECT ticker, series,
    max(CASE WHEN lag = 1 THEN acf END) AS a1, max(CASE WHEN lag = 2 THEN acf END) AS a2 FROM acf GROUP BY ALL) t
  UNION ALL
  SELECT ticker, series, 2 AS lag, (a2 - a1 * a1) / (1.0 - a1 * a1) AS pacf FROM (SELECT ticker, series,
    max(CASE WHEN lag = 1 THEN acf END) AS a1, max(CASE WHEN lag = 2 THEN acf END) AS a2 FROM acf GROUP BY ALL) u) v""")
def q_pacf_short(spark, sf_dir):
    """I5 (lags 1-2): the partial autocorrelations with a closed form, checked against SQL."""
    p = TS.pacf(_sq_series(spark, sf_dir), "value", ["ticker", "series"], NL)
    return finish(p.filter(F.col("lag").isin(1, 2)))

