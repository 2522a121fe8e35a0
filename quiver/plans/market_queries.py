"""Registered queries: instrument table, alignment, forward fill, tick bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from quiver.operators import backtest as B
from quiver.operators import market as M
from quiver.operators.features import forward_fill, series_row_number
from quiver.plans.backtest_queries import ensemble_ctes
from quiver.plans.finish import finish
from quiver.plans.registry import register
from quiver.plans.sqltext import W, div, frame, guarded, ln, rnd
from quiver.sources.views import INSTRUMENTS, bars, instruments_long, sql_with, ticks

MCOLS = M.market_columns()
RATIO_COLS = [r[0] for r in M.RATIOS]


def market_ctes() -> list[str]:
    """DuckDB twin of A5: ``aligned`` (C7), ``mkt0`` (complete), ``mkt`` (+ ratios)."""
    lc = ln("close")
    pivot = ",\n    ".join(
        f"max(close) FILTER (WHERE name = '{n}') AS {n}_close, "
        f"max(ret) FILTER (WHERE name = '{n}') AS {n}_return" for n in INSTRUMENTS)
    return [
        f"""inst AS (SELECT name, date, close,
    {lc} - lag({lc}) OVER (PARTITION BY name ORDER BY date) AS ret FROM instruments_long)""",
        f"""aligned AS (SELECT date,
    {pivot}
  FROM inst GROUP BY date HAVING max(close) FILTER (WHERE name = '{INSTRUMENTS[0]}') IS NOT NULL)""",
        "mkt0 AS (SELECT * FROM aligned WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in MCOLS) + ")",
        "mkt AS (SELECT *, " + ", ".join(f"{div(a + '_close', b + '_close')} AS {name}"
                                         for name, a, b in M.RATIOS) + " FROM mkt0)",
    ]


def processed_ctes(src: str = "bars") -> list[str]:
    """DuckDB twin of C1 ending in ``processed``."""
    allc = ["price", "volume", *MCOLS, *RATIO_COLS]
    fills = ",\n    ".join(f"last_value({c} IGNORE NULLS) OVER {frame(None)} AS {c}" for c in allc)
    lp = ln("price")
    return market_ctes() + [
        f"""j AS (SELECT b.ticker, b.date, b.price, b.volume, {', '.join('m.' + c for c in MCOLS + RATIO_COLS)}
  FROM {src} b LEFT JOIN mkt m ON b.date = m.date)""",
        f"""jf AS (SELECT ticker, date,
    {fills}
  FROM j)""",
        f"""jr AS (SELECT *, {lp} - lag({lp}) OVER ({W}) AS log_return FROM jf)""",
        "processed AS (SELECT * FROM jr WHERE " + " AND ".join(
            f"{c} IS NOT NULL" for c in ["price", "volume", *MCOLS, *RATIO_COLS, "log_return"]) + ")",
    ]


def _market(spark, sf_dir):
    return M.ingest_instruments(instruments_long(spark, sf_dir), skip_absent=False)


def processed(spark, sf_dir, src=bars):
    return M.join_market_ffill(src(spark, sf_dir), _market(spark, sf_dir))


@register("ingest_instruments", sql_with("instruments_long", extra=market_ctes()) + f"""
SELECT date, {rnd(MCOLS + RATIO_COLS)} FROM mkt""")
def q_ingest_instruments(spark, sf_dir):
    """A5: 13 instruments on the first one's calendar, complete dates only, ratios added."""
    return finish(_market(spark, sf_dir), ["date", *MCOLS, *RATIO_COLS])


@register("relative_strength", sql_with("instruments_long", extra=market_ctes()) + f"""
SELECT date, {rnd(RATIO_COLS)} FROM mkt""")
def q_relative_strength(spark, sf_dir):
    """The eight relative-strength ratios per date."""
    return finish(_market(spark, sf_dir), ["date", *RATIO_COLS])


@register("calendar_align", sql_with("instruments_long", extra=market_ctes()) + f"""
SELECT date, {rnd(MCOLS)} FROM aligned""")
def q_calendar_align(spark, sf_dir):
    """Instrument columns aligned to the first instrument's dates (gaps kept)."""
    return finish(M.calendar_align(instruments_long(spark, sf_dir)), ["date", *MCOLS])


_PROCESSED = ["ticker", "date", "price", "volume", *MCOLS, *RATIO_COLS, "log_return"]


@register("join_market_ffill", sql_with("bars", "instruments_long", extra=processed_ctes()) + f"""
SELECT ticker, date, {rnd(_PROCESSED[2:])} FROM processed""")
def q_join_market_ffill(spark, sf_dir):
    """Bars LEFT JOIN instruments, forward fill, log return, complete rows (37 columns + ticker)."""
    return finish(processed(spark, sf_dir), _PROCESSED)


@register("forward_fill", sql_with("bars", "instruments_long", extra=market_ctes()) + f"""
SELECT ticker, date, {rnd(['vix_close', 'spy_close'])} FROM (
  SELECT ticker, date,
    last_value(vix_close IGNORE NULLS) OVER {frame(None)} AS vix_close,
    last_value(spy_close IGNORE NULLS) OVER {frame(None)} AS spy_close
  FROM (SELECT b.ticker, b.date, a.vix_close, a.spy_close
        FROM bars b LEFT JOIN aligned a ON b.date = a.date) j) t""")
def q_forward_fill(spark, sf_dir):
    """Last known instrument closes carried forward over each ticker's calendar."""
    aligned = M.calendar_align(instruments_long(spark, sf_dir)).select("date", "vix_close", "spy_close")
    j = bars(spark, sf_dir).select("ticker", "date").join(aligned, "date", "left")
    return finish(forward_fill(j, ["vix_close", "spy_close"]), ["ticker", "date", "vix_close", "spy_close"])


@register("asof_reindex", sql_with("bars", extra=ensemble_ctes("bars")) + f"""
SELECT ticker, date, round(vol_cutoff, 6) + 0.0 AS vol_cutoff FROM (
  SELECT ticker, date, side,
    last_value(v IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date, side
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS vol_cutoff
  FROM (SELECT ticker, date, CAST(NULL AS DOUBLE) AS v, 1 AS side FROM bars
        UNION ALL SELECT ticker, date, vol_cutoff AS v, 0 AS side FROM ens WHERE vol_cutoff IS NOT NULL) u) t
WHERE side = 1""")
def q_asof_reindex(spark, sf_dir):
    """The last known volatility cutoff carried to every bar date (as-of by union + last)."""
    b = bars(spark, sf_dir)
    t = B.ensemble_table(B.prepare_returns(b)).filter(F.col("vol_cutoff").isNotNull())
    out = M.asof_fill(b.select("ticker", "date"), t.select("ticker", "date", "vol_cutoff"), "vol_cutoff")
    return finish(out, ["ticker", "date", "vol_cutoff"])


@register("restrict_dates", sql_with("bars") + """
SELECT ticker, date, round(price, 6) + 0.0 AS price FROM bars b
WHERE EXISTS (SELECT 1 FROM (SELECT ticker, date, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn
                             FROM bars) e WHERE e.rn <= 30 AND e.ticker = b.ticker AND e.date = b.date)""")
def q_restrict_dates(spark, sf_dir):
    """Keep only evaluation dates (left-semi join with the last 30 dates per ticker)."""
    b = bars(spark, sf_dir)
    dates = b.select("ticker", "date").withColumn("rn", series_row_number(desc=True)).filter("rn <= 30")
    return finish(b.join(dates.select("ticker", "date"), ["ticker", "date"], "left_semi"),
                  ["ticker", "date", "price"])


_INST_MOM = [n for n, _ in M.INSTRUMENT_MOMENTUM]


@register("instrument_momentum", sql_with("bars", "instruments_long", extra=processed_ctes()) + f"""
SELECT ticker, date, {rnd(_INST_MOM)} FROM (SELECT ticker, date,
  {', '.join(f"{guarded('sum', src + '_return', 5)} AS {name}" for name, src in M.INSTRUMENT_MOMENTUM)}
  FROM processed) t""")
def q_instrument_momentum(spark, sf_dir):
    """Five-row sums of spy, iwm, xlk, uup, tlt and hyg returns."""
    return finish(M.instrument_momentum(processed(spark, sf_dir)), ["ticker", "date", *_INST_MOM])


@register("level_changes", sql_with("bars", "instruments_long", extra=processed_ctes()) + f"""
SELECT ticker, date, {rnd(['vix_change', 'vix_lag_1', 'rate_change'])} FROM (SELECT ticker, date,
  vix_close - lag(vix_close) OVER ({W}) AS vix_change, lag(vix_close) OVER ({W}) AS vix_lag_1,
  tnx_close - lag(tnx_close) OVER ({W}) AS rate_change FROM processed) t""")
def q_level_changes(spark, sf_dir):
    """First difference of vix and of the 10-year yield; vix one row back."""
    return finish(M.level_changes(processed(spark, sf_dir)),
                  ["ticker", "date", "vix_change", "vix_lag_1", "rate_change"])


INGEST = ("BUILDING", "1996-01-01", "2000-01-01")


@register("ingest_bars", sql_with("bars") + f"""
SELECT ticker, date, round(price, 6) + 0.0 AS price, round(volume, 6) + 0.0 AS volume FROM bars
WHERE ticker = '{INGEST[0]}' AND date >= DATE '{INGEST[1]}' AND date < DATE '{INGEST[2]}'
  AND price IS NOT NULL AND volume IS NOT NULL""")
def q_ingest_bars(spark, sf_dir):
    """A3: one ticker's bars in a half-open date range, incomplete rows dropped."""
    return finish(M.ingest_bars(bars(spark, sf_dir), *INGEST))


@register("ohlcv_bars", sql_with("ticks") + """
SELECT ticker, date_trunc('hour', ts) AS hour, round(first(value ORDER BY ts, event_id), 6) + 0.0 AS open,
  round(max(value), 6) + 0.0 AS high, round(min(value), 6) + 0.0 AS low,
  round(last(value ORDER BY ts, event_id), 6) + 0.0 AS close, count(*) AS volume
FROM ticks GROUP BY 1, 2""")
def q_ohlcv_bars(spark, sf_dir):
    """A4: hourly open/high/low/close/volume bars from ticks (partial aggregate)."""
    return finish(M.ohlcv_bars(ticks(spark, sf_dir), "hour"))
