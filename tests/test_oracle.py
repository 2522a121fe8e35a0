"""The driver contract: entry() and a representative set of registered
queries against their DuckDB twins (the full set runs in tools/oracle_check.py)."""

from __future__ import annotations

import math

import pytest

import __spark_entry__ as E
from tests.conftest import SF01

SUBSET = ["log_returns", "lstm_features", "ensemble_backtest", "equity_curves", "join_market_ffill",
          "ohlcv_bars", "garch_volatility", "rolling_forecast", "regime_backtest", "backtest_summary",
          "kpss_test", "acf", "classification_report", "roc_auc", "confusion_matrix", "parse_report"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


def test_entry_runs_with_stable_schema(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].ticker == "ALL"
    assert df.columns == ["ticker", "days", "num_trades", "hit_rate", "last_date", "current_regime",
                          "ensemble_prob_up", "recommendation", "strategy_equity", "buy_hold_equity"]


def test_every_query_has_a_builder_and_sql_keys_match():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 100


@pytest.mark.parametrize("key", SUBSET)
def test_query_matches_duckdb(spark, duck, key):
    sdf = E.queries()[key](spark, SF01)
    srows = [r.asDict() for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    drows = [dict(zip(dcols, r)) for r in res.fetchall()]
    assert sorted(sdf.columns) == sorted(dcols)
    cols = sorted(dcols)
    assert _rows(srows, cols) == _rows(drows, cols)
