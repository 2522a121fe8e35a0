"""SQL text helpers for the DuckDB oracle twins (never executed by Spark)."""

from __future__ import annotations

from collections.abc import Sequence

W = "PARTITION BY ticker ORDER BY date"


def frame(n: int | None, part: str = W) -> str:
    """``n`` trailing rows, or the expanding frame when ``n`` is None."""
    if n is None:
        return f"({part} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"({part} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def guarded(agg: str, col: str, n: int, min_count: int | None = None, part: str = W) -> str:
    fr = frame(n, part)
    m = n if min_count is None else min_count
    return f"CASE WHEN count({col}) OVER {fr} >= {m} THEN {agg}({col}) OVER {fr} END"


def guarded_expanding(agg: str, col: str, min_count: int, part: str = W) -> str:
    fr = frame(None, part)
    return f"CASE WHEN count({col}) OVER {fr} >= {min_count} THEN {agg} OVER {fr} END"


SIGNIFICANT = {"cum_strategy", "cum_buyhold", "strategy_equity", "buy_hold_equity",
               "strategy_total_return", "buy_hold_total_return"}


def rnd(cols: Sequence[str], digits: int = 6) -> str:
    """Rounded projection; ``+ 0.0`` turns -0.0 into 0.0 like the Spark side."""
    from quiver.functions.scalar import sig_round_sql
    return ", ".join((f"{sig_round_sql(c)} AS {c}" if c in SIGNIFICANT
                      else f"round({c}, {digits}) + 0.0 AS {c}") for c in cols)


def ln(col: str) -> str:
    return f"(CASE WHEN {col} > 0 THEN ln({col}) END)"


def div(a: str, b: str) -> str:
    return f"(CASE WHEN {b} <> 0 THEN {a} / {b} END)"


def returns_cte(src: str, name: str = "ret", extra: str = "") -> str:
    """``src`` bars -> rows with a log return (first row per ticker dropped)."""
    lp = ln("price")
    return f"""{name} AS (
  SELECT * FROM (
    SELECT ticker, date, price, volume{extra},
           {lp} - lag({lp}) OVER ({W}) AS log_return
    FROM {src}) t WHERE log_return IS NOT NULL)"""
