"""Null-safe scalar expressions.

pandas marks "missing" with NaN while Spark's NaN is an ordinary number that
compares greater than everything. The rule here: NaN never enters a column;
log of a non-positive number, division by zero and failed parses give NULL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_ln(col: str | Column) -> Column:
    c = _c(col)
    return F.when(c > 0, F.ln(c))


def safe_div(num: str | Column, den: str | Column) -> Column:
    return F.try_divide(_c(num), _c(den))


def clip_keep_null(col: str | Column, lo: float, hi: float) -> Column:
    """Clip to [lo, hi]; ``greatest``/``least`` skip NULLs, so guard them."""
    c = _c(col)
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(hi)), F.lit(lo)))


def round6(col: str | Column, digits: int = 6) -> Column:
    """Round for engine-independent comparison; ``+ 0.0`` turns -0.0 into 0.0."""
    return F.round(_c(col), digits) + F.lit(0.0)


# Coefficients of the normal distribution function approximation
# 26.2.17 in Abramowitz & Stegun, Handbook of Mathematical Functions (1964);
# absolute error below 7.5e-8.
NCDF_P = 0.2316419
NCDF_B = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
INV_SQRT_2PI = 1.0 / math.sqrt(2.0 * math.pi)


def normal_cdf(col: str | Column) -> Column:
    """Standard normal distribution function as a plain expression."""
    x = _c(col)
    ax = F.abs(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(NCDF_P) * ax)
    poly = t * (F.lit(NCDF_B[0]) + t * (F.lit(NCDF_B[1]) + t * (F.lit(NCDF_B[2])
               + t * (F.lit(NCDF_B[3]) + t * F.lit(NCDF_B[4])))))
    upper = F.lit(1.0) - F.lit(INV_SQRT_2PI) * F.exp(-ax * ax / 2.0) * poly
    return F.when(x >= 0, upper).otherwise(F.lit(1.0) - upper)


def normal_cdf_sql(x: str) -> str:
    """The same approximation as SQL text, for the DuckDB oracle."""
    b = NCDF_B
    t = f"(1.0 / (1.0 + {NCDF_P} * abs({x})))"
    poly = f"({t} * ({b[0]} + {t} * ({b[1]} + {t} * ({b[2]} + {t} * ({b[3]} + {t} * {b[4]})))))"
    upper = f"(1.0 - {INV_SQRT_2PI!r} * exp(-abs({x}) * abs({x}) / 2.0) * {poly})"
    return f"(CASE WHEN {x} >= 0 THEN {upper} ELSE 1.0 - {upper} END)"


def _exact_pow10(k: Column) -> Column:
    """10**k for an integer k >= 0, parsed from its decimal form: the nearest
    double in every engine, over the whole range of doubles."""
    return F.concat(F.lit("1e"), k.cast("string")).cast("double")


def sig_round(col: str | Column, digits: int = 8) -> Column:
    """Round to ``digits`` significant digits (for values such as equity curves
    that span many orders of magnitude), with engine-independent arithmetic."""
    x = _c(col)
    e = F.floor(F.log10(F.abs(x)))
    p = _exact_pow10(F.abs(e))
    m = F.when(e >= 0, x / p).otherwise(x * p)
    r = F.round(m, digits - 1)
    back = F.when(e >= 0, r * p).otherwise(r / p)
    return F.when(x == 0, F.lit(0.0)).otherwise(back + F.lit(0.0))


def sig_round_sql(x: str, digits: int = 8) -> str:
    e = f"floor(log10(abs({x})))"
    p = f"CAST('1e' || CAST(abs({e}) AS INTEGER) AS DOUBLE)"
    m = f"(CASE WHEN {e} >= 0 THEN {x} / ({p}) ELSE {x} * ({p}) END)"
    r = f"round({m}, {digits - 1})"
    return (f"(CASE WHEN {x} = 0 THEN 0.0 WHEN {e} >= 0 THEN {r} * ({p}) + 0.0 "
            f"ELSE {r} / ({p}) + 0.0 END)")
