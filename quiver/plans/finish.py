"""Final projection of registered queries: fixed column order, rounded doubles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from quiver.functions.scalar import round6, sig_round


# Columns whose values span many orders of magnitude (equity curves on the
# synthetic fixtures reach 1e40): rounded to significant digits instead.
SIGNIFICANT = {"cum_strategy", "cum_buyhold", "strategy_equity", "buy_hold_equity",
               "strategy_total_return", "buy_hold_total_return"}


def finish(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """Select ``cols`` (default: all) and round every double to ``digits``
    decimals (significant digits for the columns in ``SIGNIFICANT``)."""
    cols = list(cols or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in cols:
        if isinstance(types.get(c), (DoubleType, FloatType)):
            r = sig_round(F.col(c)) if c in SIGNIFICANT else round6(F.col(c), digits)
            out.append(r.alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)
