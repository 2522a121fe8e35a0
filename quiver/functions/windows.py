"""Window frames over ordered series.

Every window names both its partition (the series key, ``ticker`` by default)
and its order (``date``), because a Spark DataFrame has no row order. Frames
with the same partition and order share one exchange and one sort when they
are used in the same ``select``.

``guarded`` reproduces the "missing until N non-missing values" rule of a
rolling or expanding aggregate with ``min_periods``: Spark otherwise returns
partial frames at the start of a series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

KEYS: tuple[str, ...] = ("ticker",)
ORDER = "date"


def series_window(keys: Sequence[str] = KEYS, order: str | Column = ORDER) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(order)


def trailing(n: int, keys: Sequence[str] = KEYS, order: str | Column = ORDER) -> WindowSpec:
    """The current row and the n-1 rows before it."""
    return series_window(keys, order).rowsBetween(-(n - 1), 0)


def expanding(keys: Sequence[str] = KEYS, order: str | Column = ORDER) -> WindowSpec:
    """All rows up to and including the current one."""
    return series_window(keys, order).rowsBetween(Window.unboundedPreceding, 0)


def whole_series(keys: Sequence[str] = KEYS) -> WindowSpec:
    return Window.partitionBy(*keys)


def guarded(agg: Callable[[Column], Column], col: str | Column, min_count: int,
            frame: WindowSpec) -> Column:
    """``agg(col)`` over ``frame`` once the frame holds ``min_count`` non-null values."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.count(c).over(frame) >= min_count, agg(c).over(frame))


def rolling_sum(col: str | Column, n: int, keys: Sequence[str] = KEYS) -> Column:
    return guarded(F.sum, col, n, trailing(n, keys))


def rolling_mean(col: str | Column, n: int, keys: Sequence[str] = KEYS) -> Column:
    return guarded(F.avg, col, n, trailing(n, keys))


def rolling_std(col: str | Column, n: int, keys: Sequence[str] = KEYS) -> Column:
    """Sample standard deviation (ddof 1) over the last n rows."""
    return guarded(F.stddev_samp, col, n, trailing(n, keys))
