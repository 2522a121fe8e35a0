"""Registry of named queries: a Spark builder and, where SQL can express the
operator, the DuckDB twin used as the independent oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from quiver.session import tune

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    key: str
    build: Builder
    sql: str | None
    doc: str


QUERIES: dict[str, Query] = {}


def register(key: str, sql: str | None = None):
    """Decorator: ``@register("log_returns", SQL)`` on a ``(spark, sf_dir)`` builder."""
    def deco(fn: Builder) -> Builder:
        if key in QUERIES:
            raise KeyError(f"query {key!r} registered twice")

        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            return fn(spark, sf_dir)
        build.__name__ = fn.__name__
        build.__doc__ = fn.__doc__
        QUERIES[key] = Query(key, build, sql, (fn.__doc__ or "").strip())
        return fn
    return deco
