"""Imports every query module so that the registry is complete."""

from __future__ import annotations

from quiver.plans import backtest_queries, feature_queries, market_queries, model_queries, regime_queries, timeseries_queries, classifier_queries, io_queries, job_queries  # noqa: F401
from quiver.plans.registry import QUERIES


def all_queries():
    return dict(QUERIES)
