"""Registration of (Spark query, oracle SQL) pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from suite.rounding import rounded
from tidepanel.sources.star_views import StarViews

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, digits: int = 6, exact: tuple[str, ...] = ()):
    """Register a function of the views under ``name``; its doubles are rounded."""
    def deco(fn: Callable[[StarViews], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(StarViews(spark, sf_dir)), digits, exact)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def also(name: str, older: str) -> None:
    """An older name of a query, with its result."""
    QUERIES[older] = QUERIES[name]
    if name in ORACLES:
        ORACLES[older] = ORACLES[name]
