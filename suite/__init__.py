"""Registered queries over the star-schema tables, each with its oracle SQL."""

from suite import domain_queries, evaluation_queries, factor_queries, library_queries, quality_queries  # noqa: F401
from suite.common import ORACLES, QUERIES  # noqa: F401
