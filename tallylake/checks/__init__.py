"""Every operator as a named query over the given tables."""

from tallylake.checks import aviation_queries, cdc_queries, gold_queries, lake_queries, quality_queries  # noqa: F401
from tallylake.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
