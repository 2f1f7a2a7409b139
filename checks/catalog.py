"""All checked queries."""

from checks import catalog_flows, catalog_retrieval, catalog_scores  # noqa: F401
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
