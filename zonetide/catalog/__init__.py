"""Registered queries and their SQL oracles."""

from zonetide.catalog import q_changes, q_core, q_features, q_rollups, q_scalars, q_stored  # noqa: F401
from zonetide.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
