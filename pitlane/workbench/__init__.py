"""Bindings of the operators to a set of test tables, with equivalent SQL."""

# ruff: noqa: F401

from pitlane.workbench import (
    lap_queries,
    learning_queries,
    similarity_queries,
    storage_queries,
    telemetry_queries,
)  # noqa: F401
from pitlane.workbench.book import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
