"""Registered queries over the benchmark tables, each with its SQL statement where SQL can say it."""

from recordwell.catalog.registry import ORACLES, QUERIES
from recordwell.catalog import columns, enrichment, extracts, matching, places, products, stages, state, tables  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
