"""Registered queries: every operator over the given tables, with an equivalent SQL text."""

from lake_queries import columns_rows, drift, nested_tables, planning, sources_streams  # noqa: F401  (importing registers)
from lake_queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
