"""Registered queries over the test tables, each with equivalent SQL where there is any."""

from ticktalk.catalog import batch_queries, order_queries, profile_queries, run_queries, stream_queries, vector_queries  # noqa: F401
from ticktalk.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
