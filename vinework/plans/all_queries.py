"""Imports every query module, so that the registry is complete."""

from vinework.plans import dump_queries, edge_queries, graph_queries, job_queries, store_queries, text_queries, vector_queries, write_queries  # noqa: F401
from vinework.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
