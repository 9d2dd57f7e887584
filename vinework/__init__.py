"""Property-graph and vector-retrieval analytics on Spark DataFrames.

Graphs are node and edge DataFrames, document collections are DataFrames, and
every operator takes whole tables and returns a DataFrame.
"""

from vinework.functions.vectors import Metric
from vinework.operators.search import Search, search
from vinework.sources.collection import CollectionStore
from vinework.sources.graph import GraphStore, PropertyGraph

__all__ = [
    "CollectionStore",
    "GraphStore",
    "Metric",
    "PropertyGraph",
    "Search",
    "search",
]
