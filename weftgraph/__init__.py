"""weftgraph: graph, vector and full-text retrieval over whole tables with Spark DataFrames."""

from weftgraph.sources.graph import PropertyGraph
from weftgraph.sources.tables import table_graph

__all__ = ["PropertyGraph", "table_graph"]
