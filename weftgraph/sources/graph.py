"""A property graph held as one typed DataFrame per label and per edge type."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Source = DataFrame | Callable[[], DataFrame]


class PropertyGraph:
    """Node tables ``(id, <props>)`` by label and edge tables ``(src, dst, <props>)`` by type.

    A source may be a function, so that a label nobody asks for is never planned.
    """

    def __init__(self, nodes: Mapping[str, Source], edges: Mapping[str, Source]):
        self._nodes = dict(nodes)
        self._edges = dict(edges)

    @property
    def labels(self) -> list[str]:
        return sorted(self._nodes)

    @property
    def edge_types(self) -> list[str]:
        return sorted(self._edges)

    def nodes(self, label: str) -> DataFrame:
        """Scan of one label. Columns that are not used later are never read."""
        source = self._nodes[label]
        return source() if callable(source) else source

    def all_nodes(self, *labels: str) -> DataFrame:
        """Label-free scan: every node with its ``labels``; missing properties are NULL."""
        parts = [
            self.nodes(name).withColumn("labels", F.array(F.lit(name))) for name in (labels or self.labels)
        ]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def edges(self, *types: str) -> DataFrame:
        """Scan of one type, of several (alternation) or, with no name, of all types.

        Only the tables asked for take part. The result always has a ``type`` column.
        """
        names = types or tuple(self.edge_types)
        parts = []
        for name in names:
            source = self._edges[name]
            frame = source() if callable(source) else source
            if "type" in frame.columns:
                raise ValueError(f"edges of {name} have a property called type; rename it")
            parts.append(frame.withColumn("type", F.lit(name)))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def links(self, *types: str) -> DataFrame:
        """Edges reduced to ``src, type, dst``, the shape traversal and matching need."""
        return self.edges(*types).select("src", "type", "dst")
