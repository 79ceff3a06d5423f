"""Moving a nested property out into nodes of its own, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.plans.ordering import with_dense_ids


def link_type(column: str) -> str:
    return "HAS_" + column.upper()


def detach_document(
    nodes: DataFrame, column: str, start: Column | int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Promote struct ``column`` to nodes: (nodes without it, new nodes, ``HAS_<COLUMN>`` edges).

    New ids run from ``start`` in the order of the owning nodes; a NULL property makes no node.
    """
    full = nodes.filter(F.col(column).isNotNull()).select(F.col("id").alias("src"), F.col(column).alias("__value"))
    numbered = with_dense_ids(full, ["src"], "id", start)
    edges = numbered.select("src", F.lit(link_type(column)).alias("type"), F.col("id").alias("dst"))
    return nodes.drop(column), numbered.select("id", "__value.*"), edges


def attach_document(
    nodes: DataFrame, documents: DataFrame, edges: DataFrame, column: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Inverse of :func:`detach_document`: (nodes with the struct, remaining documents, remaining edges).

    With several documents on one node the one of the largest id stays as the property.
    """
    fields = [c for c in documents.columns if c != "id"]
    packed = documents.select(F.col("id").alias("dst"), F.struct(*fields).alias("__value"))
    links = edges.filter(F.col("type") == link_type(column))
    attached = links.join(packed, "dst")
    per_node = attached.groupBy(F.col("src").alias("id")).agg(F.max_by("__value", "dst").alias(column))
    used = links.select(F.col("dst").alias("id"))
    rest = documents.join(used, "id", "left_anti")
    kept = edges.join(used.withColumnRenamed("id", "dst"), "dst", "left_anti")
    return nodes.join(per_node, "id", "left"), rest, kept
