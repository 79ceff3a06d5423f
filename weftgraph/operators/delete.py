"""Deletes: the surviving tables are returned, nothing is changed in place."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.operators.filters import where_equal, where_in
from weftgraph.plans.materialize import materialize
from weftgraph.plans.sizing import broadcast_if_small


def detach_delete(nodes: DataFrame, edges: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Remove the nodes whose ``id`` is in ``targets``, and every edge at either end of one.

    Few targets go to the nodes and edges, which then stay where they are.
    """
    gone = broadcast_if_small(materialize(targets.select("id").distinct()))
    left = nodes.join(gone, "id", "left_anti")
    links = edges.join(gone.withColumnRenamed("id", "src"), "src", "left_anti")
    return left, links.join(gone.withColumnRenamed("id", "dst"), "dst", "left_anti")


def delete(
    nodes: DataFrame,
    edges: DataFrame,
    entity_names: Sequence[str] | DataFrame | None = None,
    relation_names: Sequence[str] | None = None,
    properties: dict[str, Any] | None = None,
    ids: Sequence[str] | DataFrame | None = None,
    id_column: str = "key",
    name_column: str = "name",
) -> tuple[DataFrame, DataFrame]:
    """Delete by adapter id, else by name; ids win, neither deletes nothing."""
    if relation_names or properties:
        raise NotImplementedError("delete cannot filter by relation_names or properties")
    if isinstance(ids, DataFrame) or ids:
        targets = where_in(nodes, id_column, ids)
    elif isinstance(entity_names, DataFrame) or entity_names:
        targets = where_in(nodes, name_column, entity_names)
    else:
        return nodes, edges
    return detach_delete(nodes, edges, targets)


def blocked_deletes(edges: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets of a plain delete that still have edges: ``id, edges``. Empty means it may go on.

    Only the edge ends at a target are counted, map-side first.
    """
    gone = broadcast_if_small(materialize(targets.select("id").distinct()))
    ends = edges.select(F.col("src").alias("id")).unionByName(edges.select(F.col("dst").alias("id")))
    return ends.join(gone, "id", "left_semi").groupBy("id").agg(F.count("*").alias("edges"))


def purge(nodes: DataFrame, edges: DataFrame, properties: dict[str, Any]) -> tuple[DataFrame, DataFrame]:
    """Detach-delete everything that carries the given scope tags."""
    return detach_delete(nodes, edges, where_equal(nodes, properties))
