"""Look-ups by adapter id or property, and the entity / chunk view of a node."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.operators.filters import where_equal, where_in
from weftgraph.plans.ordering import check_limit


def get_nodes(
    nodes: DataFrame,
    properties: Mapping[str, Any] | None = None,
    ids: Sequence[str] | DataFrame | None = None,
    id_column: str = "name",
    limit: int | None = None,
) -> DataFrame:
    """Nodes by business key or by properties; ids win, neither gives no rows.

    All of them, unless the caller sets a limit; then the smallest internal ids.
    """
    if isinstance(ids, DataFrame) or ids:
        rows = where_in(nodes, id_column, ids)
    elif properties:
        rows = where_equal(nodes, properties)
    else:
        rows = nodes.filter(F.lit(False))
    return rows if limit is None else rows.orderBy("id").limit(check_limit(limit))


def entity_view(nodes: DataFrame, id_column: str = "key") -> DataFrame:
    """A node with text is a chunk; any other is an entity named by ``name``, else by its id."""
    is_chunk = F.col("text").isNotNull()
    return nodes.select(
        F.col(id_column).alias("node_id"),
        F.when(is_chunk, F.lit("chunk")).otherwise(F.lit("entity")).alias("kind"),
        F.when(~is_chunk, F.coalesce(F.col("name"), F.col(id_column))).alias("entity_name"),
        F.when(is_chunk, F.lit("Chunk")).otherwise(F.lit("Entity")).alias("label"),
        F.col("text"),
    )
