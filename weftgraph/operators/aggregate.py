"""Counts, grouping and ranks over graph rows.

All of them aggregate map-side first, so a type or label that holds most rows costs one
partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.plans.ordering import global_rank, top_k_per_group

__all__ = ["count_by", "count_by_type", "global_rank", "top_k_per_group"]


def count_by(df: DataFrame, keys: Sequence[str], alias: str = "count") -> DataFrame:
    """A count next to plain columns groups by those columns; no keys give one row."""
    return df.groupBy(*keys).agg(F.count("*").alias(alias))


def count_by_type(edges: DataFrame) -> DataFrame:
    """Edges per relationship type, largest first."""
    return count_by(edges, ["type"]).orderBy(F.desc("count"), "type")
