"""Scans, look-ups, appends and the fact listing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.plans.ordering import with_dense_ids


def lookup_nodes(nodes: DataFrame, ids: DataFrame) -> DataFrame:
    """Nodes whose internal ``id`` is asked for. ``ids`` may hold any number of ids, with repeats.

    Repeats go map-side before the join: Spark splits a hot key of the left side only. AQE broadcasts
    the ids once they have proved small.
    """
    return nodes.join(ids.select("id").distinct(), "id", "left_semi")


def next_id(existing: DataFrame, id_col: str = "id") -> Column:
    """The first free id after ``existing`` (1 for an empty table), as a scalar subquery."""
    return existing.agg(F.coalesce(F.max(id_col), F.lit(0)) + 1).scalar()


def create_nodes(existing: DataFrame, new_rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Give ``new_rows`` positive ids after the largest stored one, in the order of ``order``.

    ``order`` should identify a row, so that a rerun hands out the same ids.
    """
    return with_dense_ids(new_rows, order, "id", start=next_id(existing))


def create_edges(
    nodes_src: DataFrame,
    nodes_dst: DataFrame,
    requested: DataFrame,
    order: Sequence[str],
    existing: DataFrame | None = None,
) -> DataFrame:
    """Append edges whose two ends exist. A second edge of the same pair stays a parallel edge."""
    kept = requested.join(nodes_src.select(F.col("id").alias("src")), "src", "left_semi")
    kept = kept.join(nodes_dst.select(F.col("id").alias("dst")), "dst", "left_semi")
    start = 1 if existing is None else next_id(existing, "edge_id")
    return with_dense_ids(kept, order, "edge_id", start=start)


def facts(edges: DataFrame, names: DataFrame) -> DataFrame:
    """Every edge as ``subject, relation, object``; ``names`` is ``(id, name)``."""
    subjects = names.select(F.col("id").alias("src"), F.col("name").alias("subject"))
    objects = names.select(F.col("id").alias("dst"), F.col("name").alias("object"))
    return (
        edges.join(subjects, "src")
        .join(objects, "dst")
        .select("subject", F.col("type").alias("relation"), "object")
    )


def write_facts(fact_rows: DataFrame, path: str) -> None:
    """Sink: one folder per relation, so that readers of one relation prune the others.

    ``rebalance`` lets AQE split a relation that holds most rows over several files.
    """
    fact_rows.hint("rebalance", "relation").write.mode("overwrite").partitionBy("relation").parquet(path)
