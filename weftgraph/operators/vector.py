"""Exact nearest neighbours of many queries over a whole vector table."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.functions.distance import check_metric
from weftgraph.functions.nearest import Nearest, to_matrix
from weftgraph.plans.materialize import materialize
from weftgraph.plans.ordering import check_limit, top_k_per_group, with_dense_ids
from weftgraph.plans.sizing import broadcast_if_small

#: Largest query set sent to every task: numbers in all query vectors together (32 MB).
BROADCAST_VALUES = 4_000_000
#: Rows of either side per task in the blocked plan.
BLOCK_VECTORS = 50_000
BLOCK_QUERIES = 4_000

HITS = "query_id long, id long, distance double"


def collect_queries(queries: DataFrame, max_values: int = BROADCAST_VALUES) -> tuple[np.ndarray, np.ndarray] | None:
    """Query ids and vectors when all their numbers fit the bound, else None. They are counted in the tasks first."""
    first = queries.filter(F.col("embedding").isNotNull()).select("query_id", "embedding")
    size = first.agg(F.coalesce(F.sum(F.size("embedding")), F.lit(0))).first()[0]
    if size == 0:
        return np.empty(0, np.int64), np.empty((0, 0))
    if size > max_values:
        return None
    rows = first.toArrow().sort_by("query_id")
    return np.asarray(rows["query_id"].combine_chunks(), dtype=np.int64), to_matrix(rows["embedding"])


def usable(vectors: DataFrame) -> DataFrame:
    """``(id, embedding)`` of the rows that have a vector."""
    return vectors.filter(F.col("embedding").isNotNull()).select(F.col("id").cast("long"), "embedding")


def empty_hits(vectors: DataFrame) -> DataFrame:
    return vectors.sparkSession.createDataFrame([], f"{HITS}, rank int")


def knn(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    metric: str = "cosine",
    max_broadcast_values: int = BROADCAST_VALUES,
) -> DataFrame:
    """The ``k`` nearest ``(id, embedding)`` rows of every ``(query_id, embedding)`` row, exact.

    A query set of checked size goes to every task: the vectors are read where they lie, each
    task keeps ``k`` rows per query, and only those are shuffled. A larger query set is cut into
    blocks that meet blocks of vectors, so no task ever holds more than one block of each side.
    Equal distances go to the smaller id; result columns are ``query_id, id, distance, rank``.
    """
    check_limit(k, "k")
    metric = check_metric(metric)
    bounded = collect_queries(queries, max_broadcast_values)
    if bounded is None:
        partial = _blocked(vectors, queries, k, metric)
    elif len(bounded[0]) == 0:
        return empty_hits(vectors)
    else:
        partial = usable(vectors).mapInArrow(_scan(*bounded, k, metric), HITS)
    return top_k_per_group(partial, ["query_id"], [F.col("distance"), F.col("id")], k)


def _scan(query_ids: np.ndarray, matrix: np.ndarray, k: int, metric: str) -> Callable:
    def run(batches):
        best = Nearest(matrix, k, metric)
        for batch in batches:
            best.add(np.asarray(batch.column("id"), dtype=np.int64), to_matrix(batch.column("embedding"), matrix.shape[1]))
        yield best.result(query_ids)

    return run


def _blocked(vectors: DataFrame, queries: DataFrame, k: int, metric: str) -> DataFrame:
    """Block by block comparison. Blocks are cut by a hash of the id, so all have one size."""
    rows = usable(vectors)
    asked = queries.filter(F.col("embedding").isNotNull()).select(F.col("query_id").cast("long"), "embedding")
    v_blocks = max(1, math.ceil(rows.count() / BLOCK_VECTORS))
    q_blocks = max(1, math.ceil(asked.count() / BLOCK_QUERIES))

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = rows.withColumn("vb", F.pmod(F.xxhash64("id"), F.lit(v_blocks)).cast("int")).withColumn("qb", every(q_blocks))
    right = asked.withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)).cast("int")).withColumn(
        "vb", every(v_blocks)
    )

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        matrix = to_matrix(asked["embedding"])
        best = Nearest(matrix, k, metric)
        if asked.num_rows and rows.num_rows:
            best.add(np.asarray(rows["id"], dtype=np.int64), to_matrix(rows["embedding"], matrix.shape[1]))
        return pa.Table.from_batches([best.result(np.asarray(asked["query_id"], dtype=np.int64))])

    return left.groupBy("vb", "qb").cogroup(right.groupBy("vb", "qb")).applyInArrow(run, HITS)


def similarity_search(
    nodes: DataFrame, queries: DataFrame, k: int = 5, embedding: str = "embedding", metric: str = "cosine"
) -> DataFrame:
    """Nearest nodes with their properties. ``nodes`` is already one label; its other columns come back.

    Ranking reads only id and vector; the properties of the ``k`` hits are joined afterwards.
    """
    hits = materialize(knn(nodes.select("id", F.col(embedding).alias("embedding")), queries, k, metric))
    return broadcast_if_small(hits).join(nodes.drop(embedding), "id")


def append_vectors(
    existing: DataFrame, batches: DataFrame, order: list[str], batch_col: str = "batch"
) -> tuple[DataFrame, DataFrame]:
    """Append batches of vectors with contiguous ids; also returns ``(batch, start, end)`` per batch.

    Ids go on after the largest stored id (from 0 for an empty store); ``end`` is exclusive.
    """
    start = existing.agg(F.coalesce(F.max("id") + 1, F.lit(0))).scalar()
    rows = with_dense_ids(batches, [batch_col, *order], "id", start=start)
    ranges = rows.groupBy(batch_col).agg(F.min("id").alias("start"), (F.max("id") + 1).alias("end"))
    return rows, ranges


def next_range(existing: DataFrame) -> DataFrame:
    """The range an empty batch gets: ``(next, next)``."""
    following = F.coalesce(F.max("id") + 1, F.lit(0))
    return existing.agg(following.alias("start"), following.alias("end"))
