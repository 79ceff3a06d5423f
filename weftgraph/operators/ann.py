"""Approximate nearest neighbours: k-means cells, of which a query reads the closest few."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.functions.distance import check_metric
from weftgraph.functions.nearest import Nearest, to_matrix
from weftgraph.operators.vector import BROADCAST_VALUES, HITS, collect_queries, empty_hits, usable
from weftgraph.plans.ordering import check_limit, top_k_per_group


@dataclass
class CellIndex:
    """Vectors with their cell, and the cell centres (a bounded, driver-sized matrix)."""

    vectors: DataFrame
    centres: np.ndarray
    metric: str

    def write(self, path: str) -> "CellIndex":
        """Store the vectors sorted by cell, so that a search skips row groups of other cells.

        Ranges are cut on ``(cell, id)``: a cell that holds most rows spreads over many files.
        """
        placed = self.vectors.repartitionByRange("cell", "id").sortWithinPartitions("cell")
        placed.write.mode("overwrite").parquet(path)
        return CellIndex(self.vectors.sparkSession.read.parquet(path), self.centres, self.metric)


def build_cells(
    vectors: DataFrame, cells: int, metric: str = "l2", seed: int = 42, rounds: int = 10
) -> CellIndex:
    """Assign every vector to the nearest of ``cells`` centres (k-means over all vectors)."""
    metric = check_metric(metric)
    raw = usable(vectors).withColumn("__raw", array_to_vector(F.col("embedding").cast("array<double>")))
    if metric == "cosine":
        # Direction is all that counts, so the centres are found on unit vectors.
        featured = Normalizer(inputCol="__raw", outputCol="__features").transform(raw).drop("__raw")
    else:
        featured = raw.withColumnRenamed("__raw", "__features")
    model = KMeans(
        k=check_limit(cells, "cells"), seed=seed, maxIter=rounds, featuresCol="__features", predictionCol="cell"
    ).fit(featured)
    placed = model.transform(featured).drop("__features")
    return CellIndex(placed, np.array(model.clusterCenters()), metric)


def probes(centres: np.ndarray, queries: np.ndarray, nprobe: int, metric: str) -> np.ndarray:
    """The ``nprobe`` closest cells of every query."""
    if metric == "cosine":
        length = np.linalg.norm(queries, axis=1, keepdims=True)
        queries = queries / np.where(length > 0, length, 1)
    gaps = (centres**2).sum(axis=1)[None, :] - 2 * queries @ centres.T
    return np.argsort(gaps, axis=1, kind="stable")[:, : min(nprobe, len(centres))]


def ann_search(
    index: CellIndex,
    queries: DataFrame,
    k: int = 10,
    nprobe: int = 8,
    max_broadcast_values: int = BROADCAST_VALUES,
) -> DataFrame:
    """Nearest rows of every query among its ``nprobe`` closest cells; more cells, more recall.

    A bounded query set goes to the tasks that read the probed cells, so a cell is never gathered
    in one place. A larger one is joined by cell, with big cells cut into blocks.
    """
    check_limit(k, "k")
    check_limit(nprobe, "nprobe")
    bounded = collect_queries(queries, max_broadcast_values)
    if bounded is None:
        partial = _by_cell(index, queries, k, nprobe)
    elif len(bounded[0]) == 0:
        return empty_hits(index.vectors)
    else:
        query_ids, matrix = bounded
        chosen = probes(index.centres, matrix, nprobe, index.metric)
        wanted = {int(c): np.flatnonzero((chosen == c).any(axis=1)) for c in np.unique(chosen)}
        metric = index.metric

        def run(batches):
            best = Nearest(matrix, k, metric)
            for batch in batches:
                cell = np.asarray(batch.column("cell"))
                ids = np.asarray(batch.column("id"), dtype=np.int64)
                rows = to_matrix(batch.column("embedding"), matrix.shape[1])
                for here in np.unique(cell):
                    inside = cell == here
                    best.add(ids[inside], rows[inside], wanted[int(here)])
            yield best.result(query_ids)

        in_reach = index.vectors.filter(F.col("cell").isin(sorted(wanted)))
        partial = in_reach.select("id", "embedding", "cell").mapInArrow(run, HITS)
    return top_k_per_group(partial, ["query_id"], [F.col("distance"), F.col("id")], k)


def _by_cell(index: CellIndex, queries: DataFrame, k: int, nprobe: int, block: int = 50_000) -> DataFrame:
    """Queries sent to their cells by a shuffle; a cell of n rows is split into n / ``block`` parts."""
    centres, metric = index.centres, index.metric

    def place(batches):
        for batch in batches:
            chosen = probes(centres, to_matrix(batch.column("embedding"), centres.shape[1]), nprobe, metric)
            times = np.repeat(np.arange(batch.num_rows), chosen.shape[1])
            moved = batch.take(pa.array(times))
            yield moved.append_column("cell", pa.array(chosen.ravel().astype(np.int32)))

    asked = queries.filter(F.col("embedding").isNotNull()).select(F.col("query_id").cast("long"), "embedding")
    kind = asked.schema["embedding"].dataType.simpleString()
    asked = asked.mapInArrow(place, f"query_id long, embedding {kind}, cell int")
    # One row per cell: bounded by the number of centres.
    sizes = F.broadcast(
        index.vectors.groupBy("cell").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    )
    q_blocks = max(1, math.ceil(asked.count() / max(1, nprobe) / 4_000))
    rows = (
        index.vectors.join(sizes, "cell")
        .withColumn("vb", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    )
    asked = (
        asked.join(sizes, "cell")
        .withColumn("vb", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)).cast("int"))
    )
    keys = ["cell", "vb", "qb"]

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        matrix = to_matrix(asked["embedding"])
        best = Nearest(matrix, k, metric)
        if asked.num_rows and rows.num_rows:
            best.add(np.asarray(rows["id"], dtype=np.int64), to_matrix(rows["embedding"], matrix.shape[1]))
        return pa.Table.from_batches([best.result(np.asarray(asked["query_id"], dtype=np.int64))])

    left = rows.select("id", "embedding", *keys).groupBy(*keys)
    return left.cogroup(asked.select("query_id", "embedding", *keys).groupBy(*keys)).applyInArrow(run, HITS)


def recall_at_k(exact: DataFrame, approximate: DataFrame) -> DataFrame:
    """Per query: share of the exact neighbours that the approximate search found."""
    found = approximate.select("query_id", "id", F.lit(1).alias("__hit"))
    return (
        exact.join(found, ["query_id", "id"], "left")
        .groupBy("query_id")
        .agg((F.count("__hit") / F.count("*")).alias("recall"))
    )
