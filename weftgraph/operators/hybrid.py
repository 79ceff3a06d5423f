"""Graph, vector and text combined in one ranking."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.functions.distance import distance
from weftgraph.functions.fusion import min_max, rows_before
from weftgraph.functions.nearest import TIE_DECIMALS, best_rows, pair_distances, to_matrix
from weftgraph.functions.text import SCORE_DECIMALS
from weftgraph.operators.match import reached_nodes
from weftgraph.operators.text import TextIndex, asked_once, score
from weftgraph.operators.vector import BROADCAST_VALUES, collect_queries, knn, usable
from weftgraph.plans.materialize import materialize
from weftgraph.plans.ordering import check_limit, top_k_per_group
from weftgraph.plans.sizing import absent_from, broadcast_if_small

#: Constant of reciprocal rank fusion (Cormack, Clarke and Buettcher, 2009).
RRF_CONSTANT = 60
#: Most queries fused in one pass; more are fused in parts, with one pass each.
FUSED_QUERIES = 2_000


def hybrid_search(
    edges: DataFrame,
    starts: DataFrame,
    vectors: DataFrame,
    top_k: int = 10,
    max_depth: int = 2,
    metric: str = "cosine",
) -> DataFrame:
    """Traverse outbound from every ``(id, embedding)`` start, then rank what was reached.

    ``embedding`` of a start is its query vector. Nodes without a vector and the start are left
    out. Result: ``start, id, depth, distance, rank``.
    """
    reached = reached_nodes(edges, starts.select("id"), "outbound", max_depth)
    asked = starts.select(F.col("id").alias("start"), F.col("embedding").alias("__query"))
    rows = reached.join(usable(vectors), "id").join(asked, "start")
    rows = rows.withColumn("distance", F.round(distance("embedding", "__query", metric), TIE_DECIMALS))
    rows = rows.filter(F.col("distance").isNotNull()).select("start", "id", "depth", "distance")
    return top_k_per_group(rows, ["start"], [F.col("distance"), F.col("id")], top_k)


def vec_score(embedding: Column | str, query: Column | str) -> Column:
    """Similarity ``1 - cosine distance``; 0 without an embedding."""
    return F.coalesce(1 - distance(embedding, query, "cosine"), F.lit(0.0))


def text_and_vector_scores(hits: DataFrame, vectors: DataFrame, queries: DataFrame) -> DataFrame:
    """``query_id, id, text_score, vec_score`` of every text hit."""
    asked = queries.select("query_id", F.col("embedding").alias("__query"))
    rows = hits.join(vectors.select("id", "embedding"), "id", "left").join(asked, "query_id", "left")
    return rows.select(
        "query_id", "id", F.col("score").alias("text_score"), vec_score("embedding", "__query").alias("vec_score")
    )


def text_match(nodes: DataFrame, index: TextIndex, clauses: DataFrame, kinds=("term",)) -> DataFrame:
    """Nodes that satisfy at least one of the queries; queries that ask the same are searched once."""
    clauses, _ = asked_once(clauses)
    return nodes.join(score(index, clauses, kinds).select("id").distinct(), "id", "left_semi")


def candidates(nodes: DataFrame, index: TextIndex, clauses: DataFrame, vectors: DataFrame, kinds=("term",)) -> DataFrame:
    """Nodes that match a query or have an embedding, with both facts as columns."""
    clauses, _ = asked_once(clauses)
    matched = score(index, clauses, kinds).select("id").distinct().withColumn("__text", F.lit(True))
    embedded = usable(vectors).select("id").withColumn("__vector", F.lit(True))
    rows = nodes.join(matched, "id", "left").join(embedded, "id", "left")
    rows = rows.withColumn("matched", F.col("__text").isNotNull()).withColumn("embedded", F.col("__vector").isNotNull())
    return rows.filter(F.col("matched") | F.col("embedded")).drop("__text", "__vector")


def fuse_ranks(lists: list[DataFrame], k: int = 10, constant: int = RRF_CONSTANT) -> DataFrame:
    """Reciprocal rank fusion of ranked lists ``(query_id, id, rank)``; an absent rank adds nothing."""
    rows = lists[0].select("query_id", "id", "rank")
    for other in lists[1:]:
        rows = rows.unionByName(other.select("query_id", "id", "rank"))
    fused = rows.groupBy("query_id", "id").agg(
        F.round(F.sum(1 / (F.lit(constant) + F.col("rank"))), TIE_DECIMALS).alias("score")
    )
    return top_k_per_group(fused, ["query_id"], [F.desc("score"), F.col("id")], k)


def rrf_search(
    hits: DataFrame,
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    constant: int = RRF_CONSTANT,
    max_broadcast_values: int = BROADCAST_VALUES,
) -> DataFrame:
    """The ``k`` best of text hits and vector neighbours by reciprocal rank, exact.

    Neither list is ever ranked as a whole. A row outside the first ``constant + 2k`` places of
    both lists scores at most ``2 / (2 * constant + 2k + 1)``, less than the row at place ``k`` of
    one list, so only the first places are candidates. For these the place in the other list is
    found by counting the rows before them, task by task.
    """
    check_limit(k, "k")
    depth = constant + 2 * k
    bounded = collect_queries(queries, max_broadcast_values)
    if bounded is None or len(bounded[0]) > FUSED_QUERIES:
        hits = materialize(hits)
        return _in_parts(
            lambda part_hits, part, bound: rrf_search(part_hits, vectors, part, k, constant, bound),
            hits, queries, max_broadcast_values,
        )
    hits = materialize(hits.select("query_id", "id", "score"))
    by_text = top_k_per_group(hits, ["query_id"], [F.desc("score"), F.col("id")], depth)
    by_text = materialize(by_text.select("query_id", "id", "rank"))
    if len(bounded[0]) == 0:
        return fuse_ranks([by_text], k, constant)
    near = materialize(knn(vectors, queries, depth, "cosine", max_broadcast_values).select("query_id", "id", "rank"))
    return fuse_ranks(
        [by_text, near, _missing_text_ranks(hits, by_text, near), _missing_vector_ranks(vectors, by_text, near, bounded)],
        k,
        constant,
    )


def _in_parts(search: Callable, hits: DataFrame, queries: DataFrame, max_values: int) -> DataFrame:
    """Query sets beyond the bound: hash parts of the queries, one search each.

    A query has one vector; an id that repeats could not be parted and is an error. The bound is at
    least one vector, so a part of one query always fits.
    """
    asked = queries.agg(F.max(F.size("embedding")).alias("size"), F.count("*").alias("n"), F.count_distinct("query_id").alias("ids"))
    size, n, ids = asked.first()
    if n != ids:
        raise ValueError("each query_id must have one row")
    size = max(1, size or 1)
    max_values = max(max_values, size)
    most = max(1, min(FUSED_QUERIES, max_values // size))
    parts = max(2, -(-2 * n // most))
    found = None
    for part in range(parts):
        # The number of parts salts the hash: a part that is still too large is cut anew.
        own = F.pmod(F.xxhash64("query_id", F.lit(parts)), F.lit(parts)) == part
        rows = search(hits.filter(own), queries.filter(own), max_values)
        found = rows if found is None else found.unionByName(rows)
    return found


def _places(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Places to be counted for, by query. At most two candidate lists per (bounded) query."""
    table = rows.select("query_id", "id", "value").toArrow()
    query = np.asarray(table["query_id"], dtype=np.int64)
    ids, values = np.asarray(table["id"], dtype=np.int64), np.asarray(table["value"], dtype=np.float64)
    return {int(q): (values[query == q], ids[query == q]) for q in np.unique(query)}


COUNTS = "query_id long, id long, n long"


def _count_batch(found: dict[int, np.ndarray]) -> Callable:
    def result(places) -> pa.RecordBatch:
        query = [np.full(len(found[q]), q) for q in found] or [np.empty(0, np.int64)]
        ids = [places[q][1] for q in found] or [np.empty(0, np.int64)]
        counts = [found[q] for q in found] or [np.empty(0, np.int64)]
        columns = [np.concatenate(c).astype(np.int64) for c in (query, ids, counts)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "id", "n"])

    return result


def _ranks(partial: DataFrame) -> DataFrame:
    return partial.groupBy("query_id", "id").agg((F.sum("n") + 1).cast("int").alias("rank"))


def _missing_text_ranks(hits: DataFrame, by_text: DataFrame, near: DataFrame) -> DataFrame:
    """Text places of vector candidates that have a text score but are not among the first hits."""
    # A bounded number of rows per query goes to the hits, which stay where they are.
    missing = materialize(near.join(by_text, ["query_id", "id"], "left_anti").select("query_id", "id"))
    asked = hits.join(broadcast_if_small(missing), ["query_id", "id"])
    places = _places(asked.withColumn("value", -F.col("score")))

    def run(batches):
        counts = {q: np.zeros(len(ids), np.int64) for q, (_, ids) in places.items()}
        for batch in batches:
            query = np.asarray(batch.column("query_id"), dtype=np.int64)
            ids = np.asarray(batch.column("id"), dtype=np.int64)
            values = -np.asarray(batch.column("score"), dtype=np.float64)
            for q in np.intersect1d(np.unique(query), list(places)):
                own = query == q
                counts[int(q)] += rows_before(values[own], ids[own], *places[int(q)])
        yield _count_batch(counts)(places)

    return _ranks(hits.mapInArrow(run, COUNTS))


def _missing_vector_ranks(vectors: DataFrame, by_text: DataFrame, near: DataFrame, bounded) -> DataFrame:
    """Vector places of text candidates that have an embedding but are not among the nearest."""
    query_ids, matrix = bounded
    missing = materialize(by_text.join(near, ["query_id", "id"], "left_anti"))
    asked = usable(vectors).join(broadcast_if_small(missing), "id")
    position = {int(q): i for i, q in enumerate(query_ids)}

    def measure(batches):
        for batch in batches:
            own = np.array([position.get(int(q), -1) for q in np.asarray(batch.column("query_id"))], dtype=np.int64)
            rows = to_matrix(batch.column("embedding"), matrix.shape[1])
            value = np.full(len(own), np.inf)
            value[own >= 0] = pair_distances(rows[own >= 0], matrix[own[own >= 0]], "cosine")
            value = np.round(value, TIE_DECIMALS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("query_id"), batch.column("id"), pa.array(value)], names=["query_id", "id", "value"]
            )

    measured = asked.select("query_id", "id", "embedding").mapInArrow(measure, "query_id long, id long, value double")
    places = _places(measured.filter(F.col("value") != float("inf")))

    def run(batches):
        counts = {q: np.zeros(len(ids), np.int64) for q, (_, ids) in places.items()}
        for batch in batches:
            ids = np.asarray(batch.column("id"), dtype=np.int64)
            rows = to_matrix(batch.column("embedding"), matrix.shape[1])
            for q, place in places.items():
                values = np.round(pair_distances(rows, matrix[position[q]][None, :], "cosine"), TIE_DECIMALS)
                usable_rows = np.isfinite(values)
                counts[q] += rows_before(values[usable_rows], ids[usable_rows], *place)
        yield _count_batch(counts)(places)

    return _ranks(usable(vectors).mapInArrow(run, COUNTS))


def weighted_search(
    hits: DataFrame,
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    text_weight: float = 0.5,
    vector_weight: float = 0.5,
    max_broadcast_values: int = BROADCAST_VALUES,
) -> DataFrame:
    """The ``k`` best by a weighted sum of per-query min-max scaled text and vector scores.

    Two passes over the vectors: one for the range of the vector scores, one that adds the text
    scores lying next to each vector and keeps ``k`` rows per query and task.
    """
    check_limit(k, "k")
    bounded = collect_queries(queries, max_broadcast_values)
    if bounded is None or len(bounded[0]) > FUSED_QUERIES:
        return _in_parts(
            lambda part_hits, part, bound: weighted_search(part_hits, vectors, part, k, text_weight, vector_weight, bound),
            materialize(hits), queries, max_broadcast_values,
        )
    hits = materialize(hits.select("query_id", "id", "score"))
    text_span = hits.groupBy("query_id").agg(F.min("score").alias("low"), F.max("score").alias("high"))
    width = F.col("high") - F.col("low")
    scaled = hits.join(broadcast_if_small(text_span), "query_id").select(
        "id", "query_id", F.when(width > 0, (F.col("score") - F.col("low")) / width).otherwise(1.0).alias("scaled")
    )
    # Queries without a vector are ranked by their text alone.
    text_only = scaled.join(queries.filter(F.col("embedding").isNotNull()), "query_id", "left_anti")
    text_only = text_only.select("query_id", "id", F.round(text_weight * F.col("scaled"), SCORE_DECIMALS).alias("score"))
    if len(bounded[0]) == 0:
        fused = text_only
    else:
        fused = _fuse_scores(vectors, scaled, *bounded, k, text_weight, vector_weight).unionByName(text_only)
    return top_k_per_group(fused, ["query_id"], [F.desc("score"), F.col("id")], k)


def _fuse_scores(
    vectors: DataFrame,
    scaled: DataFrame,
    query_ids: np.ndarray,
    matrix: np.ndarray,
    k: int,
    text_weight: float,
    vector_weight: float,
) -> DataFrame:
    """Best ``k`` rows per query and task, from scaled text scores and the vectors next to them."""
    position = {int(q): i for i, q in enumerate(query_ids)}
    rows = usable(vectors)
    # Rows handled at once, so that the score block stays small whatever the query count.
    step = max(1, 1_000_000 // len(matrix))

    def similarities(column) -> np.ndarray:
        block = to_matrix(column, matrix.shape[1])
        return 1 - np.stack([pair_distances(block, q[None, :], "cosine") for q in matrix], axis=1)

    def extremes(batches):
        low, high = np.full(len(matrix), np.inf), np.full(len(matrix), -np.inf)
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                scores = similarities(whole.column("embedding").slice(start, step))
                known = np.isfinite(scores)
                low = np.minimum(low, np.where(known, scores, np.inf).min(axis=0))
                high = np.maximum(high, np.where(known, scores, -np.inf).max(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(query_ids), pa.array(low), pa.array(high)], names=["query_id", "low", "high"]
        )

    # One row per query, and the query set is bounded.
    spans = rows.mapInArrow(extremes, "query_id long, low double, high double")
    spans = spans.groupBy("query_id").agg(F.min("low").alias("low"), F.max("high").alias("high")).toPandas()
    spans = spans.set_index("query_id").reindex(query_ids)
    low, high = spans["low"].to_numpy(), spans["high"].to_numpy()

    # At most one entry per query in a document's list.
    per_document = materialize(scaled.groupBy("id").agg(F.collect_list(F.struct("query_id", "scaled")).alias("texts")))
    # Small text results go to the vectors; the vectors are not shuffled for them.
    beside = rows.join(broadcast_if_small(per_document), "id", "left").select("id", "embedding", "texts")
    without = absent_from(per_document, rows, ["id"])
    none = F.lit(None).cast(rows.schema["embedding"].dataType)
    together = beside.unionByName(without.select("id", none.alias("embedding"), "texts"))
    def scores_of(batch) -> tuple[np.ndarray, np.ndarray]:
        """Fused score of every row and query, and which of them exist."""
        embedded = np.asarray(batch.column("embedding").is_valid())
        total = np.zeros((batch.num_rows, len(matrix)))
        valid = np.zeros(total.shape, bool)
        if embedded.any():
            scores = similarities(batch.column("embedding").drop_null())
            known = np.isfinite(scores)
            total[embedded] = vector_weight * np.where(known, min_max(scores, low, high), 0)
            valid[embedded] = known
        lists = batch.column("texts")
        entries = lists.flatten()
        if len(entries):
            row = np.repeat(np.arange(batch.num_rows), np.asarray(lists.value_lengths().fill_null(0)))
            query = np.array([position.get(int(q), -1) for q in np.asarray(entries.field("query_id"))])
            asked = query >= 0
            total[row[asked], query[asked]] += text_weight * np.asarray(entries.field("scaled"))[asked]
            valid[row[asked], query[asked]] = True
        return total, valid

    def fuse(batches):
        kept = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                ids = np.asarray(batch.column("id"), dtype=np.int64)
                total, valid = scores_of(batch)
                cost = np.where(valid, -np.round(total, SCORE_DECIMALS), np.inf)
                last = min(k, len(ids)) - 1
                row, query = np.nonzero(valid & (cost <= np.partition(cost, last, axis=0)[last]))
                found = (query, ids[row], cost[row, query])
                kept = best_rows(*[np.concatenate(pair) for pair in zip(kept, found)], k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(query_ids[kept[0]]), pa.array(kept[1]), pa.array(-kept[2])], names=["query_id", "id", "score"]
        )

    return together.mapInArrow(fuse, "query_id long, id long, score double")
