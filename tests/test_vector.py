"""Distances, exact and approximate search, id ranges."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftgraph.functions.distance import check_metric, distance
from weftgraph.operators import ann, vector


def frame(spark, matrix, name="id", first=0):
    data = [(int(first + i), [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(data, f"{name} long, embedding array<float>")


def as_dict(hits):
    found: dict[int, list[int]] = {}
    for row in hits.orderBy("query_id", "rank").collect():
        found.setdefault(row.query_id, []).append(row.id)
    return found


def brute(matrix, query, metric):
    x, q = matrix.astype(float), query.astype(float)
    if metric == "l2":
        return np.sqrt(((x - q) ** 2).sum(axis=1))
    if metric == "l1":
        return np.abs(x - q).sum(axis=1)
    if metric == "dot":
        return -(x @ q)
    return 1 - (x @ q) / (np.linalg.norm(x, axis=1) * np.linalg.norm(q))


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    return rng.standard_normal((400, 12)).astype(np.float32), rng.standard_normal((9, 12)).astype(np.float32)


@pytest.mark.parametrize(
    "alias, name",
    [("Angular", "cosine"), ("euclidean", "l2"), ("ip", "dot"), ("inner_product", "dot"), ("dot_product", "dot"), ("manhattan", "l1")],
)
def test_metric_names(alias, name):
    assert check_metric(alias) == name


def test_unknown_metric(spark, data):
    with pytest.raises(ValueError):
        vector.knn(frame(spark, data[0]), frame(spark, data[1], "query_id"), 3, "bogus")


@pytest.mark.parametrize("metric", ["cosine", "l2", "dot", "l1"])
@pytest.mark.parametrize("bound", [vector.BROADCAST_VALUES, 0])
def test_knn_equals_brute_force_on_both_plans(spark, data, metric, bound, monkeypatch):
    monkeypatch.setattr(vector, "BLOCK_VECTORS", 100)
    monkeypatch.setattr(vector, "BLOCK_QUERIES", 4)
    rows, queries = data
    hits = vector.knn(frame(spark, rows), frame(spark, queries, "query_id"), 6, metric, max_broadcast_values=bound)
    found = as_dict(hits)
    for i, q in enumerate(queries):
        assert found[i] == np.argsort(brute(rows, q, metric), kind="stable")[:6].tolist()


def test_column_distance_equals_numpy(spark, data):
    rows, queries = data
    pairs = spark.createDataFrame(
        [(i, rows[i].tolist(), queries[0].tolist()) for i in range(20)], "i int, a array<float>, b array<float>"
    )
    for metric in ("cosine", "l2", "dot", "l1"):
        got = [r.d for r in pairs.select("i", distance("a", "b", metric).alias("d")).orderBy("i").collect()]
        assert np.allclose(got, brute(rows[:20], queries[0], metric))


def test_ties_zero_vectors_and_nulls(spark):
    rows = spark.createDataFrame(
        [(5, [1.0, 0.0]), (2, [1.0, 0.0]), (9, [2.0, 0.0]), (1, [0.0, 0.0]), (3, None), (4, [0.0, 1.0])],
        "id long, embedding array<float>",
    )
    query = spark.createDataFrame([(0, [1.0, 0.0])], "query_id long, embedding array<float>")
    assert as_dict(vector.knn(rows, query, 10)) == {0: [2, 5, 9, 4]}
    zero = spark.createDataFrame([(0, [0.0, 0.0])], "query_id long, embedding array<float>")
    assert vector.knn(rows, zero, 3).count() == 0


def test_single_vector_finds_itself(spark):
    values = [[i / 16 for i in range(1, 17)]]
    hit = vector.knn(frame(spark, values), frame(spark, values, "query_id"), 1).collect()
    assert [(h.id, round(h.distance, 9), h.rank) for h in hit] == [(0, 0.0, 1)]


def test_dimension_mismatch_and_empty_queries(spark):
    rows = frame(spark, np.zeros((3, 8)))
    with pytest.raises(Exception, match="dimension"):
        vector.knn(rows, frame(spark, np.ones((1, 7)), "query_id"), 3, "l2").collect()
    assert vector.knn(rows, frame(spark, np.ones((1, 8)), "query_id").filter("false"), 3).count() == 0
    with pytest.raises(ValueError):
        vector.knn(rows, rows.withColumnRenamed("id", "query_id"), 0)


def test_append_ranges(spark):
    batches = spark.createDataFrame([(0, i) for i in range(10)] + [(1, i) for i in range(5)], "batch int, n int")
    empty = spark.createDataFrame([], "id long")
    rows, ranges = vector.append_vectors(empty, batches, ["n"])
    assert sorted(tuple(r) for r in ranges.collect()) == [(0, 0, 10), (1, 10, 15)]
    assert tuple(vector.next_range(rows).first()) == (15, 15)
    assert tuple(vector.next_range(empty).first()) == (0, 0)
    more, again = vector.append_vectors(rows, batches.filter("batch = 1"), ["n"])
    assert sorted(tuple(r) for r in again.collect()) == [(1, 15, 20)]


@pytest.fixture(scope="module")
def gaussian(spark):
    rng = np.random.default_rng(42)
    rows = frame(spark, rng.standard_normal((10_000, 16), dtype=np.float32)).repartition(8)
    return rows.cache(), frame(spark, rng.standard_normal((50, 16), dtype=np.float32), "query_id").cache()


@pytest.fixture(scope="module")
def cells(gaussian):
    return ann.build_cells(gaussian[0], 100, "euclidean")


@pytest.mark.parametrize("nprobe, bar", [(30, 0.95), (45, 0.98), (60, 0.99)])
def test_recall_rises_with_the_cells_read(gaussian, cells, nprobe, bar):
    exact = vector.knn(*gaussian, 10, "l2")
    recall = ann.recall_at_k(exact, ann.ann_search(cells, gaussian[1], 10, nprobe))
    assert recall.agg(F.avg("recall")).first()[0] >= bar


def test_stored_cells_and_shuffled_queries_agree(gaussian, cells, tmp_path):
    expected = as_dict(ann.ann_search(cells, gaussian[1], 5, 10))
    stored = cells.write(str(tmp_path / "cells"))
    assert as_dict(ann.ann_search(stored, gaussian[1], 5, 10)) == expected
    assert as_dict(ann.ann_search(cells, gaussian[1], 5, 10, max_broadcast_values=0)) == expected


def test_identity_and_short_index(spark):
    rows = frame(spark, np.eye(4))
    index = ann.build_cells(rows, 2, "l2")
    hits = ann.ann_search(index, frame(spark, [[1, 0, 0, 0]], "query_id"), 9, nprobe=2)
    assert as_dict(hits)[0][0] == 0 and hits.count() == 4
