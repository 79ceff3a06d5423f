"""Hybrid ranking against a full ranking in Python."""

from __future__ import annotations

import numpy as np
import pytest

from weftgraph.operators import hybrid


@pytest.fixture(scope="module")
def lists(spark):
    """Three queries, 400 documents; text scores with many ties for about half of them."""
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((400, 6)).astype(np.float32)
    queries = rng.standard_normal((3, 6)).astype(np.float32)
    hits = [(q, i, float(rng.integers(1, 40)) / 8) for q in range(4) for i in range(500) if rng.random() < 0.5]
    return vectors, queries, hits


def frames(spark, lists):
    vectors, queries, hits = lists
    return (
        spark.createDataFrame(hits, "query_id long, id long, score double"),
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, embedding array<float>"),
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query_id long, embedding array<float>"),
    )


def cosine(vectors, q):
    v = vectors.astype(float)
    return 1 - (v @ q.astype(float)) / (np.linalg.norm(v, axis=1) * np.linalg.norm(q.astype(float)))


def expected_rrf(lists, k):
    vectors, queries, hits = lists
    best = {}
    for q in range(4):
        text = sorted((-s, i) for p, i, s in hits if p == q)
        score = {i: 1 / (60 + r) for r, (_, i) in enumerate(text, 1)}
        if q < len(queries):
            for r, (_, i) in enumerate(sorted((d, i) for i, d in enumerate(cosine(vectors, queries[q]))), 1):
                score[i] = score.get(i, 0) + 1 / (60 + r)
        best[q] = [i for _, i in sorted((-round(s, 12), i) for i, s in score.items())[:k]]
    return best


def as_dict(found):
    out: dict[int, list[int]] = {}
    for row in found.orderBy("query_id", "rank").collect():
        out.setdefault(row.query_id, []).append(row.id)
    return out


@pytest.mark.parametrize("k, bound", [(10, hybrid.BROADCAST_VALUES), (3, 12)])
def test_rrf_equals_a_full_ranking(spark, lists, k, bound):
    found = hybrid.rrf_search(*frames(spark, lists), k, max_broadcast_values=bound)
    assert as_dict(found) == expected_rrf(lists, k)


@pytest.mark.parametrize("bound", [hybrid.BROADCAST_VALUES, 12])
def test_weighted_equals_a_full_ranking(spark, lists, bound):
    vectors, queries, hits = lists
    found = hybrid.weighted_search(*frames(spark, lists), 8, 0.3, 0.7, max_broadcast_values=bound)
    for q, got in as_dict(found).items():
        text = {i: s for p, i, s in hits if p == q}
        low, high = min(text.values()), max(text.values())
        score = {i: 0.3 * (s - low) / (high - low) for i, s in text.items()}
        if q < len(queries):
            near = 1 - cosine(vectors, queries[q])
            for i, s in enumerate(near):
                score[i] = score.get(i, 0) + 0.7 * (s - near.min()) / (near.max() - near.min())
        assert got == [i for _, i in sorted((-round(s, 9), i) for i, s in score.items())[:8]]


def test_graph_and_vector(spark):
    """Reached nodes only, nearest first; no vector, no hit; the start itself is left out."""
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (1, 4)], "src long, dst long")
    vectors = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.1]), (9, [1.0, 0.0])], "id long, embedding array<float>"
    )
    starts = spark.createDataFrame([(1, [1.0, 0.0])], "id long, embedding array<float>")
    found = hybrid.hybrid_search(edges, starts, vectors, top_k=5)
    assert [(r.id, r.depth, r.rank) for r in found.orderBy("rank").collect()] == [(3, 2, 1), (2, 1, 2)]


def test_hits_stay_where_they_are_for_missing_places(spark, lists, monkeypatch):
    """A few rows per query go to all hits; a shuffle of these would grow with queries times documents."""
    plans, places = [], hybrid._places
    monkeypatch.setattr(hybrid, "_places", lambda rows: plans.append(rows._jdf.queryExecution().executedPlan().toString()) or places(rows))
    monkeypatch.setattr(hybrid, "broadcast_if_small", lambda df: df.hint("broadcast"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert as_dict(hybrid.rrf_search(*frames(spark, lists), 3)) == expected_rrf(lists, 3)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning" not in plans[0]
