"""The stored cell index: recall for what it reads, exactness of its plans, growth."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftgraph.operators import ann, cells, vector


def frame(spark, values, name="id", first=0):
    rows = [(i + first, [float(x) for x in v]) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"{name} long, embedding array<float>")


def as_rows(hits):
    return sorted((r.query_id, r.rank, r.id, round(r.distance, 9)) for r in hits.collect())


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(42)
    rows = frame(spark, rng.standard_normal((10_000, 16), dtype=np.float32)).repartition(8).cache()
    return rows, frame(spark, rng.standard_normal((50, 16), dtype=np.float32), "query_id").cache()


@pytest.fixture(scope="module")
def index(data, tmp_path_factory):
    return cells.build_index(data[0], str(tmp_path_factory.mktemp("cells") / "index"), "euclidean")


@pytest.fixture(scope="module")
def exact(data):
    return vector.knn(*data, 10, "l2").cache()


@pytest.mark.parametrize("share, bar", [(0.08, 0.95), (0.12, 0.98), (0.15, 0.99)])
def test_recall_for_the_share_read(data, index, exact, share, bar):
    recall = ann.recall_at_k(exact, index.search(data[1], 10, share))
    assert recall.agg(F.avg("recall")).first()[0] >= bar


def test_files_of_other_groups_are_not_read(data, index):
    plan = index.search(data[1].limit(1), 10, nprobe=3)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "grp" in scan.split("PartitionFilters: [")[1].split("]")[0] and "In(cell" in scan
    assert index.cells.agg(F.sum("size")).first()[0] == 10_000 == index.vectors().count()


def test_exact_and_shuffled_plans(data, index, exact):
    assert as_rows(index.search(data[1], 10, exact=True)) == as_rows(exact)
    assert as_rows(index.search(data[1], 10, nprobe=10**6)) == as_rows(exact)
    assert as_rows(index.search(data[1], 10, 0.1, max_broadcast_values=0)) == as_rows(index.search(data[1], 10, 0.1))
    assert as_rows(index.search(data[1], 10, exact=True, max_broadcast_values=0)) == as_rows(exact)


def test_pairs_beyond_the_bound_are_shuffled(data, index, monkeypatch):
    want = as_rows(index.search(data[1], 5, 0.05))
    monkeypatch.setattr(cells, "BROADCAST_PAIRS", 10)
    monkeypatch.setattr(cells, "BLOCK_QUERIES", 7)
    monkeypatch.setattr(cells, "BLOCK_ROWS", 3)
    assert as_rows(index.search(data[1], 5, 0.05)) == want


def test_growing_equals_building_at_once(spark, data, exact, tmp_path):
    rows, queries = data
    small = cells.build_index(rows.filter("id < 6000"), str(tmp_path / "index"), "l2")
    batches = rows.filter("id >= 6000").select("embedding", F.col("id").alias("o"), (F.col("id") >= 8000).cast("int").alias("batch"))
    grown, ranges = small.append(batches, ["o"])
    assert sorted(tuple(r) for r in ranges.collect()) == [(0, 6000, 8000), (1, 8000, 10_000)]
    assert as_rows(grown.search(queries, 10, nprobe=10**6)) == as_rows(exact) == as_rows(grown.search(queries, 10, exact=True))
    assert ann.recall_at_k(exact, grown.search(queries, 10, 0.15)).agg(F.avg("recall")).first()[0] >= 0.95
    # The earlier version still answers as before, and can no longer grow.
    assert small.vectors().count() == 6000 and cells.open_index(spark, grown.path, "l2").version == grown.version
    with pytest.raises(ValueError):
        small.add(rows.limit(1))


def test_overfull_cells_are_split(spark, data, tmp_path):
    rng = np.random.default_rng(1)
    small = cells.build_index(data[0].filter("id < 2000"), str(tmp_path / "index"), "l2")
    near = rng.standard_normal((1, 16)) + 0.05 * rng.standard_normal((3000, 16))
    grown = small.add(frame(spark, near, first=50_000))
    assert grown.vectors().count() == 5000 == grown.vectors().select("id").distinct().count()
    sizes = [r["size"] for r in grown.cells.collect()]
    assert sum(sizes) == 5000 and max(sizes) < 500
    asked = frame(spark, near[:20], "query_id")
    want = as_rows(vector.knn(grown.vectors().select("id", "embedding"), asked, 10, "l2"))
    assert as_rows(grown.search(asked, 10, exact=True)) == want
    # Equal vectors cannot be split; the group is not written anew for them.
    same = grown.add(frame(spark, np.tile(near[:1], (2000, 1)), first=90_000))
    assert same.version <= grown.version + 2 and same.vectors().count() == 7000
    hits = same.search(frame(spark, near[:1], "query_id"), 5, nprobe=1).collect()
    assert [h.id for h in sorted(hits, key=lambda h: h.rank)][0] == 50_000


def test_small_and_empty_indexes(spark, tmp_path):
    one = cells.build_index(frame(spark, np.eye(4)), str(tmp_path / "eye"), "cosine")
    assert as_rows(one.search(frame(spark, [[1, 0, 0, 0]], "query_id"), 9, nprobe=99))[0][2] == 0
    assert one.search(frame(spark, np.ones((0, 4)), "query_id"), 3).count() == 0
    nothing = cells.build_index(frame(spark, np.ones((0, 4))), str(tmp_path / "none"), "cosine")
    assert nothing.search(frame(spark, [[1, 0, 0, 0]], "query_id"), 3).count() == 0
    with pytest.raises(ValueError):
        one.search(frame(spark, [[1, 0, 0, 0]], "query_id"), 3, nprobe=0)
    with pytest.raises(ValueError):
        cells.build_index(frame(spark, np.eye(4)), str(tmp_path / "dot"), "dot").search(frame(spark, np.eye(4), "query_id"), 3, exact=True)


def test_many_pairs_are_neither_listed_nor_shuffled(data, index, exact, monkeypatch):
    """Beyond the bound no query is sent to single cells: with many queries that is nearly every query to every cell."""
    want = as_rows(index.search(data[1], 5, 0.05))
    monkeypatch.setattr(cells, "BROADCAST_PAIRS", 10)
    for name in ("_scan", "_shuffled"):
        monkeypatch.setattr(cells.StoredCells, name, lambda *a, **k: pytest.fail("pairs are listed"))
    assert as_rows(index.search(data[1], 5, 0.05)) == want
    assert as_rows(index.search(data[1], 10, share=1.0)) == as_rows(index.search(data[1], 10, exact=True)) == as_rows(exact)


def test_queries_that_come_twice_beyond_the_bound(spark, data, index, monkeypatch):
    asked = data[1].limit(20)
    want = as_rows(index.search(asked.unionByName(asked), 5, 0.05))
    monkeypatch.setattr(cells, "BROADCAST_PAIRS", 10)
    assert as_rows(index.search(asked.unionByName(asked), 5, 0.05)) == want
