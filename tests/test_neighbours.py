"""The stored neighbour graph: links near the exact ones, recall by beam width, bounded blocks."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftgraph.operators import ann, neighbours, vector


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
def graph(data, tmp_path_factory):
    return neighbours.build_graph(data[0], str(tmp_path_factory.mktemp("graph") / "index"), "euclidean")


@pytest.mark.parametrize("ef, bar", [(50, 0.95), (100, 0.98), (200, 0.99)])
def test_recall_by_beam_width(data, graph, ef, bar):
    exact = vector.knn(*data, 10, "l2")
    hits = graph.search(data[1], 10, ef).cache()
    assert ann.recall_at_k(exact, hits).agg(F.avg("recall")).first()[0] >= bar
    # What is found has its exact distance, in order, each vector once.
    both = hits.join(vector.knn(*data, 10, "l2").withColumnRenamed("distance", "d").drop("rank"), ["query_id", "id"])
    assert both.filter("abs(distance - d) > 1e-9").count() == 0
    assert hits.select("query_id", "id").distinct().count() == hits.count() == 500


def test_links_are_the_exact_neighbours(data, graph):
    """Brute force over a sample of the vectors: nearly all of the sixteen nearest are linked."""
    asked = data[0].filter("id % 100 = 0").withColumnRenamed("id", "query_id")
    exact = vector.knn(data[0], asked, 17, "l2").filter("query_id <> id")
    linked = graph.links().select(F.col("src").alias("query_id"), F.col("dst").alias("id"))
    assert ann.recall_at_k(exact, linked).agg(F.avg("recall")).first()[0] >= 0.97
    sizes = graph.nodes.agg(F.max(F.size("links")).alias("most"), F.min(F.size("links")).alias("least"), F.count("*").alias("n")).first()
    assert sizes.most <= 2 * neighbours.LINKS and sizes.least >= neighbours.LINKS and sizes.n == 10_000
    assert graph.links().filter("src = dst").count() == 0


def test_a_round_names_folders_and_cells(spark, data, graph):
    wanted = spark.createDataFrame([(0, 5)], "query_id long, cell int")
    plan = graph._named(wanted)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "grp" in scan.split("PartitionFilters: [")[1].split("]")[0] and "cell" in scan.split("PushedFilters: [")[1]


def test_equal_vectors_and_small_blocks(spark, tmp_path, monkeypatch):
    """A third of all rows are one vector; blocks and visitors far below their number."""
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    monkeypatch.setattr(neighbours, "VISITORS", 40)
    rng = np.random.default_rng(3)
    values = rng.standard_normal((600, 8)).astype(np.float32)
    values[:200] = values[0]
    rows = frame(spark, values)
    graph = neighbours.build_graph(rows, str(tmp_path / "copies"), "l2")
    asked = frame(spark, np.r_[values[:1], values[400:410]], "query_id")
    exact = vector.knn(rows, asked, 5, "l2")
    assert ann.recall_at_k(exact.filter("query_id > 0"), graph.search(asked, 5, 64)).agg(F.avg("recall")).first()[0] >= 0.95
    # Of equal vectors any may be found, all at distance zero.
    same = graph.search(asked, 5, 64).filter("query_id = 0").collect()
    assert len(same) == 5 and all(r.distance == 0 and r.id < 200 for r in same)


def test_queries_joined_when_many(data, graph, monkeypatch):
    want = as_rows(graph.search(data[1], 5, 20))
    monkeypatch.setattr(neighbours, "broadcast_if_small", lambda df: df)
    monkeypatch.setattr(neighbours, "NAMED_CELLS", 3)
    assert as_rows(graph.search(data[1], 5, 20)) == want


def test_small_empty_and_odd_inputs(spark, tmp_path):
    eye = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, [0.0, 0.0])], "id long, embedding array<float>")
    graph = neighbours.build_graph(eye, str(tmp_path / "eye"), "cosine")
    asked = spark.createDataFrame([(7, [1.0, 0.1]), (8, None)], "query_id long, embedding array<float>")
    assert [(q, r, i) for q, r, i, _ in as_rows(graph.search(asked, 9))] == [(7, 1, 0), (7, 2, 1)]
    assert graph.search(asked.filter("query_id = 8"), 3).count() == 0
    one = neighbours.build_graph(eye.filter("id = 1"), str(tmp_path / "one"), "l2")
    assert [i for _, _, i, _ in as_rows(one.search(asked, 3))] == [1]
    none = neighbours.build_graph(eye.filter("id = 2"), str(tmp_path / "none"), "l2")
    assert none.search(asked, 3).count() == 0 and none.nodes.count() == 0
    for wrong in ({"k": 0}, {"ef": 0}):
        with pytest.raises(ValueError):
            graph.search(asked, **wrong)
    with pytest.raises(ValueError):
        neighbours.build_graph(eye, str(tmp_path / "dot"), "dot")


def near(values, keep, pairs):
    """The ``keep`` nearest of ``pairs`` (src, dst) by squared distance, then id."""
    best = {}
    for a, b in pairs:
        best.setdefault(a, []).append((((values[a] - values[b]) ** 2).sum(), b))
    return {(a, b) for a, found in best.items() for _, b in sorted(found)[:keep]}


def test_a_round_leaves_out_no_pair(spark):
    """Rounds against all pairs of every group, though pairs that have met are not compared again."""
    rng, keep = np.random.default_rng(5), 4
    values = rng.standard_normal((150, 6))
    links = {(a, int(b)) for a in range(150) for b in rng.choice([x for x in range(150) if x != a], keep, replace=False)}
    vectors = spark.createDataFrame([(i, v.tolist(), i // 50) for i, v in enumerate(values)], "id long, embedding array<double>, block int")
    rows = [(a, b, float(((values[a] - values[b]) ** 2).sum()), True) for a, b in links]
    stored, before = spark.createDataFrame(rows, "src long, dst long, gap double, fresh boolean"), None
    for _ in range(4):
        stored, before = neighbours._improved(vectors, 3, stored, False, keep, before)
        back = {(b, a) for a, b in near(values, keep, {(b, a) for a, b in links})}
        groups = {v: {v} | {b for a, b in links if a == v} | {a for a, b in back if b == v} for v in range(150)}
        links = near(values, keep, links | {(a, b) for group in groups.values() for a in group for b in group if a != b})
        assert {(r.src, r.dst) for r in stored.collect()} == links


def test_a_vector_goes_to_a_block_once(spark, tmp_path, monkeypatch):
    """What a round moves are at most so many copies of a vector as there are blocks, not one for each group it is in."""
    rows = frame(spark, np.random.default_rng(7).standard_normal((600, 8)).astype(np.float32))
    moved, kind = [], type(rows)
    plain = kind.mapInArrow

    def seen(df, func, schema, *more, **named):
        if "reach" in df.columns:
            moved.append(df.filter("embedding is not null"))
        return plain(df, func, schema, *more, **named)

    monkeypatch.setattr(kind, "mapInArrow", seen)
    monkeypatch.setattr(neighbours, "BLOCKS", 3, raising=False)
    neighbours.build_graph(rows, str(tmp_path / "moved"), "l2", rounds=2)
    assert len(moved) >= 1 and all(df.count() <= 3 * 600 for df in moved)


def test_blocks_are_even(spark, monkeypatch):
    """A cell with most rows is dealt among blocks; a vector of many numbers makes more of them."""
    cells = [0] * 900 + [1] * 50 + [2**20 + 3] * 250
    placed = spark.createDataFrame([(i, [1.0], c, c // 2**20) for i, c in enumerate(cells)], "id long, embedding array<float>, cell int, grp int")
    monkeypatch.setattr(neighbours, "BLOCKS", 4)
    rows, blocks = neighbours._in_blocks(placed, 1)
    sizes = {r.block: r["count"] for r in rows.groupBy("block").count().collect()}
    assert blocks == 4 and set(sizes) == {0, 1, 2, 3} and sum(sizes.values()) == 1200 and max(sizes.values()) <= 400
    monkeypatch.setattr(neighbours, "BLOCK_VALUES", 100 * 64)
    assert neighbours._in_blocks(placed, 64)[1] == 12


def test_a_beam_is_what_a_walk_with_a_list_of_all_seen_finds(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(11)
    values, asked = rng.standard_normal((500, 8)), rng.standard_normal((6, 8))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(values)], "id long, embedding array<double>")
    graph = neighbours.build_graph(rows, str(tmp_path / "walk"), "l2", links=4, rounds=2)
    kept, plain = [], neighbours.materialize

    def keep(df):
        kept.append(df.columns)
        return plain(df)

    monkeypatch.setattr(neighbours, "materialize", keep)
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "query_id long, embedding array<double>")
    nodes = {r.id: r for r in graph.nodes.collect()}
    centres = neighbours._read_centres(graph.cells.cells, False)
    for ef in (5, 40):
        found = {(r.query_id, r["rank"]): r.id for r in graph.search(queries, 5, ef).collect()}
        for q, point in enumerate(asked):
            first = set(centres.cells[neighbours.near_cells(centres, point[None], neighbours.ENTRY_CELLS)[0]])
            new = {i for i, r in nodes.items() if r.cell in first}
            beam, seen = [], set()
            while new:
                seen |= new
                beam = sorted(beam + [(round(float(np.sqrt(((values[i] - point) ** 2).sum())), 12), i) for i in new])[:ef]
                new = {link.id for _, i in beam if i in new for link in nodes[i].links} - seen
            assert [found[q, r] for r in range(1, 6)] == [i for _, i in beam[:5]]
    # Links of rows that did not come into a beam are neither stored nor moved.
    assert kept and not any("links" in columns for columns in kept)
