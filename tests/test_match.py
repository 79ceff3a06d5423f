"""Matching and traversal on a small graph with a cycle, answers worked out by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weftgraph.operators import aggregate, filters, lookup, match, scan
from weftgraph.sources.graph import PropertyGraph

# 1 -> 2 -> 3 -> 1 is a cycle; 3 -> 4 leaves it; 5 stands alone.
LINKS = [(10, 1, 2), (11, 2, 3), (12, 3, 1), (13, 3, 4)]


@pytest.fixture(scope="module")
def graph(spark):
    towns = spark.createDataFrame([(i, f"town{i}", i % 2 == 0) for i in range(1, 6)], "id long, name string, port boolean")
    people = spark.createDataFrame([(6, "Ada"), (7, "Ben")], "id long, name string")
    roads = spark.createDataFrame(LINKS, "edge_id long, src long, dst long")
    lives = spark.createDataFrame([(20, 6, 1), (21, 7, 1)], "edge_id long, src long, dst long")
    return PropertyGraph({"Town": towns, "Person": people}, {"ROAD": roads, "LIVES_IN": lives})


def starts(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id long")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_scans(graph):
    assert graph.labels == ["Person", "Town"]
    assert graph.all_nodes().filter("port IS NULL").count() == 2
    assert rows(graph.links("LIVES_IN").select("src", "type")) == [(6, "LIVES_IN"), (7, "LIVES_IN")]
    assert graph.edges().count() == 6


def test_one_hop(graph):
    hit = match.one_hop(graph.nodes("Person"), graph.edges("LIVES_IN"), filters.where_equal(graph.nodes("Town"), {"name": "town1"}))
    assert rows(hit.select("a_name")) == [("Ada",), ("Ben",)]


def test_edge_is_not_used_twice(spark):
    loop = spark.createDataFrame([(1, 1, 1), (2, 1, 1)], "edge_id long, src long, dst long")
    # Two loops on one node: each may follow the other, none itself.
    assert match.two_hops(loop, loop, same_type=True).count() == 2
    found = match.paths(loop, starts(spark, 1), 1, 3)
    assert rows(found.groupBy("hops").count()) == [(1, 2), (2, 2)]


def test_edges_by_ends_are_not_used_twice(spark):
    """The path alone tells which pairs were used; reversed pairs that keep their key are still one edge."""
    links = spark.createDataFrame([(1, 2), (2, 1), (2, 3), (3, 2), (2, 2)], "src long, dst long")
    edges = match.edges_by_ends(links)
    numbered = links.withColumn("edge_id", F.xxhash64("src", "dst"))
    found = match.paths(edges, starts(spark, 1, 2), 1, 5)
    assert rows(found) == rows(match.paths(numbered, starts(spark, 1, 2), 1, 5)) != []
    assert match._written_steps(edges.selectExpr("src AS end", "dst AS __next", "edge_id AS __edge"))[1].columns == ["end", "__next"]
    one = match.edges_by_ends(spark.createDataFrame([(1, 2)], "src long, dst long"))
    both_ways = one.unionByName(one.selectExpr("dst AS src", "src AS dst", "edge_id"))
    assert rows(match.paths(both_ways, starts(spark, 1), 1, 3).select("path")) == [([1, 2],)]


def test_paths_go_round_a_cycle_once(spark, graph):
    found = match.paths(graph.edges("ROAD"), starts(spark, 1), 2, 4)
    assert rows(found.select("end", "hops")) == [(1, 3), (3, 2), (4, 3)]
    assert rows(found.filter("hops = 2").select("path")) == [([1, 2, 3],)]


@pytest.mark.parametrize(
    "direction, depth, expected",
    [
        ("outbound", 1, [(1, 2, 1)]),
        ("OUTBOUND", 5, [(1, 2, 1), (1, 3, 2), (1, 4, 3)]),
        ("inbound", 2, [(1, 2, 2), (1, 3, 1)]),
        ("both", 2, [(1, 2, 1), (1, 3, 1), (1, 4, 2)]),
    ],
)
def test_traverse(spark, graph, direction, depth, expected):
    nodes, _ = match.traverse(graph.edges("ROAD"), starts(spark, 1), direction, depth)
    assert rows(nodes.select("start", "id", "depth")) == expected


def test_traversed_edges(spark, graph):
    _, edges = match.traverse(graph.edges("ROAD"), starts(spark, 1), "outbound", 2)
    assert rows(edges) == [(1, 1, 2), (1, 2, 3)]


def test_depth_is_the_shortest_path(spark, small):
    from weftgraph.sources.tables import table_graph

    edges = match.edges_by_ends(table_graph(spark, small).edges("BOUGHT_WITH"))
    begin = edges.select(F.col("src").alias("id")).distinct()
    nodes, _ = match.traverse(edges, begin, "outbound", 3)
    shortest = match.paths(edges, begin, 1, 3).groupBy("start", F.col("end").alias("id")).agg(F.min("hops").alias("depth"))
    assert rows(nodes) == rows(shortest) != []


def test_edges_without_ids_have_no_paths(spark):
    edges = spark.createDataFrame([(1, 2)], "src long, dst long")
    with pytest.raises(ValueError, match="edge_id"):
        match.paths(edges, starts(spark, 1))
    with pytest.raises(ValueError, match="edge_id"):
        match.two_hops(edges, edges, same_type=True)


def test_start_without_edges(spark, graph):
    nodes, edges = match.traverse(graph.edges("ROAD"), starts(spark, 5), "outbound", 3)
    assert nodes.count() == 0 and edges.count() == 0


@pytest.mark.parametrize("direction", [None, "sideways", 3])
def test_bad_direction(spark, graph, direction):
    with pytest.raises(ValueError):
        match.traverse(graph.edges("ROAD"), starts(spark, 1), direction, 1)


@pytest.mark.parametrize("depth", [0, -1, "2", True, 1.5])
def test_bad_depth(spark, graph, depth):
    with pytest.raises(ValueError):
        match.traverse(graph.edges("ROAD"), starts(spark, 1), "outbound", depth)


def test_reachable_clamps_depth_and_limits(spark, graph):
    def reach(depth, **how):
        return rows(match.reachable(graph.links(), starts(spark, 6), depth=depth, **how))

    assert reach(9, least=1, most=3) == [(6, 1), (6, 2), (6, 3)]
    assert reach(0, least=1, most=3) == [(6, 1)]
    assert reach(9) == [(6, 1), (6, 2), (6, 3), (6, 4)]
    assert reach(3, limit=2) == [(6, 1), (6, 2)]
    with pytest.raises(ValueError):
        reach(0)


def test_reachable_inside_a_scope(spark, graph):
    inside = starts(spark, 1, 2, 4, 6)
    # 3 is outside, so neither it nor 4 behind it is reached, and the outside start 7 reaches nothing.
    assert rows(match.reachable(graph.links(), starts(spark, 6, 7), depth=4, scope=inside)) == [(6, 1), (6, 2)]


def test_undirected(graph):
    assert match.undirected(graph.links("ROAD")).count() == 2 * len(LINKS)


def test_triplets(graph):
    names = graph.all_nodes().select("id", "name")
    found = match.triplets(graph.links(), names, entity_names=["Ada", "town4"])
    assert rows(found.select("src_name", "rel", "dst_name")) == [("Ada", "LIVES_IN", "town1"), ("town3", "ROAD", "town4")]
    assert match.triplets(graph.links(), names, entity_names=[], relation_names=[]).count() == 6
    assert match.triplets(graph.links(), names, relation_names=["ROAD"], limit=3).count() == 3
    with pytest.raises(NotImplementedError):
        match.triplets(graph.links(), names, properties={"a": 1})
    with pytest.raises(NotImplementedError):
        match.triplets(graph.links(), names, ids=["x"])


def test_relation_map(spark, graph):
    asked = starts(spark, 3, 6)
    assert match.relation_map(graph.links(), asked).count() == 3
    # The ignored type does not use up the limit.
    kept = match.relation_map(graph.links(), asked, limit=1, ignore_rels=["ROAD"])
    assert rows(kept) == [(6, "LIVES_IN", 1)]
    assert match.relation_map(graph.links(), asked, limit=1, per_node=True).count() == 2
    assert match.relation_map(graph.links(), starts(spark)).count() == 0
    with pytest.raises(NotImplementedError):
        match.relation_map(graph.links(), asked, depth=2)


def test_relationship_triples(graph):
    found = match.relationship_triples(graph.links(), graph.all_nodes())
    assert rows(found) == [("Person", "LIVES_IN", "Town"), ("Town", "ROAD", "Town")]


def test_stable_label(spark):
    data = spark.createDataFrame([(1, ["b", "a"]), (2, [])], "id int, labels array<string>")
    assert rows(data.select("id", filters.stable_label("labels"))) == [(1, "a"), (2, None)]


def test_long_membership_lists_become_joins(graph):
    towns = graph.nodes("Town")
    many = [f"town{i}" for i in range(2, 2000)]
    assert rows(filters.where_in(towns, "name", many).select("id")) == [(2,), (3,), (4,), (5,)]
    assert rows(filters.where_in(towns, "name", many, negate=True).select("id")) == [(1,)]


def test_get_nodes(graph):
    towns = graph.nodes("Town")
    assert lookup.get_nodes(towns).count() == 0
    assert rows(lookup.get_nodes(towns, {"port": True}, ["town1"]).select("id")) == [(1,)]
    assert lookup.get_nodes(towns, {"port": True}, limit=1).count() == 1


def test_create_nodes_and_edges(spark, graph):
    new = spark.createDataFrame([("x",), ("y",)], "name string")
    made = scan.create_nodes(graph.nodes("Person"), new, ["name"])
    assert rows(made.select("id", "name")) == [(8, "x"), (9, "y")]
    first = scan.create_nodes(graph.nodes("Person").filter("false"), new, ["name"])
    assert rows(first.select("id")) == [(1,), (2,)]
    asked = spark.createDataFrame([(1, 2), (1, 2), (1, 99)], "src long, dst long")
    edges = scan.create_edges(graph.nodes("Town"), graph.nodes("Town"), asked, ["src", "dst"], graph.edges("ROAD"))
    # Two requests for one pair stay two parallel edges; the unknown end is dropped.
    assert rows(edges.select("edge_id", "src", "dst")) == [(14, 1, 2), (15, 1, 2)]


def test_facts_sink(spark, graph, tmp_path):
    found = scan.facts(graph.links(), graph.all_nodes().select("id", "name"))
    scan.write_facts(found, str(tmp_path / "facts"))
    back = spark.read.parquet(str(tmp_path / "facts"))
    assert rows(back.select("subject", "relation", "object")) == rows(found)


def test_count_by_type(graph):
    assert [tuple(r) for r in aggregate.count_by_type(graph.links()).collect()] == [("ROAD", 4), ("LIVES_IN", 2)]


@pytest.mark.parametrize("bound", [match.BROADCAST_ROWS, 0])
def test_hub_with_most_edges_on_both_join_plans(spark, monkeypatch, bound):
    monkeypatch.setattr(match, "BROADCAST_ROWS", bound)
    leaves = 3000
    edges = spark.range(1, leaves + 1).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"))
    tail = spark.createDataFrame([(leaves, leaves + 1)], "src long, dst long")
    edges = match.edges_by_ends(edges.unionByName(tail))
    nodes, walked = match.traverse(edges, starts(spark, 1), "both", 3)
    counts = dict(rows(nodes.groupBy("depth").count()))
    assert counts == {1: 1, 2: leaves - 1, 3: 1}
    assert walked.count() == leaves + 1
    found = match.paths(edges, starts(spark, 0), 1, 2)
    assert dict(rows(found.groupBy("hops").count())) == {1: leaves, 2: 1}


def test_many_starts_share_words_of_bits(spark):
    """More starts than a word has bits, in a chain with a cycle: every start by itself gives the same rows."""
    n = 150
    links = [(i, i + 1) for i in range(n)] + [(n, 0), (5, 90), (90, 5), (7, 7)]
    edges = spark.createDataFrame(links, "src long, dst long")
    nodes, walked = match.traverse(edges, starts(spark, *range(n), 0, 999), "outbound", 4)
    step = {}
    for a, b in links:
        step.setdefault(a, set()).add(b)
    want, seen_edges = set(), set()
    for start in [*range(n), 999]:
        depth, now = {start: 0}, [start]
        for d in range(1, 5):
            seen_edges |= {(start, a, b) for a in now for b in step.get(a, ())}
            now = sorted({b for a in now for b in step.get(a, ())} - set(depth))
            depth |= {b: d for b in now}
        want |= {(start, i, d) for i, d in depth.items() if d}
    assert set(rows(nodes)) == want and len(rows(nodes)) == len(want)
    assert set(rows(walked)) == seen_edges and walked.count() == len(seen_edges)


@pytest.mark.parametrize("direction", ["outbound", "inbound", "both"])
def test_stored_edges_are_not_moved(spark, graph, tmp_path, monkeypatch, direction):
    edges = spark.range(0, 3000).selectExpr("id % 50 AS src", "(id * 7) % 60 AS dst")
    stored = match.StoredEdges(edges, str(tmp_path / "edges"), 4)
    begin = starts(spark, *range(20))
    want = match.traverse(edges, begin, direction, 3)
    got = match.traverse(stored, begin, direction, 3)
    assert rows(got[0]) == rows(want[0]) and rows(got[1].distinct()) == rows(want[1].distinct())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        frontier = spark.createDataFrame([(1, 0, 1)], "id long, word long, fresh long")
        for step in stored.steps(direction):
            plan = match._walk(frontier, [step])._jdf.queryExecution().executedPlan().toString()
            scan = next(i for i, line in enumerate(plan.splitlines()) if "weftgraph_edges" in line)
            above = [line for line in plan.splitlines()[:scan] if line.strip(" :+-*()0123456789").startswith("Exchange")]
            assert len(above) <= 1 and "SortMergeJoin" in plan  # the frontier's own exchange
            assert plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_edges_met_from_either_end_move_once(spark, tmp_path):
    """Parallel edges, loops and edges between inner nodes come once for each start, and no row is grouped to see to that."""
    links = [(1, 2), (1, 2), (2, 1), (2, 3), (3, 3), (3, 1), (4, 3), (5, 6)]
    edges = spark.createDataFrame(links, "src long, dst long")
    for given in (edges, match.StoredEdges(edges, str(tmp_path / "parallel"), 2)):
        walked = match.traverse(given, starts(spark, 1, 4, 6), "both", 2)[1]
        inner = {1: {1, 2, 3}, 4: {4, 3}, 6: {6, 5}}
        assert rows(walked) == sorted({(s, a, b) for s, near in inner.items() for a, b in links if {a, b} & near})
    written = match.traverse(edges, starts(spark, 1), "both", 2)[1]
    assert "Aggregate" not in written._jdf.queryExecution().optimizedPlan().toString()


def test_full_nodes(spark, graph):
    reached, _ = match.traverse(graph.edges("ROAD"), starts(spark, 1), "outbound", 2)
    assert rows(match.with_nodes(reached, graph.nodes("Town")).select("start", "depth", "name")) == [(1, 1, "town2"), (1, 2, "town3")]


def test_counts_of_pairs_equal_the_pairs(spark):
    edges = spark.createDataFrame(
        [(1, 1, 5), (2, 1, 5), (3, 2, 5), (4, 5, 5), (5, 5, 6), (6, 6, 7), (7, 8, 9)], "edge_id long, src long, dst long"
    )
    for same in (True, False):
        pairs = match.two_hops(edges, edges, same_type=same).groupBy("b").count()
        assert rows(match.pair_counts(edges, edges, same_type=same)) == rows(pairs)


def test_every_pair_of_an_order_is_linked(spark):
    from weftgraph.sources.tables import bought_together, node_id

    lines = spark.createDataFrame(
        [(1, 3), (1, 5), (1, 9), (1, 5), (2, 5), (2, 9), (3, 7), (None, 1), (None, 2), (4, None), (4, 8)], "l_orderkey long, l_partkey long"
    )
    part = lambda c: F.col(c) - node_id("Part", F.lit(0))
    assert rows(bought_together(lines).select(part("src"), part("dst"))) == [(3, 5), (3, 9), (5, 9)]


def test_traversed_edges_include_pairs_without_the_smallest_part(spark, tmp_path):
    from weftgraph.catalog import all_oracles, all_queries
    from weftgraph.sources.tables import node_id

    spark.createDataFrame([(1, 3), (1, 5), (1, 9)], "l_orderkey long, l_partkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame(
        [(i, "PROMO" if i == 9 else "SMALL") for i in (3, 5, 9)], "p_partkey long, p_type string"
    ).withColumns({c: F.lit("x") for c in ("p_name", "p_brand")}).withColumns({"p_size": F.lit(1), "p_retailprice": F.lit(1.0)}).write.parquet(
        str(tmp_path / "part.parquet")
    )
    part = lambda c: F.col(c) - node_id("Part", F.lit(0))
    found = all_queries()["j5_traverse_both_edges"](spark, str(tmp_path))
    assert rows(found.select(part("start"), part("src"), part("dst"))) == [(9, 3, 5), (9, 3, 9), (9, 5, 9)]
    assert "bought_anchor" not in all_oracles()["j5_traverse_both_edges"]
