"""Traversal keeps its largest round off the disk and spells out bits in compiled code."""

from __future__ import annotations

import glob

from weftgraph.operators import match


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_last_round_is_not_written_and_bits_are_compiled(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)], "src long, dst long")
    starts = spark.range(70)
    match.materialize(spark.range(1))
    folder = spark.sparkContext.getCheckpointDir()
    written = lambda: len(glob.glob(f"{folder.removeprefix('file:')}/weftgraph/round-*"))
    before = written()
    reached = match.reached_nodes(edges, starts, "outbound", 3)
    assert written() - before == 3  # the starts and two rounds
    assert "lambda" not in plan_of(reached)
    assert {tuple(r) for r in reached.collect()} == {(s, s + d, d) for s in range(70) for d in (1, 2, 3) if s + d <= 100}


def test_starts_that_share_a_node_are_one_row(spark):
    """300 starts meet in one node and go on together: one row per node and round, also on the way there."""
    edges = spark.createDataFrame([(i, 1000) for i in range(300)] + [(1000, 1001), (1001, 1002)], "src long, dst long")
    steps = match._steps(edges, "outbound", True)
    levels, inner = match._sets_reached(steps, match._numbered_starts(spark.range(300)), 3)
    assert [level.count() for level in levels] == [300, 1, 1, 1]
    assert inner.count() == 302
    assert match.reached_nodes(edges, spark.range(300), "outbound", 3).groupBy("depth").count().filter("count = 300").count() == 3


def test_inbound_starts_share_a_row(spark):
    """The same against the direction of the edges: one row per node and round for 300 starts."""
    edges = spark.createDataFrame([(1000, i) for i in range(300)] + [(1001, 1000), (1002, 1001)], "src long, dst long")
    levels, _ = match._sets_reached(match._steps(edges, "inbound", True), match._numbered_starts(spark.range(300)), 3)
    assert [level.count() for level in levels] == [300, 1, 1, 1]


def test_stored_edges_are_derived_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    edges = spark.range(100).selectExpr("id AS src", "id + 1 AS dst").mapInArrow(count, "src long, dst long")
    match.StoredEdges(edges, str(tmp_path / "edges"), 2)
    assert made.value == 100
