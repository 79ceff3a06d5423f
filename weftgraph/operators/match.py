"""Pattern matching, paths and traversal over whole sets of start nodes."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.functions.startsets import BLOCK, ROUND, SENT, WORD, send, settle, words_of
from weftgraph.operators.filters import stable_label, where_in
from weftgraph.plans.materialize import materialize, write_table
from weftgraph.plans.ordering import check_limit, top_k_per_group, with_dense_ids
from weftgraph.plans.sizing import BROADCAST_ROWS, broadcast_if_small

DIRECTIONS = ("outbound", "inbound", "both")


def one_hop(source: DataFrame, edges: DataFrame, target: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """``(a)-[r]->(b)``: columns of ``source`` and ``target`` prefixed, edge columns kept.

    Two equi-joins; AQE turns either into a broadcast join once a side has proved small and
    splits a hot key of a sort-merge join otherwise.
    """
    left = source.select(*[F.col(c).alias(f"{src}_{c}") for c in source.columns])
    right = target.select(*[F.col(c).alias(f"{dst}_{c}") for c in target.columns])
    return left.join(edges, F.col(f"{src}_id") == F.col("src")).join(right, F.col("dst") == F.col(f"{dst}_id"))


def edge_key(edges: DataFrame) -> Column:
    """What tells two edges apart. Parallel edges share their ends, so an ``edge_id`` is required."""
    if "edge_id" not in edges.columns:
        raise ValueError("edges need an edge_id here; use edges_by_ends where no two share both ends")
    return F.col("edge_id")


def edges_by_ends(edges: DataFrame) -> DataFrame:
    """Edges with their pair of ends as ``edge_id``, for a type that holds each pair once."""
    return edges.withColumn("edge_id", F.struct("src", "dst"))


def two_hops(first: DataFrame, second: DataFrame, same_type: bool = False) -> DataFrame:
    """``(a)-[r1]->(b)-[r2]->(c)`` as ids ``a, b, c``; an edge is not used twice in one match."""
    left = first.select(F.col("src").alias("a"), F.col("dst").alias("b"), edge_key(first).alias("__e1"))
    right = second.select(F.col("src").alias("b"), F.col("dst").alias("c"), edge_key(second).alias("__e2"))
    joined = left.join(right, "b")
    if same_type:
        joined = joined.filter(F.col("__e1") != F.col("__e2"))
    return joined.select("a", "b", "c")


def pair_counts(first: DataFrame, second: DataFrame, same_type: bool = False, name: str = "matches") -> DataFrame:
    """How many matches ``two_hops`` has through each middle node ``b``, from the number of edges on either side of it.

    A node with n edges on both sides is two counts and not n times n rows. With ``same_type`` an edge that is on both sides
    of a node is taken off once, as it does not follow itself. Nodes without a match are left out.
    """
    ends = [first.select(F.col("dst").alias("b"), edge_key(first).alias("__e")), second.select(F.col("src").alias("b"), edge_key(second).alias("__e"))]
    into, out_of = [e.groupBy("b").agg(F.count("*").alias(n)) for e, n in zip(ends, ("__in", "__out"))]
    rows = into.join(out_of, "b")
    pairs = F.col("__in") * F.col("__out")
    if same_type:
        # Grouped before they are joined, so a hot node's edges are never on both sides of a join.
        twice = ends[0].groupBy("b", "__e").agg(F.count("*").alias("__n")).join(
            ends[1].groupBy("b", "__e").agg(F.count("*").alias("__m")), ["b", "__e"]
        )
        rows = rows.join(twice.groupBy("b").agg(F.sum(F.col("__n") * F.col("__m")).alias("__same")), "b", "left")
        pairs = pairs - F.coalesce("__same", F.lit(0))
    return rows.select("b", pairs.alias(name)).filter(F.col(name) > 0)


def paths(edges: DataFrame, starts: DataFrame, min_hops: int = 1, max_hops: int = 3) -> DataFrame:
    """Variable-length match: one row per path ``(start, end, hops, path)`` without a repeated edge.

    ``path`` lists the node ids. Each level is written once and reused for the next one and for
    the result, so the work is one join per hop.
    """
    check_limit(min_hops, "min_hops")
    check_limit(max_hops, "max_hops")
    step = edges.select(F.col("src").alias("end"), F.col("dst").alias("__next"), edge_key(edges).alias("__edge"))
    by_ends = False
    if max_hops > 1:
        by_ends, step = _written_steps(step)  # derived edges are made once, not once per hop
    first = starts.select(F.col("id").alias("start"), F.col("id").alias("end")).distinct()
    used = [] if by_ends else [F.array("__edge").alias("__used")]
    level = first.join(step, "end").select(F.col("__next").alias("end"), F.array("start", "__next").alias("path"), *used)
    kept = []
    for hops in range(1, max_hops + 1):
        known = None
        if hops < max_hops:
            level = write_table(level, "paths")  # a checkpoint would keep every id of every path uncompressed
            known = level.count()
        if hops >= min_hops:
            kept.append(level.select(F.col("path")[0].alias("start"), "end", F.lit(hops).alias("hops"), "path"))
        if known:
            level = F.broadcast(level) if known <= BROADCAST_ROWS else level
            again = _walked_before() if by_ends else F.array_contains("__used", F.col("__edge"))
            used = [] if by_ends else [F.array_append("__used", F.col("__edge")).alias("__used")]
            level = (
                level.join(step, "end")
                .filter(~again)
                .select(F.col("__next").alias("end"), F.array_append("path", F.col("__next")).alias("path"), *used)
            )
        elif known == 0:
            break
    if not kept:
        kept = [level.select(F.col("path")[0].alias("start"), "end", F.lit(0).alias("hops"), "path")]
    return reduce(DataFrame.unionByName, kept)


def _written_steps(step: DataFrame) -> tuple[bool, DataFrame]:
    """``end, __next, __edge`` written as a table; without ``__edge``, and true, where it is the pair of ends in every row.

    The path tells which edges it has used then, so neither steps nor paths carry their keys from hop to hop.
    """
    step = write_table(step, "steps")
    kind, ends = step.schema["__edge"].dataType, [step.schema[c].dataType for c in ("end", "__next")]
    if not isinstance(kind, T.StructType) or [f.dataType for f in kind.fields] != ends:
        return False, step
    pair = F.struct(*[F.col(c).alias(f.name) for c, f in zip(("end", "__next"), kind.fields)])
    if step.filter(~F.col("__edge").eqNullSafe(pair)).isEmpty():
        return True, step.select("end", "__next")
    return False, step


def _walked_before() -> Column:
    """Whether ``path`` has ``end`` followed by ``__next``. Most paths do not have ``__next`` at all, which is asked first."""
    pairs = F.arrays_zip(F.expr("slice(path, 1, size(path) - 1)").alias("a"), F.expr("slice(path, 2, size(path) - 1)").alias("b"))
    return F.array_contains("path", F.col("__next")) & F.array_contains(pairs, F.struct(F.col("end").alias("a"), F.col("__next").alias("b")))


def _directed(edges: DataFrame, direction: str) -> DataFrame:
    """Edges as steps ``from_id -> to_id``, outbound or inbound, with the real ends kept."""
    ways = {"outbound": ("src", "dst"), "inbound": ("dst", "src")}[direction]
    return edges.select(*[F.col(end).alias(name) for end, name in zip(ways, ("from_id", "to_id"))], "src", "dst")


def check_direction(direction: str) -> str:
    """The direction in lower case; any letter case is accepted."""
    name = direction.lower() if isinstance(direction, str) else None
    if name not in DIRECTIONS:
        raise ValueError(f"no direction {direction!r}; there are {', '.join(DIRECTIONS)}")
    return name


class StoredEdges:
    """Edges kept twice, bucketed and sorted by either end, so that a join on an end moves the other side only.

    Both tables lie under ``path`` and are known to the session under names of their own.
    """

    def __init__(self, edges: DataFrame, path: str, buckets: int):
        self.names: dict[str, str] = {}
        self.spark, self.buckets = edges.sparkSession, check_limit(buckets, "buckets")
        edges = write_table(edges.select("src", "dst"), "edges")  # derived edges are made once, not once per end
        for end in ("src", "dst"):
            name = f"weftgraph_edges_{end}_{uuid.uuid4().hex}"
            rows = edges.repartition(buckets, end)
            rows.write.option("path", f"{path}/by_{end}").bucketBy(buckets, end).sortBy(end).saveAsTable(name)
            self.names[end] = name

    def steps(self, direction: str) -> list[DataFrame]:
        """Tables ``from_id, to_id, src, dst``, each bucketed on ``from_id``; one for each way an edge is walked."""
        ways = {"outbound": [("src", "dst")], "inbound": [("dst", "src")], "both": [("src", "dst"), ("dst", "src")]}[direction]
        return [
            self.spark.table(self.names[a]).select(F.col(a).alias("from_id"), F.col(b).alias("to_id"), "src", "dst") for a, b in ways
        ]


def _steps(edges: DataFrame | StoredEdges, direction: str, often: bool) -> list[DataFrame]:
    """Steps in the direction asked; derived edges that are read ``often`` are written as a table first."""
    if isinstance(edges, StoredEdges):
        return edges.steps(direction)
    edges = edges.select("src", "dst")
    edges = write_table(edges, "edges") if often else edges
    ways = ("outbound", "inbound") if direction == "both" else (direction,)
    return [_directed(edges, way) for way in ways]


def _walk(frontier: DataFrame, steps: Sequence[DataFrame]) -> DataFrame:
    """Frontier rows with ``to_id, src, dst`` of every step that leaves their ``id``."""
    rows = [frontier.join(s.withColumnRenamed("from_id", "id"), "id") for s in steps]
    return reduce(DataFrame.unionByName, rows)


def _numbered_starts(starts: DataFrame) -> DataFrame:
    """``start, block, place`` of each distinct start: its place in blocks of ``BLOCK`` starts."""
    distinct = starts.select(F.col("id").cast("long").alias("start")).filter("start IS NOT NULL").distinct()
    placed = with_dense_ids(distinct, ["start"], "place")
    at = F.col("place")
    return write_table(
        placed.select("start", F.floor(at / BLOCK).cast("int").alias("block"), (at % BLOCK).cast("int").alias("place")), "starts"
    )


def _own_sets(numbered: DataFrame) -> DataFrame:
    """``id, block, fresh``: every start as a set of itself alone."""
    hexes = [F.lpad(F.hex(byte.cast("long")), 2, "0") for byte in (F.col("place") % 256, F.floor(F.col("place") / 256))]
    return numbered.select(F.col("start").alias("id"), "block", F.unhex(F.concat(F.lit("00"), *hexes)).alias("fresh"))


def _sets_reached(
    steps: Sequence[DataFrame], numbered: DataFrame, max_depth: int
) -> tuple[list[DataFrame], DataFrame]:
    """Per depth, from 0, a table ``id, block, fresh``: the starts that first reach ``id`` at this depth, as a set of bytes.

    Also ``id, block, seen``, all starts that reach ``id`` before the last depth.

    A row stands for up to ``BLOCK`` starts, so the starts that go along an edge share its ids. A round merges the sets that
    come over the edges with those seen before, first in the task that sends them, and writes node, fresh and seen sets as
    one table, which is all the next round reads.
    """
    seen = write_table(_own_sets(numbered).withColumn("seen", F.col("fresh")), "round")
    levels, inner = [seen.select("id", "block", "fresh")], seen
    for depth in range(1, max_depth + 1):
        # A small frontier is sent to the edges; only a large one shuffles them.
        inner, known = seen, levels[-1].count()
        if not known:
            break
        frontier = F.broadcast(levels[-1]) if known <= BROADCAST_ROWS else levels[-1]
        none = F.lit(None).cast("binary")
        came = _walk(frontier, steps).select(F.col("to_id").cast("long").alias("id"), "block", F.col("fresh").alias("new"))
        came = came.mapInArrow(send, SENT)
        rows = came.withColumn("old", none).unionByName(seen.select("id", "block", none.alias("new"), F.col("seen").alias("old")))
        rows = rows.repartition("id", "block").sortWithinPartitions("id", "block").mapInArrow(settle, ROUND)
        # The last round is the largest. No other follows, so it goes straight to whoever reads it, once.
        seen = rows if depth == max_depth else write_table(rows, "round")
        levels.append(seen.filter("fresh IS NOT NULL").select("id", "block", "fresh"))
    return levels, inner.select("id", "block", "seen")


def _spell_out(rows: DataFrame, numbered: DataFrame) -> DataFrame:
    """One row per start in the set ``starts`` of a ``block`` and not in ``known``, with ``start`` in place of these."""
    own = [f for f in rows.schema.fields if f.name not in ("block", "starts", "known")]
    rows = rows.mapInArrow(words_of, T.StructType([*own, T.StructField("word", T.LongType()), T.StructField("bits", T.LongType())]))
    # At most one start per bit; starts are numbered without gaps, so a bit is a place in its word's list.
    word = F.col("block").cast("long") * (BLOCK // WORD) + F.floor(F.col("place") / WORD)
    words = numbered.groupBy(word.alias("word")).agg(F.sort_array(F.collect_list(F.struct("place", "start"))).alias("__starts"))
    words = words.select("word", F.col("__starts.start").alias("__starts"))
    met = rows.join(broadcast_if_small(write_table(words, "words")), "word")
    # Compiled, unlike a function over the list: most rows of a large graph have one bit set, and all are looked at.
    each = met.withColumn("__bit", F.explode(F.array(*[F.lit(bit) for bit in range(WORD)])))
    asking = each.filter(F.call_function("shiftright", F.col("bits"), F.col("__bit")).bitwiseAND(F.expr("1L")) == 1)
    return asking.withColumn("start", F.col("__starts")[F.col("__bit")]).drop("word", "__starts", "__bit", "bits")


def _by_depth(levels: list[DataFrame]) -> DataFrame:
    """The levels behind the starts as one table ``id, block, starts, depth``."""
    levels = [level.withColumnRenamed("fresh", "starts") for level in levels]
    found = [level.withColumn("depth", F.lit(depth)) for depth, level in enumerate(levels) if depth]
    if not found:
        return levels[0].filter(F.lit(False)).withColumn("depth", F.lit(0))
    return reduce(DataFrame.unionByName, found)


def reached_nodes(
    edges: DataFrame | StoredEdges, starts: DataFrame, direction: str = "outbound", max_depth: int = 1
) -> DataFrame:
    """``(start, id, depth)`` of every node within ``max_depth`` hops; ``depth`` is the least one.

    Breadth-first for all starts at once. A start is never part of its own result, also when a
    cycle leads back to it. Each round is written out, which cuts the plan and survives a lost
    executor; the loop ends early when a round finds nothing new.
    """
    direction = check_direction(direction)
    check_limit(max_depth, "max_depth")
    numbered = _numbered_starts(starts)
    levels, _ = _sets_reached(_steps(edges, direction, max_depth > 1), numbered, max_depth)
    return _spell_out(_by_depth(levels), numbered).select("start", "id", "depth")


def _walked(steps: Sequence[DataFrame], inner: DataFrame) -> DataFrame:
    """``src, dst, block, starts, known``: the steps that leave a node of ``inner``, for the starts that reach it.

    With two ways to walk an edge, one between two inner nodes is met from either end; ``known`` has the starts that met it
    from the other. Only the steps of the second way are shuffled for that. The steps hold no parallel edges then.
    """
    nodes = broadcast_if_small(inner.withColumnRenamed("seen", "starts"))
    none = F.lit(None).cast("binary").alias("known")
    if len(steps) == 1:
        return _walk(nodes, steps).select("src", "dst", "block", "starts", none)
    ahead, back = [_walk(nodes, [s]).select("src", "dst", "block", "starts") for s in steps]
    met = nodes.select(F.col("id").alias("src"), "block", F.col("starts").alias("known"))
    return ahead.withColumn("known", none).unionByName(back.join(met, ["src", "block"], "left").select("src", "dst", "block", "starts", "known"))


def traverse(
    edges: DataFrame | StoredEdges, starts: DataFrame, direction: str = "outbound", max_depth: int = 1
) -> tuple[DataFrame, DataFrame]:
    """k-hop traversal: reached nodes ``(start, id, depth)`` and traversed edges ``(start, src, dst)``.

    The edges are all those leaving, in the direction asked, a node of depth below ``max_depth``.
    """
    direction = check_direction(direction)
    check_limit(max_depth, "max_depth")
    numbered = _numbered_starts(starts)
    stored, both = isinstance(edges, StoredEdges), direction == "both"
    if both and not stored:
        edges = edges.select("src", "dst").distinct()  # parallel edges are one
    steps = _steps(edges, direction, True)
    once = [step.distinct() for step in steps] if both and stored else steps
    levels, inner = _sets_reached(steps, numbered, max_depth)
    return (
        _spell_out(_by_depth(levels), numbered).select("start", "id", "depth"),
        _spell_out(_walked(once, inner), numbered).select("start", "src", "dst"),
    )


def with_nodes(reached: DataFrame, nodes: DataFrame) -> DataFrame:
    """Reached nodes in full: ``start, depth`` and all columns of ``nodes``. An id that ``nodes`` lacks is left out."""
    return reached.select("start", "depth", "id").join(nodes, "id")


def in_scope(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose two ends are both among ``nodes`` (its ``id``), for matches that stay in one scope."""
    inside = broadcast_if_small(nodes.select("id").distinct())
    at_src = edges.join(inside.withColumnRenamed("id", "src"), "src", "left_semi")
    return at_src.join(inside.withColumnRenamed("id", "dst"), "dst", "left_semi").select(*edges.columns)


def reachable(
    edges: DataFrame, starts: DataFrame, depth: int = 1, limit: int | None = None,
    least: int | None = None, most: int | None = None, scope: DataFrame | None = None,
) -> DataFrame:
    """Distinct nodes within ``depth`` hops over any edge type; ``limit`` keeps the smallest ids per start.

    ``least`` and ``most`` clamp the depth. With ``scope``, a table of node ids, the starts and every node
    on the way belong to it.
    """
    if least is not None:
        depth = max(depth, check_limit(least, "least"))
    if most is not None:
        depth = min(depth, check_limit(most, "most"))
    if scope is not None:
        scope = materialize(scope.select("id").distinct())
        edges = in_scope(edges, scope)
        starts = starts.join(broadcast_if_small(scope), "id", "left_semi")
    found = reached_nodes(edges, starts, "outbound", depth).select("start", "id")
    if limit is None:
        return found
    return top_k_per_group(found, ["start"], [F.col("id")], limit).drop("rank")


def undirected(edges: DataFrame) -> DataFrame:
    """``-[r]-``: every edge once per endpoint, as ``(node, other, type)``; a loop has one."""
    out = edges.select(F.col("src").alias("node"), F.col("dst").alias("other"), "type")
    back = edges.filter("src <> dst").select(F.col("dst").alias("node"), F.col("src").alias("other"), "type")
    return out.unionByName(back)


def match_pairs(left: DataFrame, right: DataFrame, pairs: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Two separate patterns bound by a table of wanted pairs ``(left_key, right_key)``.

    The reference form names both nodes by key; for a batch the keys sit in ``pairs``, so two
    equi-joins replace the product of the two sides.
    """
    a = left.select(F.col("id").alias("src"), F.col("name").alias(left_key))
    b = right.select(F.col("id").alias("dst"), F.col("name").alias(right_key))
    return pairs.join(a, left_key).join(b, right_key)


def triplets(
    edges: DataFrame,
    names: DataFrame,
    entity_names: Sequence[str] | None = None,
    relation_names: Sequence[str] | None = None,
    properties: dict | None = None,
    ids: Sequence | None = None,
    limit: int | None = None,
) -> DataFrame:
    """``(src, src_name, rel, dst, dst_name)``; the entity filter accepts a match at either end.

    An empty list is no filter. Wanted names become ids first, and the edges are reduced to those that
    touch one before any name is joined.
    """
    if properties or ids:
        raise NotImplementedError("triplets cannot be filtered by properties or ids")
    if relation_names:
        edges = where_in(edges, "type", list(relation_names))
    subjects = names.select(F.col("id").alias("src"), F.col("name").alias("src_name"))
    objects = names.select(F.col("id").alias("dst"), F.col("name").alias("dst_name"))
    edges = edges.select("src", F.col("type").alias("rel"), "dst")
    if entity_names:
        wanted = materialize(where_in(names, "name", list(entity_names)).select("id").distinct())
        small = broadcast_if_small(wanted)
        at_src = edges.join(small.withColumnRenamed("id", "src"), "src", "left_semi")
        rest = edges.join(small.withColumnRenamed("id", "src"), "src", "left_anti")
        edges = at_src.unionByName(rest.join(small.withColumnRenamed("id", "dst"), "dst", "left_semi").select("src", "rel", "dst"))
    rows = edges.join(subjects, "src").join(objects, "dst")
    rows = rows.select("src", "src_name", "rel", "dst", "dst_name")
    return rows if limit is None else rows.orderBy("src", "rel", "dst").limit(check_limit(limit))


def relation_map(
    edges: DataFrame,
    nodes: DataFrame,
    depth: int = 1,
    limit: int | None = None,
    ignore_rels: Sequence[str] | None = None,
    per_node: bool = False,
) -> DataFrame:
    """Outgoing edges ``(src, rel, dst)`` of the given nodes; ignored types never use up the limit.

    ``per_node`` applies the limit to every source on its own.
    """
    if depth != 1:
        raise NotImplementedError("relation_map supports depth 1 only")
    rows = edges.select("src", F.col("type").alias("rel"), "dst")
    if ignore_rels:
        rows = where_in(rows, "rel", sorted(set(ignore_rels)), negate=True)
    rows = rows.join(nodes.select(F.col("id").alias("src")).distinct(), "src", "left_semi")
    if limit is None:
        return rows
    if per_node:
        return top_k_per_group(rows, ["src"], [F.col("rel"), F.col("dst")], limit).drop("rank")
    return rows.orderBy("src", "rel", "dst").limit(check_limit(limit))


def relationship_triples(edges: DataFrame, labelled: DataFrame) -> DataFrame:
    """Distinct ``(start, type, end)`` labels; ``labelled`` is ``(id, labels)``.

    Parallel links are reduced to distinct pairs of label and type map-side after each join.
    """
    label = labelled.select("id", stable_label("labels").alias("__label"))
    starts = label.select(F.col("id").alias("src"), F.col("__label").alias("start"))
    ends = label.select(F.col("id").alias("dst"), F.col("__label").alias("end"))
    by_start = edges.join(starts, "src").select("start", "type", "dst").distinct()
    joined = by_start.join(ends, "dst").select("start", "type", "end").distinct()
    return joined.filter("start IS NOT NULL AND type IS NOT NULL AND end IS NOT NULL")
