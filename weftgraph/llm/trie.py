"""Prefix trie of conversations by burst containers.

Turns get integer names first, so a conversation is a row of names. A container holds what is left of all
conversations below one trie head. A container too large for a task bursts: its head becomes an inner node, and
each next turn is the head of a smaller container. Those that fit are sharded over the tasks, where
their suffixes are sorted and swept into nodes; a conversation alone in its container is a chain of nodes
that needs no sweep. At last the burst heads add up what lies below them, deepest first.

A large container is never gathered: it is rows of a conversation and its head, counted map-side by
next turn. One of equal conversations is passed in one stretch until all have ended, and then is a count. The smallest
member names a node among those of its depth, so ``(conv_id, depth)`` is a node's key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.llm.runs import name_runs, running_total
from weftgraph.llm.store import store
from weftgraph.plans.sizing import broadcast_if_small

#: Conversations and turns together in a container that a task sweeps; a larger one bursts.
CONTAINER = 1 << 16
#: Conversations of a family begin alike for 0 to ``MOST_SHARED`` turns.
FAMILY, MOST_SHARED = 100, 5
#: Bytes of joined ids that a task writes as one piece of a long list of members.
PIECE_BYTES = 1 << 16

NODE_COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
NODES = T.StructType(
    [T.StructField(c, T.LongType()) for c in NODE_COLUMNS[:-1]] + [T.StructField("ends_sha256", T.StringType())]
)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def named_turns(conversations: DataFrame) -> DataFrame:
    """``conv, pos, name, chars``: turns in order, equal ``(role, text)`` under one integer name.

    Order is by ``turn`` (null first); turns of one number follow each other by a hash of role and text,
    so reruns agree and repeated rows are turns of their own. Null roles and texts are empty. Rows without
    ``conv_id`` belong to no conversation. Texts are compared themselves; they move once, and never again.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).filter("conv IS NOT NULL")
    turns = turns.select("*", F.xxhash64("role", "text").alias("tie"), F.length("text").cast("long").alias("chars"))
    named = name_runs(
        turns, ["role", "text"], ["conv", "turn"], ["conv", "turn", "tie", "chars"], hash_col="tie", name="turn-names"
    )
    named = store(named.select("conv", "turn", "tie", "chars", "name", F.lit(1).cast("long").alias("one")), "turns")
    placed = running_total(named, "conv", ["turn", "tie", "name"], ["one"], name="turn-places")
    return store(placed.select("conv", F.col("upto_one").alias("pos"), "name", "chars"), "placed-turns")


def shared_turns(conv: Column, most: int = MOST_SHARED) -> Column:
    """How many turns a conversation takes from the head of its family: CRC-32 of the decimal id, modulo ``most + 1``."""
    return F.crc32(conv.cast("string").cast("binary")) % (most + 1)


def rebuilt(turns: DataFrame, family: int = FAMILY, most: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of their family's first one: turns ``conv, depth, name, chars`` and ``conv, n``.

    Conversation ``c`` takes the first ``h`` turns of ``c - c % family`` (fewer if it has no more, none if it
    is not there), ``h`` from ``shared_turns``, and goes on with its own turns behind its first ``h``. It may have none.
    """
    own = turns.groupBy("conv").agg(F.max("pos").alias("own"))
    heads = turns.filter(F.col("pos") <= most).groupBy(F.col("conv").alias("base"))
    heads = heads.agg(F.sort_array(F.collect_list(F.struct("pos", "name", "chars"))).alias("head"))  # at most ``most`` turns
    convs = own.select("conv", "own", shared_turns(F.col("conv"), most).alias("h"), (F.col("conv") - F.col("conv") % family).alias("base"))
    convs = convs.join(heads, "base", "left").withColumn(
        "head", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("h").cast("int"))
    )
    convs = store(convs.select("conv", "own", "h", "head", F.size("head").cast("long").alias("taken")), "families")
    first = convs.select("conv", F.explode("head").alias("t")).select("conv", F.col("t.pos").alias("depth"), "t.name", "t.chars")
    rest = turns.join(broadcast_if_small(convs.select("conv", "h", "taken")), "conv").filter("pos > h")
    rest = rest.select("conv", (F.col("taken") + F.col("pos") - F.col("h")).alias("depth"), "name", "chars")
    long = convs.select("conv", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n"))
    return first.union(rest), long


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of whole containers. Rows come sorted by container, conversation and depth, the head's depth first.

    Columns: depth of the head, head, the head's parent, code points of its last turn, conversation, depth, name
    and code points of the turn.
    """
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        key = np.stack([table[i].to_numpy() for i in (0, 1)])
        cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        bounds = [0, *cut.tolist()]
        for b, e in zip(bounds, bounds[1:]):
            yield container_nodes(table.slice(b, e - b))
        held = table.slice(bounds[-1]).combine_chunks()
    if held is not None:
        yield container_nodes(held)


class _Open:
    """A node whose subtree the sweep is still in."""

    __slots__ = ("depth", "chars", "least", "convs", "children", "leaves", "saved", "ends", "rows")

    def __init__(self, depth: int, chars: int):
        self.depth, self.chars = depth, chars
        self.least, self.convs, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends: list[int] = []
        self.rows: list[int] = []  # the children's places in the output

    def end(self, conv: int) -> None:
        self.ends.append(conv)
        self.convs += 1
        self.least = conv if self.least is None else min(self.least, conv)

    def close(self) -> None:
        self.leaves = self.leaves or 1
        self.saved += (self.convs - 1) * self.chars

    def add(self, child: _Open, row: int) -> None:
        self.least = child.least if self.least is None else min(self.least, child.least)
        self.convs += child.convs
        self.children += 1
        self.leaves += child.leaves
        self.saved += child.saved
        self.rows.append(row)


def ends_digest(convs: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, sorted(convs))).encode()).hexdigest()


def container_nodes(table: pa.Table) -> pa.RecordBatch:
    """All nodes of one container, its head included, from the sorted suffixes."""
    top, _, parent, top_chars = (table[i][0].as_py() for i in range(4))
    conv, depth = table[4].to_numpy(), table[5].to_numpy()
    names, chars = (table[i].fill_null(0).to_numpy() for i in (6, 7))
    begins = np.flatnonzero(depth == top)
    stops = np.append(begins[1:], len(conv))
    suffixes = [names[b + 1 : e] for b, e in zip(begins, stops)]
    # Names are not negative, so their bytes, most significant first, sort as they do; equal ones stay in order of conversation.
    keys = [s.astype(">i8").tobytes() for s in suffixes]
    order = sorted(range(len(keys)), key=keys.__getitem__)

    out: list[list] = [[] for _ in NODE_COLUMNS]
    path = [_Open(top, top_chars)]

    def shut() -> None:
        node = path.pop()
        node.close()
        row = len(out[0])
        digest = ends_digest(node.ends) if node.ends else NO_ENDS
        values = (node.least, node.depth, parent, node.convs, node.children, node.leaves, node.saved, digest)
        for column, value in zip(out, values):
            column.append(value)
        for child in node.rows:
            out[2][child] = node.least
        if path:
            path[-1].add(node, row)

    before = np.zeros(0, np.int64)
    for i in order:
        now = suffixes[i]
        both = min(len(now), len(before))
        differ = np.flatnonzero(now[:both] != before[:both])
        common = int(differ[0]) if len(differ) else both
        while len(path) > common + 1:
            shut()
        at = begins[i] + 1
        path += [_Open(top + d + 1, int(chars[at + d])) for d in range(common, len(now))]
        path[-1].end(int(conv[begins[i]]))
        before = now
    while path:
        shut()
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in out[:-1]] + [pa.array(out[-1], pa.string())], names=list(NODE_COLUMNS)
    )


PIECES = "depth long, node long, first long, ids string"


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of each node in a sorted slice, joined into strings of bounded size; columns depth, node, conversation."""

    def out(depth, node, ids) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([depth], pa.int64()), pa.array([node], pa.int64()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])],
            names=["depth", "node", "first", "ids"],
        )

    key, ids = None, []
    for batch in batches:
        for depth, node, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if ids and (key != (depth, node) or 20 * len(ids) >= PIECE_BYTES):
                yield out(*key, ids)
                ids = []
            key = (depth, node)
            ids.append(conv)
    if ids:
        yield out(*key, ids)


def _digest_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each node from its pieces in order; a list of any length passes as a stream."""
    key, digest = None, None
    names = ["depth", "conv_id", "ends_sha256"]

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(names, (*key, digest.hexdigest())))])

    for batch in batches:
        for depth, node, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if key == (depth, node):
                digest.update(b",")
            else:
                if key is not None:
                    yield out()
                key, digest = (depth, node), hashlib.sha256()
            digest.update(ids.encode())
    if key is not None:
        yield out()


def _digests(ends: DataFrame) -> DataFrame:
    """``depth, conv_id, ends_sha256`` of nodes from rows ``depth, node, conv``.

    The ids are sorted and joined in slices, so a node where a third of all conversations end comes to its digest, which
    is sequential by nature, as few long strings.
    """
    pieces = ends.repartitionByRange("depth", "node", "conv").sortWithinPartitions("depth", "node", "conv").mapInArrow(_join_ids, PIECES)
    ordered = pieces.repartition("depth", "node").sortWithinPartitions("depth", "node", "first").select("depth", "node", "ids")
    return ordered.mapInArrow(_digest_pieces, "depth long, conv_id long, ends_sha256 string")


#: Depths named in a filter on the turns; containers at more depths than these read all turns in a round.
FEW_DEPTHS = 100


def _stretches(heads: DataFrame, members: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """How far all members of each head go on alike, and the nodes passed on the way.

    ``heads``: head, depth, parent, chars; ``members``: conv, n, head, depth. Returns ``head, bottom, chars, passed``
    (code points of the nodes from the head down to the one before the bottom) and ``head, depth, before``
    (code points of the passed nodes above). All members are compared with the head's own conversation at once.
    """
    tops = heads.select("head", F.col("depth").alias("top"))
    own = store(
        turns.withColumnRenamed("conv", "head").join(broadcast_if_small(tops), "head").filter("depth > top").drop("top"), "head-turns"
    )
    others = members.select("conv", "head", F.col("depth").alias("top")).join(turns.drop("chars"), "conv").filter("depth > top")
    same = others.join(
        broadcast_if_small(own.select("head", "depth", F.col("name").alias("own"))), ["head", "depth"], "left"
    )
    parted = same.filter("own IS NULL OR own <> name").groupBy("head").agg(F.min("depth").alias("parted"))
    ends = members.groupBy("head").agg(F.min("n").alias("shortest")).join(parted, "head", "left")
    ends = store(
        ends.select("head", F.least(F.col("shortest"), F.coalesce(F.col("parted") - 1, F.col("shortest"))).alias("bottom")), "bottoms"
    )
    path = heads.select("head", "depth", "chars").union(own.select("head", "depth", "chars"))
    path = store(path.join(broadcast_if_small(ends), "head").filter("depth <= bottom"), "stretches")
    passed = running_total(path, "head", ["depth"], ["chars"], name="passed")
    last = passed.filter("depth = bottom").select("head", "bottom", "chars", F.col("before_chars").alias("passed"))
    nodes = passed.filter("depth < bottom").select("head", "depth", F.col("before_chars").alias("before"))
    return store(last, "bottom-nodes"), store(nodes, "passed-nodes")


def prefix_trie(turns: DataFrame, convs: DataFrame, container: int = CONTAINER) -> DataFrame:
    """Nodes of the trie over conversations ``conv, n`` with turns ``conv, depth, name, chars`` (``depth`` 1 to ``n``).

    A node is a distinct sequence of first turns; the root has none, at depth 0. Per node: ``conv_id``, the
    smallest member; ``depth``; ``parent_conv_id`` (root: null); ``n_convs`` members; ``n_children``; ``n_leaves``
    childless nodes in its subtree, itself included; ``saved_tokens``, over its subtree the code points of each
    node's last turn times its members but one; ``ends_sha256`` over the ascending ids of the
    conversations that end there, joined by commas. Without conversations there is no node, not even the root.

    Where a large container has only one next turn, its members are compared at once as far as they agree, so
    copies of a long conversation take two rounds and not one a turn.
    """
    spark = turns.sparkSession
    ordered = turns.repartitionByRange("depth", "conv").sortWithinPartitions("depth", "conv")
    turns = store(ordered.select("conv", "depth", "name", "chars"), "trie-turns")
    convs = store(convs, "trie-convs")
    total = convs.agg(F.count("*").alias("convs"), F.sum("n").alias("turns"), F.min("conv").alias("least")).first()
    if not total["convs"]:
        return spark.createDataFrame([], NODES)

    def long(value) -> Column:
        return F.lit(value).cast("long")

    # Members of containers to sweep and of single ones, with the head: its depth, parent, code points, members, round.
    settled: list[DataFrame] = []
    # Per round the heads that burst. A head may stand at the foot of a stretch of nodes with the same members, from
    # ``top``, whose parent it names, down to ``depth``; ``passed`` are the stretch's code points above ``depth``.
    burst: list[DataFrame] = []
    passed: list[DataFrame | None] = []
    ends: list[DataFrame] = []
    large = total["convs"] + total["turns"] > container
    if large:
        heads = "head long, top long, parent long, depth long, chars long, members long, passed long"
        burst.append(spark.createDataFrame([(total["least"], 0, None, 0, 0, total["convs"], 0)], heads))
        passed.append(None)
        left = convs.select("conv", "n", long(total["least"]).alias("head"), long(0).alias("depth"))
        ends.append(left.filter("n = 0").select("depth", F.col("head").alias("node"), "conv"))
        left = left.filter("n > 0")
    else:
        settled.append(
            convs.select(
                "conv", "n", long(0).alias("depth"), long(total["least"]).alias("head"), long(None).alias("parent"),
                long(0).alias("chars"), long(total["convs"]).alias("members"), long(0).alias("round"),
            )
        )
    while large:
        depths = [r.depth for r in burst[-1].select("depth").distinct().limit(FEW_DEPTHS + 1).collect()]
        near = turns if len(depths) > FEW_DEPTHS else turns.filter(F.col("depth").isin([d + 1 for d in depths]))
        step = left.select("conv", "n", F.col("head").alias("parent"), (F.col("depth") + 1).alias("depth")).join(near, ["conv", "depth"])
        heads = step.groupBy("parent", "name").agg(
            F.min("conv").alias("head"), F.max("depth").alias("depth"), F.max("chars").alias("chars"), F.count("*").alias("members"),
            F.sum(F.col("n") - F.col("depth") + 1).alias("size"),
        )
        heads = store(heads, "heads").withColumn("large", F.col("size") > container)
        moved = step.select("conv", "n", "parent", "name").join(broadcast_if_small(heads), ["parent", "name"])
        moved = store(moved.select("conv", "n", "depth", "head", "parent", "chars", "members", "large"), "members")
        settled.append(moved.filter("NOT large").drop("large").withColumn("round", long(len(burst))))
        grown = heads.filter("large").select("head", "depth", "parent", "chars", "members")
        large = not grown.isEmpty()
        if not large:
            break
        left = moved.filter("large").select("conv", "n", "head", "depth")
        above = burst[-1].select(F.col("head").alias("parent"), F.col("members").alias("above"))
        alone = store(grown.join(above, "parent").filter("members = above").drop("above"), "only-children")
        level = grown.select("head", F.col("depth").alias("top"), "parent", "depth", "chars", "members", long(0).alias("passed"))
        nodes = None
        if not alone.isEmpty():
            bottoms, nodes = _stretches(alone, left.join(broadcast_if_small(alone.select("head")), "head", "left_semi"), turns)
            feet = bottoms.toDF("head", "foot", "foot_chars", "above")
            level = level.join(broadcast_if_small(feet), "head", "left").select(
                "head", "top", "parent", F.coalesce("foot", "depth").alias("depth"), F.coalesce("foot_chars", "chars").alias("chars"),
                "members", F.coalesce("above", "passed").alias("passed"),
            )
            left = left.join(broadcast_if_small(feet.select("head", "foot")), "head", "left").select(
                "conv", "n", "head", F.coalesce("foot", "depth").alias("depth")
            )
        burst.append(store(level, "burst"))
        passed.append(nodes)
        ends.append(left.filter("n = depth").select("depth", F.col("head").alias("node"), "conv"))
        left = left.filter("n > depth")

    below = settled[0]
    for more in settled[1:]:
        below = below.union(more)
    head = [F.col(c).alias(f"top_{c}") for c in ("depth", "head", "parent", "chars")]
    lone = below.filter("members = 1").select("conv", "n", *head)
    swept = below.filter("members > 1").select("conv", *head)

    chain = lone.select("*", F.explode(F.sequence("top_depth", "n")).alias("depth"))
    at_end = F.col("depth") == F.col("n")
    chain = chain.select(
        F.col("conv").alias("conv_id"), "depth",
        F.when(F.col("depth") == F.col("top_depth"), F.col("top_parent")).otherwise(F.col("conv")).alias("parent_conv_id"),
        long(1).alias("n_convs"), F.when(at_end, 0).otherwise(1).cast("long").alias("n_children"),
        long(1).alias("n_leaves"), long(0).alias("saved_tokens"),
        F.when(at_end, F.sha2(F.col("conv").cast("string").cast("binary"), 256)).otherwise(NO_ENDS).alias("ends_sha256"),
    )

    order = ["top_depth", "top_head", "top_parent", "top_chars", "conv", "depth", "name", "chars"]
    rows = swept.join(turns, "conv").filter("depth > top_depth").select(*order)
    rows = rows.union(swept.select("top_depth", "top_head", "top_parent", "top_chars", "conv", "top_depth", long(None), long(None)))
    rows = rows.repartition("top_depth", "top_head").sortWithinPartitions("top_depth", "top_head", "conv", "depth")
    nodes = rows.mapInArrow(_sweep, NODES)
    if not burst:
        return chain.union(nodes)

    nodes = store(chain.union(nodes), "nodes")
    tops = below.groupBy("round", "depth", "head").agg(F.max("parent").alias("parent")).join(
        nodes.select("depth", F.col("conv_id").alias("head"), "n_leaves", "saved_tokens"), ["depth", "head"]
    )
    tops = store(tops.select("round", "parent", "n_leaves", "saved_tokens"), "container-tops")
    ended = ends[0]
    for more in ends[1:]:
        ended = ended.union(more)
    digests = store(_digests(ended), "ends").select("depth", F.col("conv_id").alias("head"), "ends_sha256")
    found, up = nodes, None  # ``up``: heads of the round below as children of this round's
    for place in reversed(range(len(burst))):
        child = tops.filter(F.col("round") == place + 1).drop("round")
        child = child if up is None else child.unionByName(up)
        sums = child.groupBy(F.col("parent").alias("head")).agg(
            F.count("*").alias("n_children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
        )
        level = burst[place].join(sums, "head", "left").join(digests, ["depth", "head"], "left")
        level = store(
            level.withColumns(
                {
                    "n_leaves": F.coalesce("leaves", F.lit(1)).cast("long"),
                    "saved_tokens": (F.coalesce("saved", F.lit(0)) + (F.col("members") - 1) * F.col("chars")).cast("long"),
                }
            ),
            "burst-heads",
        )
        found = found.union(
            level.select(
                F.col("head").alias("conv_id"), "depth", F.when(F.col("depth") > F.col("top"), F.col("head")).otherwise(F.col("parent")),
                "members", F.coalesce("n_children", F.lit(0)).cast("long"), "n_leaves", "saved_tokens",
                F.coalesce("ends_sha256", F.lit(NO_ENDS)),
            )
        )
        stretch = F.col("saved_tokens") + (F.col("members") - 1) * F.col("passed")
        if passed[place] is not None:
            on_way = passed[place].join(level.drop("depth"), "head")
            found = found.union(
                on_way.select(
                    "head", "depth", F.when(F.col("depth") > F.col("top"), F.col("head")).otherwise(F.col("parent")), "members", long(1),
                    "n_leaves", stretch - (F.col("members") - 1) * F.col("before"), F.lit(NO_ENDS),
                )
            )
        up = level.select("parent", "n_leaves", stretch.alias("saved_tokens"))
    return found


def conversation_trie(conversations: DataFrame, container: int = CONTAINER) -> DataFrame:
    """The trie over the conversations as they are."""
    turns = named_turns(conversations)
    return prefix_trie(turns.withColumnRenamed("pos", "depth"), turns.groupBy("conv").agg(F.max("pos").alias("n")), container)
