"""Approximate nearest neighbours by a stored graph: NN-descent makes the links, a beam of ``ef`` rows walks them.

Every vector is compared with a bounded number of vectors of its nearest cells. The links found are then improved in
rounds: the neighbours of a vector, and those it is a neighbour of, are a row group of ids and are compared
with each other (Dong, Moses and Li, 2011), unless they were a round ago. A group has at most ``2 * POOL * links + 1`` members, so
no vector, however many it is near to, makes a large one. Groups are dealt to blocks of alike vectors, and a vector
goes to a block once for all groups that it is in there.

Stored vectors carry their links, with the cell of each linked vector, and lie in one folder per group of cells. A round of
a search is two scans, by literals on folders and cells: of the links of the beams' new rows, and of the vectors they lead to.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.functions.distance import check_metric, distance
from weftgraph.functions.nearest import TIE_DECIMALS, to_matrix
from weftgraph.operators.cells import GROUP_CELLS, NEAR_GROUPS, Centres, StoredCells, _assigned, _read_centres, build_index, gaps, unit_rows
from weftgraph.operators.vector import empty_hits, usable
from weftgraph.plans.materialize import materialize, write_table
from weftgraph.plans.ordering import check_limit, top_k_per_group
from weftgraph.plans.sizing import broadcast_if_small, fits

#: Nearest vectors that each one links to; up to as many that link to it are stored beside them.
LINKS = 16
#: Links kept per vector while the graph is made, for each one that is stored; with no more than are stored, rounds settle
#: before the nearest are found.
POOL = 1.5
#: Cells in which a vector looks for its first links, and in which a search begins.
FIRST_CELLS, ENTRY_CELLS = 8, 4
#: Vectors of a cell that meet in one block, and vectors that come to look at a block before it is read by another task.
BLOCK, VISITORS = 512, 50_000
#: Row groups are compared in so many blocks, or in more of at most so many numbers in the vectors that they are the groups of.
BLOCKS, BLOCK_VALUES = 12, 4_000_000
#: Found links that wait in a task for the next merge with the nearest ones.
WAITING = 2_000_000
#: Most rounds of improvement, and the share of new links below which they end.
ROUNDS, SETTLED = 8, 0.005
#: Cells named one by one in a filter.
NAMED_CELLS = 500

LINK = "src long, dst long, gap double"


def near_cells(centres: Centres, rows: np.ndarray, count: int) -> np.ndarray:
    """Positions of the ``count`` nearest cells of every row among the cells of its nearest groups; -1 where there are fewer."""
    rows = centres.place(rows)
    names, begins = np.unique(centres.groups, return_index=True)
    ends = np.append(begins[1:], len(centres.groups))
    middle = np.add.reduceat(centres.matrix, begins) / (ends - begins)[:, None]
    near = np.argsort(gaps(rows, middle), axis=1, kind="stable")[:, :NEAR_GROUPS]
    at = np.full((len(rows), near.shape[1] * count), -1)
    far = np.full(at.shape, np.inf)
    for i, column in enumerate(near.T):
        for g in np.unique(column):
            own = np.flatnonzero(column == g)
            found = gaps(rows[own], centres.matrix[begins[g] : ends[g]])
            best = np.argsort(found, axis=1, kind="stable")[:, :count]
            slots = i * count + np.arange(best.shape[1])
            at[own[:, None], slots] = begins[g] + best
            far[own[:, None], slots] = np.take_along_axis(found, best, axis=1)
    order = np.argsort(far, axis=1, kind="stable")[:, :count]
    return np.take_along_axis(at, order, axis=1)


def _to_cells(vectors: DataFrame, centres: Centres, count: int, key: str) -> DataFrame:
    """Every row once for each of its ``count`` nearest cells (column ``cell``)."""
    kind = vectors.schema["embedding"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                part = batch.slice(begin, 4096)
                near = near_cells(centres, to_matrix(part.column(1), centres.matrix.shape[1]), count)
                row, slot = np.nonzero(near >= 0)
                cell = pa.array(centres.cells[near[row, slot]], pa.int32())
                yield part.take(pa.array(row)).append_column("cell", cell)

    return vectors.select(F.col(key).cast("long").alias(key), "embedding").mapInArrow(run, f"{key} long, embedding {kind}, cell int")


def _nearest_links(found: DataFrame, links: int) -> DataFrame:
    """The ``links`` nearest distinct ones of every vector; a ``fresh`` link is in no row that was there before."""
    merged = found.repartition("src").groupBy("src", "dst").agg(F.min("gap").alias("gap"), F.min("fresh").alias("fresh"))
    return top_k_per_group(merged, ["src"], [F.col("gap"), F.col("dst")], links).drop("rank")


def _first_links(placed: DataFrame, centres: Centres, links: int) -> DataFrame:
    """Links to vectors of the nearest cells.

    A cell is cut into blocks by a hash of the id, and a vector looks at one block of each of its cells. A block that
    very many look at is read by several tasks.
    """
    homes = placed.select("id", "embedding", "cell")
    visits = write_table(_to_cells(placed, centres, FIRST_CELLS, "id"), "graph-visits")
    sizes = homes.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    busy = visits.groupBy("cell").agg(F.count("*").alias("visits"))
    # A row per cell.
    cells = broadcast_if_small(materialize(
        sizes.join(busy, "cell").select("cell", "parts", F.ceil(F.col("visits") / F.col("parts") / VISITORS).cast("int").alias("copies"))
    ))
    block = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    copy = F.explode(F.sequence(F.lit(0), F.col("copies") - 1))
    lying = homes.join(cells, "cell").select("cell", block.alias("part"), copy.alias("copy"), F.lit(0).alias("looks"), "id", "embedding")
    looking = visits.join(cells, "cell").select(
        "cell", F.pmod(F.xxhash64("id", F.lit("block")), F.col("parts")).cast("int").alias("part"),
        F.pmod(F.xxhash64("id", F.lit("copy")), F.col("copies")).cast("int").alias("copy"), F.lit(1).alias("looks"), "id", "embedding",
    )
    key = ["cell", "part", "copy"]
    rows = lying.unionByName(looking).repartition(*key).sortWithinPartitions(*key, "looks", "id")
    unit = centres.unit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, ids, block = None, np.zeros(0, np.int64), None
        for batch in batches:
            names = np.stack([np.asarray(batch.column(c)) for c in key], axis=1)
            looks, own = np.asarray(batch.column("looks")), np.asarray(batch.column("id"), dtype=np.int64)
            matrix = to_matrix(batch.column("embedding"))
            matrix = unit_rows(matrix) if unit else matrix
            cuts = np.flatnonzero(np.r_[True, (names[1:] != names[:-1]).any(axis=1), True])
            for b, e in zip(cuts[:-1], cuts[1:]):
                if here != tuple(names[b]):
                    here, ids, block = tuple(names[b]), np.zeros(0, np.int64), matrix[:0]
                lie = b + int(np.searchsorted(looks[b:e], 1))
                ids, block = np.r_[ids, own[b:lie]], np.concatenate([block, matrix[b:lie]])
                for start in range(lie, e, 1024) if len(ids) else ():
                    stop = min(e, start + 1024)
                    yield _closest(own[start:stop], matrix[start:stop], ids, block, links)

    found = rows.mapInArrow(run, LINK).withColumn("fresh", F.lit(True))
    return write_table(_nearest_links(found, links), "graph-links")


def _closest(src: np.ndarray, rows: np.ndarray, ids: np.ndarray, block: np.ndarray, links: int) -> pa.RecordBatch:
    found = gaps(rows, block)
    found[src[:, None] == ids[None, :]] = np.inf
    keep = min(links, len(ids))
    best = np.argpartition(found, keep - 1, axis=1)[:, :keep]
    return _as_links(src[:, None], ids[best], np.take_along_axis(found, best, axis=1))


def _as_links(src: np.ndarray, dst: np.ndarray, gap: np.ndarray) -> pa.RecordBatch:
    real = np.isfinite(gap)
    src = np.broadcast_to(src, gap.shape)
    return pa.RecordBatch.from_arrays([pa.array(src[real]), pa.array(dst[real]), pa.array(gap[real])], names=["src", "dst", "gap"])


def _in_blocks(placed: DataFrame, dim: int) -> tuple[DataFrame, int]:
    """``id, embedding, block`` of all vectors, and the number of blocks: runs of cells of equal size. A cell that reaches
    into several is dealt among them by a hash of the id."""
    table = placed.groupBy("grp", "cell").agg(F.count("*").alias("n")).toArrow().sort_by([("grp", "ascending"), ("cell", "ascending")])
    ends = np.cumsum(np.asarray(table["n"], dtype=np.int64))
    size = max(1, min(math.ceil(int(ends[-1]) / BLOCKS), BLOCK_VALUES // max(1, dim)))
    first, last = np.r_[0, ends[:-1]] // size, (ends - 1) // size
    homes = pa.table({"cell": table["cell"], "first": pa.array(first.astype(np.int32)), "last": pa.array(last.astype(np.int32))})
    block = F.col("first") + F.pmod(F.xxhash64("id", F.lit("home")), F.col("last") - F.col("first") + 1).cast("int")
    homes = broadcast_if_small(placed.sparkSession.createDataFrame(homes))
    return placed.join(homes, "cell").select("id", "embedding", block.alias("block")), int(last[-1]) + 1


def _improved(vectors: DataFrame, blocks: int, links: DataFrame, unit: bool, keep: int, before: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """One round: what surrounds a vector is compared with each other, and every member keeps its nearest ones.

    Two that were both there a round ago have been compared, so a pair has one that is new, and groups without are left out.
    A row group is only ids. It goes to the block of its vector, and the vectors of all members go there once, however many groups
    of the block they are in; a block merges what it finds. ``before`` has the back links of the round before; this round's are returned too.
    """
    back = write_table(_back_links(links, keep), "graph-back")
    around = [links.select("src", "dst", F.col("fresh").alias("new"), F.lit(True).alias("now"))]
    around.append(back.select("src", "dst", F.lit(True).alias("new"), F.lit(True).alias("now")))
    around.append(vectors.select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(False).alias("new"), F.lit(True).alias("now")))
    if before is not None:
        around.append(before.select("src", "dst", F.lit(False).alias("new"), F.lit(False).alias("now")))
    each = reduce(DataFrame.unionByName, around).repartition("src").groupBy("src", "dst").agg(F.min("new").alias("new"), F.max("now").alias("now"))
    groups = each.filter("now").groupBy("src").agg(
        F.collect_list(F.when(F.col("new"), F.col("dst"))).alias("fresh"), F.collect_list(F.when(~F.col("new"), F.col("dst"))).alias("known")
    )
    homes = vectors.select(F.col("id").alias("src"), "block")
    groups = write_table(groups.filter(F.size("fresh") > 0).join(homes, "src").select("block", "fresh", "known"), "graph-groups")
    wanted = groups.select("block", F.explode(F.concat("fresh", "known")).alias("id")).distinct()
    far = links.groupBy("src").agg(F.max("gap").alias("far"), F.count("*").alias("n"))
    reach = F.when(F.col("n") >= keep, F.col("far")).otherwise(F.lit(float("inf")))
    members = vectors.drop("block").join(far, F.col("id") == F.col("src"), "left").select("id", "embedding", reach.alias("reach"))
    members = wanted.join(members, "id").select("block", "id", "embedding", "reach")
    rows = members.withColumn("rows", F.lit(0)).unionByName(groups.withColumn("rows", F.lit(1)), allowMissingColumns=True)
    rows = rows.repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "rows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, block = None, None
        for batch in batches:
            names, kinds = np.asarray(batch.column("block")), np.asarray(batch.column("rows"))
            cuts = np.flatnonzero(np.r_[True, (names[1:] != names[:-1]) | (kinds[1:] != kinds[:-1]), True])
            for begin, end in zip(cuts[:-1], cuts[1:]):
                if here != names[begin]:
                    if block:
                        yield block.result()
                    here, block = names[begin], _Block(unit, keep)
                part = batch.slice(begin, end - begin)
                if kinds[begin]:
                    block.compare(part.column("fresh"), part.column("known"))
                else:
                    block.parts.append(part.select(["id", "embedding", "reach"]))
        if block:
            yield block.result()

    found = rows.mapInArrow(run, LINK).withColumn("fresh", F.lit(True))
    known = links.select("src", "dst", "gap").withColumn("fresh", F.lit(False))
    return write_table(_nearest_links(known.unionByName(found), keep), "graph-links"), back


class _Block:
    """The vectors of a block, each once, and the nearest links found among them."""

    def __init__(self, unit: bool, keep: int):
        self.unit, self.keep, self.parts, self.ids = unit, keep, [], None
        self.found, self.waiting = [(np.zeros(0, np.int64), np.zeros(0))], 0

    def _ready(self) -> None:
        table = pa.Table.from_batches(self.parts)
        self.parts = []
        self.ids, at = np.unique(np.asarray(table["id"], dtype=np.int64), return_index=True)
        # As they came, at half the size of what is calculated with.
        lists = table["embedding"].combine_chunks()
        self.matrix = np.asarray(lists.flatten()).reshape(len(lists), -1)[at]
        self.reach = np.asarray(table["reach"], dtype=np.float64)[at]

    def compare(self, fresh: pa.Array, known: pa.Array) -> None:
        """All pairs of each row's ``fresh`` ones, and of these with its ``known`` ones."""
        if self.ids is None:
            self._ready()
        counts = [np.asarray(x.value_lengths(), dtype=np.int64) for x in (fresh, known)]
        begins = [np.cumsum(n) - n for n in counts]
        # One place more, for rows without.
        at = [np.r_[np.searchsorted(self.ids, np.asarray(x.flatten(), dtype=np.int64)), 0] for x in (fresh, known)]
        for first in range(0, len(fresh), 64):
            few, old = (n[first : first + 64, None] for n in counts)
            place = np.arange(int((few + old).max()))[None, :]
            new, there = place < few, place < few + old
            # Groups side by side, filled up with places that are nobody.
            left = np.where(new, begins[0][first : first + 64, None] + place, len(at[0]) - 1)
            right = np.where(there & ~new, begins[1][first : first + 64, None] + place - few, len(at[1]) - 1)
            names = np.where(new, at[0][left], at[1][right])
            rows = self.matrix[names].astype(np.float64)
            if self.unit:
                rows = unit_rows(rows.reshape(-1, rows.shape[2])).reshape(rows.shape)
            square = (rows**2).sum(axis=2)
            apart = np.maximum(square[:, :, None] + square[:, None, :] - 2 * rows @ rows.transpose(0, 2, 1), 0)
            useful = (new[:, :, None] & there[:, None, :]) | (there[:, :, None] & new[:, None, :])
            useful &= (apart < self.reach[names][:, :, None]) & ~np.eye(place.shape[1], dtype=bool)[None]
            g, i, j = np.nonzero(useful)
            self.found.append((names[g, i] * len(self.ids) + names[g, j], apart[g, i, j]))
            self.waiting += len(g)
            if self.waiting > max(WAITING, len(self.found[0][0]) // 2):
                self._merge()

    def _merge(self) -> None:
        """Keep the nearest distinct ones; what is further than these is not looked at any more."""
        pairs, gap = (np.concatenate(x) for x in zip(*self.found))
        pairs, at = np.unique(pairs, return_index=True)
        gap = gap[at]
        src, dst = np.divmod(pairs, max(1, len(self.ids)))
        order = np.lexsort((self.ids[dst], gap, src))
        pairs, gap, src = pairs[order], gap[order], src[order]
        first = np.searchsorted(src, src)
        place = np.arange(len(src)) - first
        full = place == self.keep - 1
        # Ties at the last place are still compared by id.
        self.reach[src[full]] = np.minimum(self.reach[src[full]], np.nextafter(gap[full], np.inf))
        kept = place < self.keep
        self.found, self.waiting = [(pairs[kept], gap[kept])], 0

    def result(self) -> pa.RecordBatch:
        if self.ids is None:
            self._ready()
        self._merge()
        pairs, gap = self.found[0]
        src, dst = np.divmod(pairs, max(1, len(self.ids)))
        return _as_links(self.ids[src], self.ids[dst], gap)


def _back_links(links: DataFrame, keep: int) -> DataFrame:
    """``src, dst`` of the ``keep`` nearest vectors that link to each one."""
    turned = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "gap")
    return top_k_per_group(turned, ["src"], [F.col("gap"), F.col("dst")], keep).select("src", "dst")


@dataclass
class StoredGraph:
    """Vectors with their links under ``path``, beside the cells that a search begins in."""

    cells: StoredCells
    path: str

    @property
    def nodes(self) -> DataFrame:
        """``id, embedding, cell, links, grp``; a link is the ``id`` and ``cell`` of another vector."""
        return self.cells.spark.read.parquet(f"{self.path}/nodes")

    def links(self) -> DataFrame:
        """``src, dst`` of all stored links."""
        return self.nodes.select(F.col("id").alias("src"), F.explode("links.id").alias("dst"))

    def _named(self, wanted: DataFrame) -> DataFrame:
        """The nodes of the cells in ``wanted``, by literals; the driver sees at most the names of all cells."""
        named = sorted(r["cell"] for r in wanted.select("cell").distinct().collect())
        rows = self.nodes.filter(F.col("grp").isin(sorted({c // GROUP_CELLS for c in named})))
        rows = rows.filter(F.col("cell").between(named[0], named[-1]))
        return rows.filter(F.col("cell").isin(named)) if len(named) <= NAMED_CELLS else rows

    def search(self, queries: DataFrame, k: int = 10, ef: int = 64) -> DataFrame:
        """``query_id, id, distance, rank`` of the best ``k`` that a beam of ``ef`` rows meets; a wider beam is more recall.

        A beam begins with the vectors of the closest cells. Each round reads what its new rows link to, for all
        queries at once, and a query is done when its beam has no new row. Queries are a table throughout:
        few are sent to the scan, many are joined with it.
        """
        check_limit(k, "k")
        ef = max(check_limit(ef, "ef"), k)
        metric = self.cells.metric
        asked = materialize(queries.filter(F.col("embedding").isNotNull()).select(F.col("query_id").cast("long"), "embedding"))
        centres = _read_centres(self.cells.cells, self.cells.unit)
        if not len(centres.cells) or asked.isEmpty():
            return empty_hits(queries)
        wanted, keys = materialize(_to_cells(asked, centres, ENTRY_CELLS, "query_id").select("query_id", "cell")), ["cell"]
        few = fits(asked)
        asked = asked.withColumnRenamed("embedding", "__query")
        nearest = [F.col("distance"), F.col("id")]
        beam = None
        while True:
            # Links stay behind: only the vectors that come into a beam are asked for theirs.
            rows = self._named(wanted).select("id", "embedding", "cell").join(broadcast_if_small(wanted), keys)
            rows = rows.join(F.broadcast(asked) if few else asked, "query_id")
            met = rows.withColumn("distance", F.round(distance("embedding", "__query", metric), TIE_DECIMALS)).filter(F.col("distance").isNotNull())
            if beam is not None:
                last = beam.filter(F.col("rank") == ef).select("query_id", F.col("distance").alias("__last"))
                met = met.join(F.broadcast(last) if few else last, "query_id", "left")
                met = met.filter(F.col("__last").isNull() | (F.col("distance") <= F.col("__last")))
            met = met.select("query_id", "id", "cell", "distance", F.lit(True).alias("new"))
            both = met if beam is None else met.unionByName(beam.drop("rank").withColumn("new", F.lit(False)))
            beam = materialize(top_k_per_group(both, ["query_id"], nearest, ef))
            wanted, keys = materialize(self._linked(beam)), ["cell", "id"]
            if wanted.isEmpty():
                return top_k_per_group(beam.select("query_id", "id", "distance"), ["query_id"], nearest, k)

    def _linked(self, beam: DataFrame) -> DataFrame:
        """``query_id, id, cell`` of what the new rows of the beams link to and is in none.

        What a beam has met and lost is further than its last row, which only comes nearer: it may be met again, but not come
        in, so no list of all that a query has seen is kept or moved.
        """
        new = materialize(beam.filter("new").select("query_id", "id", "cell"))
        if new.isEmpty():
            return new
        found = self._named(new).select("id", "cell", F.col("links").alias("__links")).join(broadcast_if_small(new), ["cell", "id"])
        found = found.select("query_id", F.explode("__links").alias("link")).select("query_id", "link.id", "link.cell", F.lit(False).alias("there"))
        found = found.unionByName(beam.select("query_id", "id", "cell", F.lit(True).alias("there")))
        # One shuffle for distinct rows and for those that are there.
        found = found.groupBy("query_id", "id").agg(F.min("cell").alias("cell"), F.max("there").alias("there"))
        return found.filter(~F.col("there")).drop("there")


def build_graph(vectors: DataFrame, path: str, metric: str = "cosine", links: int = LINKS, rounds: int = ROUNDS) -> StoredGraph:
    """Link every ``(id, embedding)`` row to about its ``links`` nearest and store the graph under ``path``.

    For the metrics cosine and l2; ids are unique. Rows without a vector are left out, equal vectors may be any number: they link to
    each other first, so a search comes to the rest through its entry cells. Rounds end early when few links change.
    """
    metric = check_metric(metric)
    if metric not in ("cosine", "l2"):
        raise ValueError("a graph is for cosine and l2")
    check_limit(links, "links")
    stored = build_index(vectors, f"{path}/cells", metric)
    centres = _read_centres(stored.cells, stored.unit)
    spark = vectors.sparkSession
    kind = vectors.schema["embedding"].dataType.simpleString()
    link_type = "array<struct<id: bigint, cell: int>>"
    graph = StoredGraph(stored, path)
    if not len(centres.cells):
        spark.createDataFrame([], f"id long, embedding {kind}, cell int, links {link_type}, grp int").write.mode("overwrite").parquet(f"{path}/nodes")
        return graph
    placed = write_table(_assigned(usable(vectors), centres).select("id", "embedding", "cell", "grp"), "graph-vectors")
    pool = round(POOL * links)
    found = _first_links(placed, centres, pool)
    homes, blocks = _in_blocks(placed, centres.matrix.shape[1])
    back = None
    for _ in range(rounds):
        found, back = _improved(homes, blocks, found, stored.unit, pool, back)
        changed = found.agg(F.avg(F.col("fresh").cast("int"))).first()[0]
        if not changed or changed < SETTLED:
            break
    found = top_k_per_group(found, ["src"], [F.col("gap"), F.col("dst")], links)
    both = found.select("src", "dst").unionByName(_back_links(found, links)).distinct()
    named = both.join(placed.select(F.col("id").alias("dst"), "cell"), "dst")
    # At most twice ``links`` of each vector.
    listed = named.groupBy("src").agg(F.sort_array(F.collect_list(F.struct(F.col("dst").alias("id"), "cell"))).alias("links"))
    nodes = placed.join(listed, F.col("id") == F.col("src"), "left").drop("src")
    nodes = nodes.withColumn("links", F.coalesce("links", F.array().cast(link_type)))
    nodes = nodes.repartitionByRange("grp", "cell", "id").sortWithinPartitions("grp", "cell", "id")
    nodes.write.mode("overwrite").partitionBy("grp").parquet(f"{path}/nodes")
    return graph
