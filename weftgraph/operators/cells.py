"""Approximate nearest neighbours from a stored index: k-means cells in groups, read by literal cell predicates.

The centres of two levels are fitted on a bounded sample, and every vector is put into its nearest cell. The vectors lie
in one folder per group, sorted by cell; a small table lists the cells with their centre, radius, size and the
generations of files they are in. A search picks cells from that table and names their folders, so
the files of other groups are never opened.

New vectors go to their cells as another generation of files. A cell that has grown too large is split, and
its group written anew; files of earlier versions stay as they are, for searches that still read them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.functions.distance import check_metric
from weftgraph.functions.nearest import Nearest, to_matrix
from weftgraph.operators.vector import BROADCAST_VALUES, HITS, append_vectors, collect_queries, empty_hits, knn, usable
from weftgraph.plans.materialize import materialize
from weftgraph.plans.ordering import check_limit, top_k_per_group
from weftgraph.plans.sizing import broadcast_if_small

#: Rows that the centres are fitted on at most, chosen by a hash of their id. Every row is put into a cell.
FIT_ROWS = 200_000
#: Rows of the fitted sample per cell. Small cells follow the data closely, so few rows are read for much recall.
ROWS_PER_CELL = 4
#: A cell that holds so many times the mean when vectors are added is split.
OVERFULL = 8
#: Groups of which a new vector looks at all cells.
NEAR_GROUPS = 3
#: Cells numbered within a group.
GROUP_CELLS = 2**20
#: (query, cell) pairs sent to every task; beyond, a task finds out which of its cells a query reads.
BROADCAST_PAIRS = 4_000_000
#: Queries whose cells are ranked by one task.
LIMIT_QUERIES = 250
#: Rows of a cell, and queries of a cell, that meet in one task of that shuffle.
BLOCK_ROWS, BLOCK_QUERIES = 50_000, 4_000

CELL = "grp int, cell int, centre array<float>"


def unit_rows(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


def gaps(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all rows and centres."""
    found = (rows**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)[None, :] - 2 * rows @ centres.T
    return np.maximum(found, 0)


def lloyd(rows: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Centres of at most ``k`` clusters; equal rows are one, and clusters that lose all rows are left out."""
    distinct = np.unique(rows, axis=0)
    if len(distinct) <= k:
        return distinct
    centres = distinct[np.random.default_rng(seed).choice(len(distinct), k, replace=False)]
    for _ in range(rounds):
        nearest = np.concatenate([gaps(rows[i : i + 4096], centres).argmin(axis=1) for i in range(0, len(rows), 4096)])
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        centres = sums[counts > 0] / counts[counts > 0][:, None]
    return centres


@dataclass(frozen=True)
class Centres:
    """All cells, sorted by group: bounded by the sample they were fitted on, not by the vectors."""

    groups: np.ndarray
    cells: np.ndarray
    matrix: np.ndarray
    unit: bool

    def place(self, rows: np.ndarray) -> np.ndarray:
        return unit_rows(rows) if self.unit else rows

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position of the cell of each row, looked for in the nearest groups, and the distance of its centre."""
        rows = self.place(rows)
        names, begins = np.unique(self.groups, return_index=True)
        ends = np.append(begins[1:], len(self.groups))
        middle = np.add.reduceat(self.matrix, begins) / (ends - begins)[:, None]
        near = np.argsort(gaps(rows, middle), axis=1, kind="stable")[:, :NEAR_GROUPS]
        best, gap = np.zeros(len(rows), np.int64), np.full(len(rows), np.inf)
        for column in near.T:
            for g in np.unique(column):
                own = np.flatnonzero(column == g)
                found = gaps(rows[own], self.matrix[begins[g] : ends[g]])
                at = found.argmin(axis=1)
                value = found[np.arange(len(own)), at]
                better = value < gap[own]
                best[own[better]], gap[own[better]] = begins[g] + at[better], value[better]
        return best, np.sqrt(gap)


def _few(found: Iterator[np.ndarray]) -> list[np.ndarray] | None:
    """All that is found, or None as soon as it is more pairs than go to every task."""
    kept, pairs = [], 0
    for own in found:
        pairs += len(own)
        if pairs > BROADCAST_PAIRS:
            return None
        kept.append(own.copy())
    return kept


def _sample(rows: DataFrame, share: float) -> DataFrame:
    """About ``share`` of the rows, the same ones each time."""
    return rows if share >= 1 else rows.filter(F.pmod(F.xxhash64("id", F.lit("fit")), F.lit(1 << 30)) < int(share * (1 << 30)))


def _fit(vectors: DataFrame, unit: bool, per_cell: int, fit_rows: int, seed: int) -> DataFrame:
    """``grp, cell, centre``: k-means of the sample into groups, and of each group's part into cells."""
    n = vectors.count()
    sample = materialize(_sample(vectors, fit_rows / max(1, n)))
    used = sample.count()
    cells = max(1, used // per_cell)
    groups = max(1, round(math.sqrt(cells)))
    kind = sample.schema["embedding"].dataType.simpleString()

    def lengthen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = unit_rows(to_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(rows)).cast(batch.schema.field(1).type)], names=["id", "embedding"])

    if unit:
        sample = materialize(sample.mapInArrow(lengthen, f"id long, embedding {kind}"))
    featured = sample.withColumn("__features", array_to_vector(F.col("embedding").cast("array<double>")))
    model = KMeans(k=groups, seed=seed, maxIter=10, featuresCol="__features", predictionCol="grp").fit(featured) if groups > 1 else None
    grouped = model.transform(featured).drop("__features") if model else sample.withColumn("grp", F.lit(0))
    # A group of most rows is cut no finer than this; its cells are larger.
    most = 8 * groups

    def refine(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")
        k = min(most, max(1, round(cells * rows.num_rows / used)))
        centres = lloyd(to_matrix(rows["embedding"]), k, 10, seed)
        group = int(rows["grp"][0].as_py())
        return pa.table(
            {
                "grp": pa.array([group] * len(centres), pa.int32()),
                "cell": pa.array(group * GROUP_CELLS + np.arange(len(centres)), pa.int32()),
                "centre": pa.array(list(centres.astype(np.float32)), pa.list_(pa.float32())),
            }
        )

    return materialize(grouped.select("id", "embedding", "grp").groupBy("grp").applyInArrow(refine, CELL))


def _read_centres(cells: DataFrame, unit: bool) -> Centres:
    table = cells.select("grp", "cell", "centre").toArrow().sort_by([("grp", "ascending"), ("cell", "ascending")])
    return Centres(np.asarray(table["grp"]), np.asarray(table["cell"]), to_matrix(table["centre"]), unit)


def _assigned(vectors: DataFrame, centres: Centres) -> DataFrame:
    """``id, embedding, cell, gap, grp`` of every vector, where it lies."""
    kind = vectors.schema["embedding"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                part = batch.slice(begin, 4096)
                at, gap = centres.nearest(to_matrix(part.column(1), centres.matrix.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(centres.cells[at], pa.int32()), pa.array(gap), pa.array(centres.groups[at], pa.int32())],
                    names=["id", "embedding", "cell", "gap", "grp"],
                )

    return vectors.mapInArrow(run, f"id long, embedding {kind}, cell int, gap double, grp int")


def _write_vectors(assigned: DataFrame, path: str, gen: int) -> None:
    """One folder per group; ranges are cut on group, cell and id, so a cell of most rows is many files."""
    rows = assigned.repartitionByRange("grp", "cell", "id").sortWithinPartitions("grp", "cell")
    rows.withColumn("gen", F.lit(gen)).write.mode("append").partitionBy("gen", "grp").parquet(f"{path}/vectors")


def _measured(vectors: DataFrame) -> DataFrame:
    return vectors.groupBy("cell").agg(F.count("*").alias("size"), F.max("gap").alias("radius"))


@dataclass
class StoredCells:
    """A version of an index under ``path``. Searches and appends make no change to it."""

    spark: SparkSession
    path: str
    metric: str
    version: int

    @property
    def unit(self) -> bool:
        return self.metric == "cosine"

    @property
    def cells(self) -> DataFrame:
        """``grp, cell, centre, size, radius, gens`` of every cell."""
        return self.spark.read.parquet(f"{self.path}/cells").filter(F.col("version") == self.version).drop("version")

    def vectors(self, wanted: dict[int, set[int]] | None = None) -> DataFrame:
        """``id, embedding, cell, gap, grp`` of the given groups and cells, by literals on the folders; of all without."""
        rows = self.spark.read.parquet(f"{self.path}/vectors")
        listed = self.cells.groupBy("grp").agg(F.first("gens").alias("gens")).collect()  # one row per group
        by_gens: dict[tuple, list[int]] = {}
        for r in listed:
            if wanted is None or r.grp in wanted:
                by_gens.setdefault(tuple(sorted(r.gens)), []).append(r.grp)
        tests = [F.col("gen").isin(list(gens)) & F.col("grp").isin(sorted(grps)) for gens, grps in sorted(by_gens.items())]
        rows = rows.filter(reduce(lambda a, b: a | b, tests, F.lit(False)))
        if wanted is not None:
            named = sorted(set().union(*wanted.values())) if wanted else []
            rows = rows.filter(F.col("cell").between(min(named, default=0), max(named, default=-1)))
            if len(named) <= 500:
                rows = rows.filter(F.col("cell").isin(named))
        return rows.drop("gen")

    def search(
        self, queries: DataFrame, k: int = 10, share: float = 0.15, nprobe: int | None = None, exact: bool = False,
        max_broadcast_values: int = BROADCAST_VALUES,
    ) -> DataFrame:
        """``query_id, id, distance, rank`` from the cells closest to each query.

        ``nprobe`` says how many cells, else as many as hold ``share`` of the vectors; more of either is
        more recall. ``exact`` reads all cells that can hold one of the ``k`` nearest, by centre and radius, for the
        metrics cosine and l2. Queries beyond the bound meet their cells by a shuffle, or the whole table if ``exact``;
        within it the vectors stay where they are, however many cells each query reads.
        """
        check_limit(k, "k")
        if nprobe is not None:
            check_limit(nprobe, "nprobe")
        if exact and self.metric not in ("cosine", "l2"):
            raise ValueError("exact search is for cosine and l2")
        bounded = collect_queries(queries, max_broadcast_values)
        if bounded is not None and len(bounded[0]) == 0:
            return empty_hits(queries)
        table = self.cells.select("grp", "cell", "centre", "size", "radius").toArrow().sort_by("cell")
        if not table.num_rows:
            return empty_hits(queries)
        centres = _read_centres(self.cells, self.unit)
        known = {int(c): i for i, c in enumerate(table["cell"].to_pylist())}
        order = np.array([known[int(c)] for c in centres.cells], np.int64)
        sizes, radius = (np.asarray(table[c])[order] for c in ("size", "radius"))

        unit, step = self.unit, max(1, min(256, BROADCAST_PAIRS // len(centres.cells)))

        def ranked(rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
            """Positions of the cells from the nearest on, how far they are, and how many are read, for each query."""
            for begin in range(0, len(rows), step):
                apart = gaps(centres.place(rows[begin : begin + step]), centres.matrix)
                for own, far in zip(np.argsort(apart, axis=1, kind="stable"), apart):
                    if nprobe is not None:
                        yield own, far, min(nprobe, len(own))
                    else:
                        held = np.cumsum(sizes[own])
                        # The cell that passes the share is left out, so no more than the share is read; one cell at least.
                        yield own, far, max(1, int(np.searchsorted(held, share * held[-1], "right")))

        def closest(rows: np.ndarray) -> Iterator[np.ndarray]:
            """Positions of the cells to read, for each query."""
            return (own[:count] for own, _, count in ranked(rows))

        if bounded is None:
            if exact:
                return knn(self.vectors().select("id", "embedding"), queries, k, self.metric, max_broadcast_values)
            return self._shuffled(centres, queries, k, closest)
        query_ids, matrix = bounded
        chosen = _few(closest(matrix))
        if chosen is not None:
            found = self._scan(centres, query_ids, matrix, chosen, k)
        else:
            limit = self._limits(queries, query_ids, ranked)
            found = self._scan_within(query_ids, matrix, k, centres, lambda at, apart, block: apart <= limit[block])
        if not exact:
            return found
        last = found.groupBy("query_id").agg(F.max("distance").alias("far"), F.count("*").alias("n")).collect()  # a row per query
        far = {r.query_id: r.far for r in last if r.n == k}
        reach = np.array([far.get(int(q), np.inf) for q in query_ids])
        reach = np.sqrt(2 * np.maximum(reach, 0)) if unit else reach

        def reached(rows: np.ndarray) -> Iterator[np.ndarray]:
            for begin in range(0, len(rows), step):
                apart = np.sqrt(gaps(centres.place(rows[begin : begin + step]), centres.matrix))
                # Distances are rounded, so cells that only touch the reach are read as well.
                yield from (np.flatnonzero(a - radius <= r + 1e-4) for a, r in zip(apart, reach[begin : begin + step]))

        chosen = _few(reached(matrix))
        if chosen is not None:
            return self._scan(centres, query_ids, matrix, chosen, k)
        return self._scan_within(
            query_ids, matrix, k, centres, lambda at, apart, block: np.sqrt(apart) - radius[at][:, None] <= reach[block] + 1e-4
        )

    def _limits(self, queries: DataFrame, query_ids: np.ndarray, ranked: Callable) -> np.ndarray:
        """How far from each query the cells lie that it reads: a number per query, found where the queries lie."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                limit = [
                    (far[own[count - 1]] + far[own[count]]) / 2 if count < len(own) else np.inf
                    for own, far, count in ranked(to_matrix(batch.column("embedding")))
                ]
                yield pa.RecordBatch.from_arrays([batch.column("query_id"), pa.array(limit, pa.float64())], names=["query_id", "reach"])

        asked = queries.filter(F.col("embedding").isNotNull()).select(F.col("query_id").cast("long"), "embedding")
        asked = asked.repartition(max(1, len(query_ids) // LIMIT_QUERIES))
        # Of an id that repeats the wider limit holds.
        found = asked.mapInArrow(run, "query_id long, reach double").groupBy("query_id").agg(F.max("reach").alias("reach")).toArrow()
        found = found.sort_by("query_id")
        return np.asarray(found["reach"])[np.searchsorted(np.asarray(found["query_id"]), query_ids)]

    def _scan_within(self, query_ids: np.ndarray, matrix: np.ndarray, k: int, centres: Centres, inside: Callable) -> DataFrame:
        """For more pairs of query and cell than are listed: every task has all queries and tells from its cells' centres which they read.

        ``inside`` gets positions of cells, how far they are from the queries of a block, and the positions of these queries.
        """
        metric, placed = self.metric, centres.place(matrix)
        order = np.argsort(centres.cells, kind="stable")
        names = centres.cells[order]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = Nearest(matrix, k, metric)
            for batch in batches:
                here, row = np.unique(np.asarray(batch.column("cell")), return_inverse=True)
                at = order[np.searchsorted(names, here)]

                def read(block: np.ndarray) -> np.ndarray:
                    return inside(at, gaps(centres.matrix[at], placed[block]), block)[row]

                best.add(np.asarray(batch.column("id"), dtype=np.int64), to_matrix(batch.column("embedding"), matrix.shape[1]), read=read)
            yield best.result(query_ids)

        partial = self.vectors().select("id", "embedding", "cell").mapInArrow(run, HITS)
        return top_k_per_group(partial, ["query_id"], [F.col("distance"), F.col("id")], k)

    def _scan(self, centres: Centres, query_ids: np.ndarray, matrix: np.ndarray, chosen: list[np.ndarray], k: int) -> DataFrame:
        """The cells are read where they lie; each task keeps ``k`` rows per query."""
        cell = centres.cells[np.concatenate(chosen)] if chosen else np.zeros(0, np.int64)
        asking = np.repeat(np.arange(len(chosen)), [len(c) for c in chosen])
        order = np.argsort(cell, kind="stable")
        names, begins = np.unique(cell[order], return_index=True)
        bounds, asking = np.append(begins, len(cell)), asking[order]
        groups = dict(zip(centres.cells.tolist(), centres.groups.tolist()))
        wanted: dict[int, set[int]] = {}
        for c in names.tolist():
            wanted.setdefault(groups[c], set()).add(c)
        metric = self.metric

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = Nearest(matrix, k, metric)
            for batch in batches:
                here = np.asarray(batch.column("cell"))
                at = np.searchsorted(names, here)
                at[at == len(names)] = 0
                inside = np.flatnonzero(names[at] == here)
                inside = inside[np.argsort(here[inside], kind="stable")]
                if not len(inside):
                    continue
                rows = to_matrix(batch.column("embedding").take(pa.array(inside)), matrix.shape[1])
                ids = np.asarray(batch.column("id"), dtype=np.int64)[inside]
                cuts = np.flatnonzero(np.r_[True, here[inside][1:] != here[inside][:-1], True])
                for b, e in zip(cuts[:-1], cuts[1:]):
                    place = at[inside[b]]
                    best.add(ids[b:e], rows[b:e], asking[bounds[place] : bounds[place + 1]])
            yield best.result(query_ids)

        partial = self.vectors(wanted).select("id", "embedding", "cell").mapInArrow(run, HITS)
        return top_k_per_group(partial, ["query_id"], [F.col("distance"), F.col("id")], k)

    def _shuffled(self, centres: Centres, queries: DataFrame, k: int, closest: Callable) -> DataFrame:
        """Queries are sent to their cells; a cell of many rows, or of many queries, is cut into blocks."""
        metric, dim = self.metric, centres.matrix.shape[1]

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = list(closest(to_matrix(batch.column("embedding"), dim)))
                times = np.repeat(np.arange(batch.num_rows), [len(c) for c in own])
                cell = centres.cells[np.concatenate(own)] if own else np.zeros(0, np.int64)
                for begin in range(0, len(times), 50_000):
                    end = begin + 50_000
                    yield batch.take(pa.array(times[begin:end])).append_column("cell", pa.array(cell[begin:end], pa.int32()))

        asked = queries.filter(F.col("embedding").isNotNull()).select(F.col("query_id").cast("long"), "embedding")
        kind = asked.schema["embedding"].dataType.simpleString()
        asked = materialize(asked.mapInArrow(send, f"query_id long, embedding {kind}, cell int"))
        load = asked.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("qs"))
        parts = self.cells.select("cell", F.greatest(F.lit(1), F.ceil(F.col("size") / BLOCK_ROWS)).cast("int").alias("vs"))
        blocks = broadcast_if_small(materialize(parts.join(load, "cell")))
        rows = (
            self.vectors().select("id", "embedding", "cell").join(blocks, "cell")
            .withColumn("vb", F.pmod(F.xxhash64("id"), F.col("vs")).cast("int"))
            .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("qs") - 1)))
        )
        asked = (
            asked.join(blocks, "cell")
            .withColumn("qb", F.pmod(F.xxhash64("query_id"), F.col("qs")).cast("int"))
            .withColumn("vb", F.explode(F.sequence(F.lit(0), F.col("vs") - 1)))
        )

        def meet(rows: pa.Table, asked: pa.Table) -> pa.Table:
            matrix = to_matrix(asked["embedding"])
            best = Nearest(matrix, k, metric)
            if asked.num_rows and rows.num_rows:
                best.add(np.asarray(rows["id"], dtype=np.int64), to_matrix(rows["embedding"], matrix.shape[1]))
            return pa.Table.from_batches([best.result(np.asarray(asked["query_id"], dtype=np.int64))])

        keys = ["cell", "vb", "qb"]
        left = rows.select("id", "embedding", *keys).groupBy(*keys)
        partial = left.cogroup(asked.select("query_id", "embedding", *keys).groupBy(*keys)).applyInArrow(meet, HITS)
        return top_k_per_group(partial, ["query_id"], [F.col("distance"), F.col("id")], k)

    def append(self, batches: DataFrame, order: list[str], batch_col: str = "batch") -> tuple["StoredCells", DataFrame]:
        """The index with more vectors, and ``batch, start, end`` of the ids they got, counted on from the largest.

        ``batches`` has ``embedding``, ``batch_col`` and the columns of ``order``. Each vector goes to its nearest cell;
        cells that hold over ``OVERFULL`` times the mean afterwards are split.
        """
        numbered, ranges = append_vectors(self.vectors().select("id"), batches.filter("embedding IS NOT NULL"), order, batch_col)
        return self.add(numbered.select("id", "embedding")), ranges

    def add(self, vectors: DataFrame) -> "StoredCells":
        """The index with more ``(id, embedding)`` rows under ids of their own. Only the latest version can grow."""
        if open_index(self.spark, self.path, self.metric).version != self.version:
            raise ValueError("vectors were added to this index since; open its latest version")
        gen = self.version + 1
        cells = self.cells
        new = materialize(_assigned(usable(vectors), _read_centres(cells, self.unit)))
        _write_vectors(new, self.path, gen)
        added = _measured(new).toDF("cell", "more", "reach")
        grown = cells.join(added, "cell", "left").select(
            "grp", "cell", "centre", (F.col("size") + F.coalesce("more", F.lit(0))).alias("size"),
            F.greatest("radius", F.coalesce("reach", F.lit(0.0))).alias("radius"), "gens",
        )
        touched = [r.grp for r in new.select("grp").distinct().collect()]  # groups, not vectors
        gens = F.when(F.col("grp").isin(touched), F.array_append("gens", F.lit(gen))).otherwise(F.col("gens"))
        _write_cells(grown.withColumn("gens", gens), self.path, gen)
        return StoredCells(self.spark, self.path, self.metric, gen)._split()

    def _split(self) -> "StoredCells":
        """Cells that hold too much become several; groups without such a cell stay where they are."""
        cells = materialize(self.cells)
        mean = cells.agg(F.avg("size")).first()[0] or 1.0
        # As many as there are cells at most, and these are bounded by the fitted sample and what was split since.
        over = cells.filter(F.col("size") > OVERFULL * max(mean, 1.0)).select("grp", "cell", "size").collect()
        if not over:
            return self
        gen = self.version + 1
        wanted: dict[int, set[int]] = {}
        for r in over:
            wanted.setdefault(r.grp, set()).add(r.cell)
        full = self.vectors(wanted).filter(F.col("cell").isin([r.cell for r in over]))
        share = F.coalesce(*[F.when(F.col("cell") == r.cell, F.lit(min(1.0, FIT_ROWS / len(over) / r["size"]))) for r in over])
        sample = full.filter(F.pmod(F.xxhash64("id", F.lit("split")), F.lit(1 << 30)) < share * (1 << 30))
        parts = {r.cell: max(2, math.ceil(r["size"] / mean)) for r in over}
        unit = self.unit

        def cut(rows: pa.Table) -> pa.Table:
            rows = rows.sort_by("id")
            cell, group = int(rows["cell"][0].as_py()), int(rows["grp"][0].as_py())
            matrix = to_matrix(rows["embedding"])
            centres = lloyd(unit_rows(matrix) if unit else matrix, min(parts[cell], max(1, rows.num_rows // 2)), 10, cell)
            return pa.table(
                {
                    "grp": pa.array([group] * len(centres), pa.int32()), "cell": pa.array([cell] * len(centres), pa.int32()),
                    "centre": pa.array(list(centres.astype(np.float32)), pa.list_(pa.float32())),
                }
            )

        fresh = sample.select("id", "embedding", "cell", "grp").groupBy("grp", "cell").applyInArrow(cut, CELL).toArrow()
        # A cell of equal vectors cannot be split and stays.
        cells_cut = np.asarray(fresh["cell"])
        fresh = fresh.filter(pa.array(np.isin(cells_cut, [c for c, n in zip(*np.unique(cells_cut, return_counts=True)) if n > 1])))
        if not fresh.num_rows:
            return self
        # New cells are numbered behind the largest of their group; the old cell is given up.
        largest = {r.grp: r.last for r in cells.groupBy("grp").agg(F.max("cell").alias("last")).collect()}
        old, grp, number = np.asarray(fresh["cell"]), np.asarray(fresh["grp"]), []
        for g in grp.tolist():
            largest[g] += 1
            number.append(largest[g])
        within = Centres(old, np.array(number, np.int64), to_matrix(fresh["centre"]), unit)
        by_cell = {int(c): np.flatnonzero(old == c) for c in np.unique(old)}
        kind = full.schema["embedding"].dataType.simpleString()

        def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cell = np.asarray(batch.column("cell")).copy()
                gap = np.asarray(batch.column("gap")).copy()
                rows = within.place(to_matrix(batch.column("embedding")))
                for c in np.intersect1d(np.unique(cell), list(by_cell)):
                    own = np.flatnonzero(cell == c)
                    found = gaps(rows[own], within.matrix[by_cell[int(c)]])
                    at = found.argmin(axis=1)
                    cell[own], gap[own] = within.cells[by_cell[int(c)][at]], np.sqrt(found[np.arange(len(own)), at])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("embedding"), pa.array(cell, pa.int32()), pa.array(gap), batch.column("grp")],
                    names=["id", "embedding", "cell", "gap", "grp"],
                )

        names, gone = sorted(set(grp.tolist())), sorted(by_cell)
        whole = self.vectors().filter(F.col("grp").isin(names)).select("id", "embedding", "cell", "gap", "grp")
        moved = materialize(whole.mapInArrow(move, f"id long, embedding {kind}, cell int, gap double, grp int"))
        _write_vectors(moved, self.path, gen)
        added = self.spark.createDataFrame(
            list(zip(grp.tolist(), number, [row.tolist() for row in within.matrix])), CELL
        )
        kept = cells.select("grp", "cell", "centre").filter(~F.col("cell").isin(gone)).unionByName(added)
        sized = kept.filter(F.col("grp").isin(names)).join(_measured(moved), "cell", "left").select(
            "grp", "cell", "centre", F.coalesce("size", F.lit(0)).alias("size"), F.coalesce("radius", F.lit(0.0)).alias("radius"),
            F.array(F.lit(gen)).alias("gens"),
        )
        _write_cells(cells.filter(~F.col("grp").isin(names)).unionByName(sized), self.path, gen)
        return StoredCells(self.spark, self.path, self.metric, gen)


def _write_cells(cells: DataFrame, path: str, version: int) -> None:
    rows = cells.select("grp", "cell", "centre", F.col("size").cast("long"), "radius", "gens")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/cells/version={version}")


def build_index(
    vectors: DataFrame, path: str, metric: str = "cosine", per_cell: int = ROWS_PER_CELL, fit_rows: int = FIT_ROWS, seed: int = 42
) -> StoredCells:
    """Fit cells, put every vector into its cell and store them under ``path``, a folder of its own.

    Rows without a vector are left out. At most ``fit_rows`` rows are fitted on, one cell for ``per_cell`` of them; an index of
    nothing has no cell and gives no hits.
    """
    metric = check_metric(metric)
    check_limit(per_cell, "per_cell")
    spark = vectors.sparkSession
    rows = usable(vectors)
    unit = metric == "cosine"
    cells = _fit(rows, unit, per_cell, check_limit(fit_rows, "fit_rows"), seed)
    centres = _read_centres(cells, unit)
    assigned = materialize(_assigned(rows, centres))
    _write_vectors(assigned, path, 0)
    sized = cells.join(_measured(assigned), "cell", "left").select(
        "grp", "cell", "centre", F.coalesce("size", F.lit(0)).alias("size"), F.coalesce("radius", F.lit(0.0)).alias("radius"),
        F.array(F.lit(0)).alias("gens"),
    )
    _write_cells(sized, path, 0)
    return StoredCells(spark, path, metric, 0)


def open_index(spark: SparkSession, path: str, metric: str) -> StoredCells:
    """The latest version under ``path``."""
    version = spark.read.parquet(f"{path}/cells").agg(F.max("version")).first()[0]
    return StoredCells(spark, path, check_metric(metric), int(version))
