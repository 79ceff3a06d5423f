"""Nearest neighbours of a block of vectors: the numpy helper that runs inside tasks.

Spark decides which vectors and which queries meet in a task; this module only keeps the
``k`` best rows per query of what it is handed.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

#: Distances equal to this many decimals are ties and go to the smaller id.
TIE_DECIMALS = 12
#: Queries compared at once; keeps the distance block small whatever the query count.
QUERY_BLOCK = 256


def to_matrix(column: pa.Array | pa.ChunkedArray, dim: int | None = None) -> np.ndarray:
    """List column to a float64 matrix; rows of another dimension are an error."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(column.value_lengths())
    if len(lengths) == 0:
        return np.empty((0, dim or 0))
    dim = int(lengths[0]) if dim is None else dim
    if not (lengths == dim).all():
        raise ValueError(f"vector dimension {int(lengths[lengths != dim][0])} does not match {dim}")
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(lengths), dim)


def pair_distances(rows: np.ndarray, queries: np.ndarray, metric: str) -> np.ndarray:
    """Distances of row ``i`` of both matrices, by direct differences."""
    if metric == "l2":
        return np.sqrt(((rows - queries) ** 2).sum(axis=1))
    if metric == "l1":
        return np.abs(rows - queries).sum(axis=1)
    products = (rows * queries).sum(axis=1)
    if metric == "dot":
        return -products
    lengths = np.sqrt((rows**2).sum(axis=1)) * np.sqrt((queries**2).sum(axis=1))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(lengths > 0, 1 - products / lengths, np.inf)


def _block(rows: np.ndarray, queries: np.ndarray, metric: str) -> np.ndarray:
    """All distances (squared for l2) of rows x queries, by one matrix product where possible."""
    if metric == "l1":
        return np.stack([np.abs(rows - q).sum(axis=1) for q in queries], axis=1)
    products = rows @ queries.T
    if metric == "dot":
        return -products
    if metric == "l2":
        return (rows**2).sum(axis=1)[:, None] + (queries**2).sum(axis=1)[None, :] - 2 * products
    lengths = np.sqrt((rows**2).sum(axis=1))[:, None] * np.sqrt((queries**2).sum(axis=1))[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(lengths > 0, 1 - products / lengths, np.inf)


def best_rows(query: np.ndarray, ids: np.ndarray, dist: np.ndarray, k: int):
    """Keep the ``k`` least ``(distance, id)`` of every query."""
    order = np.lexsort((ids, dist, query))
    query, ids, dist = query[order], ids[order], dist[order]
    first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.empty(0, int)
    place = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)]))
    keep = place < k
    return query[keep], ids[keep], dist[keep]


#: Found rows that wait for the next merge with the best ones.
WAITING = 200_000


class Nearest:
    """Running k best rows per query over any number of row blocks."""

    def __init__(self, queries: np.ndarray, k: int, metric: str):
        self.queries, self.k, self.metric = queries, k, metric
        self.parts = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        self.waiting = 0

    @property
    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query position, id and distance of the best rows so far."""
        if len(self.parts) > 1:
            self.parts = [best_rows(*[np.concatenate(columns) for columns in zip(*self.parts)], self.k)]
            self.waiting = 0
        return self.parts[0]

    def add(self, ids: np.ndarray, rows: np.ndarray, wanted: np.ndarray | None = None, read: Callable | None = None) -> None:
        """Offer a block of rows to all queries, or to the query positions in ``wanted``.

        ``read`` tells which rows (first axis) the query positions it gets (second axis) are to be compared with.
        """
        wanted = np.arange(len(self.queries)) if wanted is None else wanted
        if len(ids) == 0:
            return
        for begin in range(0, len(wanted), QUERY_BLOCK):
            block = wanted[begin : begin + QUERY_BLOCK]
            asked = read(block) if read else None
            if asked is not None and not asked.any():
                continue
            rough = _block(rows, self.queries[block], self.metric)
            if asked is not None:
                rough[~asked] = np.inf
            last = min(self.k, len(ids)) - 1
            bound = np.partition(rough, last, axis=0)[last]
            # The matrix product may be off in the last digits: keep a margin, then recompute.
            scale = 1.0 + np.abs(np.where(np.isfinite(rough), rough, 0)).max(axis=0)
            row, col = np.nonzero((rough <= bound + 1e-9 * scale) & np.isfinite(rough))
            exact = pair_distances(rows[row], self.queries[block[col]], self.metric)
            self.parts.append((block[col], ids[row], np.round(exact, TIE_DECIMALS)))
            self.waiting += len(row)
            if self.waiting > WAITING:
                _ = self.found

    def result(self, query_ids: np.ndarray) -> pa.RecordBatch:
        query, ids, dist = self.found
        return pa.RecordBatch.from_arrays(
            [pa.array(query_ids[query], pa.int64()), pa.array(ids, pa.int64()), pa.array(dist, pa.float64())],
            names=["query_id", "id", "distance"],
        )
