"""Equal keys named, and running totals, over globally sorted rows without one-task groups.

Rows are range-partitioned by key hash *and* a tie-break, so a key that holds a third of all rows
lies in many neighbouring slices. Each task handles its sorted slice as a stream; what must be known
across slices (the first and the last key of each, or one total per slice and group) is a few rows
per slice.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from weftgraph.llm.store import store
from weftgraph.plans.sizing import broadcast_if_small

SLICE_SHIFT = 32


def _same_as_before(table: pa.Table, key: Sequence[str]) -> np.ndarray:
    """For every row but the first: equal to the row above in all key columns."""
    n = table.num_rows
    same = np.ones(n - 1, bool)
    for name in key:
        column = table[name].combine_chunks()
        same &= pc.equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    return same


def _walk(key: list[str], hash_col: str, keep: list[str], lead: str | None, kinds: pa.Schema, only_repeated: bool):
    """The task: number the runs of a sorted slice and report those that may go on in another slice."""

    def row_key(table: pa.Table, i: int) -> bytes:
        return pickle.dumps(tuple(table[name][i].as_py() for name in key))

    def out(table: pa.Table | None, n: int, run, leads, repeated, edge) -> pa.RecordBatch:
        columns = [
            table[f.name].combine_chunks().cast(f.type) if table is not None else pa.nulls(n, f.type)
            for f in kinds
            if f.name in keep
        ]
        columns += [
            pa.array(np.full(n, TaskContext.get().partitionId(), np.int64)),
            pa.array(run, pa.int64()),
            pa.array(leads, pa.int64()),
            pa.array(repeated, pa.bool_()),
            pa.array(edge, pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[*keep, "slice", "run", "lead", "repeated", "edge"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # the last row so far; whether it repeats is not known yet
        held_run, held_lead, held_opens = 0, 0, True
        first_hash = last_hash = None
        # Runs of the first and of the last hash of the slice: run -> (key, lead).
        at_first: dict[int, tuple[bytes, int]] = {}
        at_last: dict[int, tuple[bytes, int]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            opens, seen = True, 0
            if held is not None:
                table = pa.concat_tables([held, table])
                opens, seen = held_opens, 1
            n = table.num_rows
            same = _same_as_before(table, key)
            starts = np.concatenate([[opens], ~same])
            run = held_run + np.cumsum(np.concatenate([[0], ~same]))
            tie = table[lead].to_numpy() if lead else np.zeros(n, np.int64)
            at = np.maximum.accumulate(np.where(starts, np.arange(n), -1))
            leads = np.where(at >= 0, tie[np.maximum(at, 0)], held_lead)
            hashes = table[hash_col].to_numpy()
            if first_hash is None:
                first_hash = hashes[0]
            if hashes[-1] != last_hash:
                last_hash, at_last = hashes[-1], {}
            for i in np.flatnonzero(starts & ((hashes == first_hash) | (hashes == last_hash))):
                if i >= seen:
                    to = at_first if hashes[i] == first_hash else at_last
                    to[int(run[i])] = (row_key(table, int(i)), int(leads[i]))
            repeated = ~(starts[:-1] & ~same)
            # A single row may still be repeated in the slice before.
            shown = repeated | (hashes[:-1] == first_hash) if only_repeated else np.ones(n - 1, bool)
            if shown.any():
                m = int(shown.sum())
                yield out(
                    table.slice(0, n - 1).filter(pa.array(shown)), m, run[:-1][shown], leads[:-1][shown], repeated[shown], [None] * m
                )
            held, held_run, held_lead, held_opens = table.slice(n - 1), int(run[-1]), int(leads[-1]), bool(starts[-1])
        if held is not None:
            yield out(held, 1, [held_run], [held_lead], [not held_opens], [None])
            edges = {**at_last, **at_first}
            yield out(
                None, len(edges), list(edges), [v[1] for v in edges.values()], [False] * len(edges),
                [v[0] for v in edges.values()],
            )

    return task


def name_runs(
    df: DataFrame, key: Sequence[str], tie: Sequence[str], keep: Sequence[str], lead: str | None = None,
    hash_col: str | None = None, name: str = "runs", only_repeated: bool = False,
) -> DataFrame:
    """Give rows of equal ``key`` one integer name, ``name``; different keys never share one.

    Also returned: ``repeated`` (the key occurs more than once) and ``lead`` (the value of the long
    column ``lead`` in the first row of the key by ``tie``). ``keep`` are the columns to carry along.
    Keys are compared themselves; their hash (``hash_col``, or one made here) only orders them.
    With ``only_repeated`` the rows of keys that occur once are left out of the written table, as far as
    a task can tell; filter on ``repeated`` for the rest. Then ``hash_col`` must be the key itself.
    ``df`` is evaluated twice (range bounds, then rows), so it should be a scan or a stored table.
    """
    hashed = hash_col or "__hash"
    rows = df if hash_col else df.withColumn(hashed, F.xxhash64(*[F.col(k) for k in key]))
    keep = list(keep)
    rows = rows.select(*dict.fromkeys([*keep, *key, *tie, hashed, *([lead] if lead else [])]))
    order = [hashed, *[k for k in key if k != hashed], *tie]
    ranged = rows.repartitionByRange(*[F.col(c) for c in dict.fromkeys([hashed, *tie])]).sortWithinPartitions(
        *dict.fromkeys(order)
    )
    schema = T.StructType(
        [rows.schema[c] for c in keep]
        + [
            T.StructField("slice", T.LongType()), T.StructField("run", T.LongType()), T.StructField("lead", T.LongType()),
            T.StructField("repeated", T.BooleanType()), T.StructField("edge", T.BinaryType()),
        ]
    )
    kinds = to_arrow_schema(T.StructType([rows.schema[c] for c in keep]))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    named = store(ranged.mapInArrow(_walk(list(key), hashed, keep, lead, kinds, only_repeated), schema), name)

    # A key that lies in several slices is an edge of each of them; two edges per slice, as a rule.
    own = F.shiftleft(F.col("slice"), SLICE_SHIFT) + F.col("run")
    edges = named.filter("edge IS NOT NULL").select("edge", "slice", "run", "lead")
    firsts = edges.groupBy("edge").agg(F.min(F.struct("slice", "run", own.alias("name"), "lead")).alias("first"), F.count("*").alias("n"))
    fix = edges.drop("lead").join(firsts.filter("n > 1").drop("n"), "edge")
    fix = store(fix.select("slice", "run", F.col("first.name").alias("fix_name"), F.col("first.lead").alias("fix_lead")), f"{name}-edges")
    rows = named.filter("edge IS NULL").drop("edge")
    return rows.join(broadcast_if_small(fix), ["slice", "run"], "left").select(
        *keep,
        F.coalesce("fix_name", own).alias("name"),
        (F.col("repeated") | F.col("fix_name").isNotNull()).alias("repeated"),
        F.coalesce("fix_lead", "lead").alias("lead"),
    )


def running_total(
    df: DataFrame, group: str | None, order: Sequence[str], values: Sequence[str], name: str = "totals"
) -> DataFrame:
    """Add ``before_<value>`` and ``upto_<value>``: sums over the rows of the group before / up to each row.

    ``group`` is a non-null long column (none: all rows are one group), ``values`` are longs of 0 or
    more; the sort is ``group``, then ``order``, all ascending. Rows equal in all of these follow each other in any order, so they
    should be alike in ``values``.
    """
    sort = [*([group] if group else []), *order]
    ranged = df.repartitionByRange(*[F.col(c) for c in sort]).sortWithinPartitions(*sort)
    plus = [T.StructField("slice", T.LongType())] + [T.StructField(f"upto_{v}", T.LongType()) for v in values]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in [*df.schema.fields, *plus]])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        carried, last = {v: 0 for v in values}, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            groups = batch.column(group).to_numpy() if group else np.zeros(n, np.int64)
            new = np.concatenate([[last is None or groups[0] != last], groups[1:] != groups[:-1]])
            start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            columns = [*batch.columns, pa.array(np.full(n, place, np.int64))]
            for v in values:
                sums = np.cumsum(batch.column(v).to_numpy())
                base = np.where(start > 0, sums[np.maximum(start - 1, 0)], 0)
                upto = sums - base
                if not new[0]:
                    upto[start == 0] += carried[v]
                carried[v] = int(upto[-1])
                columns.append(pa.array(upto, pa.int64()))
            last = groups[-1]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    placed = store(ranged.mapInArrow(task, schema), name)
    by = ["slice", *([group] if group else [])]
    sums = placed.groupBy(*by).agg(*[F.max(f"upto_{v}").alias(f"sum_{v}") for v in values])
    earlier = Window.partitionBy(*([group] if group else [F.lit(0)])).orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sums.select(*by, *[F.coalesce(F.sum(f"sum_{v}").over(earlier), F.lit(0)).alias(f"off_{v}") for v in values])
    joined = placed.join(broadcast_if_small(offsets), by)
    totals = [(F.col(f"off_{v}") + F.col(f"upto_{v}")) for v in values]
    return joined.select(
        *df.columns,
        *[(t - F.col(v)).alias(f"before_{v}") for t, v in zip(totals, values)],
        *[t.alias(f"upto_{v}") for t, v in zip(totals, values)],
    )
