"""Top-k, global numbering and ranks that never put one whole group into one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.plans.materialize import materialize


#: Bits of Spark's increasing id that count rows inside a partition.
PLACE_BITS = 33


def check_limit(value: int, name: str = "limit") -> int:
    """Reject anything but an integer of at least one (a bool is not an integer here)."""
    if isinstance(value, bool) or not isinstance(value, int) or value < 1:
        raise ValueError(f"{name} must be an integer >= 1, got {value!r}")
    return value


def top_k_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank_col: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of every group, numbered from 1.

    The filter on ``row_number`` lets Spark place a group limit before the exchange, so each
    task sends at most ``k`` rows per group however large the group is.
    """
    check_limit(k, "k")
    numbered = df.withColumn(rank_col, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return numbered.filter(F.col(rank_col) <= k)


def _slices(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Sort by range into ``__slice`` numbers and pin them: a rerun must not move a row."""
    return materialize(df.repartitionByRange(*order).withColumn("__slice", F.spark_partition_id()))


def with_dense_ids(df: DataFrame, order: Sequence[str], id_col: str = "id", start: Column | int = 0) -> DataFrame:
    """Number all rows ``start, start + 1, ...`` in the order given, with one range shuffle.

    Rows are range-partitioned and sorted inside their slice. Spark's increasing id then holds the
    slice in its upper and the place in the slice in its lower 33 bits, so only the slice sizes,
    one row per slice, have to be added up.
    """
    columns = [F.col(c) for c in order]
    ranged = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    placed = materialize(ranged.withColumn("__at", F.monotonically_increasing_id()))
    slice_of = F.shiftright(F.col("__at"), PLACE_BITS)
    sizes = placed.groupBy(slice_of.alias("__slice")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__slice", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    base = start if isinstance(start, Column) else F.lit(start)
    place = F.col("__at").bitwiseAND(F.lit(2**PLACE_BITS - 1))
    return (
        placed.withColumn("__slice", slice_of)
        .join(F.broadcast(offsets), "__slice")
        .withColumn(id_col, (base + F.col("__offset") + place).cast("long"))
        .drop("__slice", "__offset", "__at")
    )


def global_rank(
    df: DataFrame, group: Sequence[str], score: str, rank_col: str = "rank", ascending: bool = False
) -> DataFrame:
    """SQL ``rank()`` of ``score`` within each group, for groups of any size.

    A plain window would sort a whole group in one task. Here equal scores are counted first
    (map-side), the distinct scores are range-partitioned, and the rank is the running count
    inside a slice plus the counts of the slices before it.

    A NULL group is a group and a NULL score is ranked last, as one value.
    """
    counts = df.groupBy(*group, score).agg(F.count("*").alias("__n"))
    direction = F.col(score).asc_nulls_last() if ascending else F.col(score).desc_nulls_last()
    sliced = _slices(counts, [*[F.col(g) for g in group], direction])
    per_slice = sliced.groupBy(*group, "__slice").agg(F.sum("__n").alias("__total"))
    before = Window.partitionBy(*group).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(
        *group, "__slice", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__offset")
    )
    same_groups = reduce(
        lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(group)], F.lit(True)
    )
    inside = (
        Window.partitionBy(*group, "__slice").orderBy(direction).rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = (
        sliced.withColumn("__before", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
        .join(offsets.toDF(*[f"__g{i}" for i in range(len(group))], "__of", "__offset"), same_groups & (F.col("__slice") == F.col("__of")))
        .select(*group, score, (F.col("__offset") + F.col("__before") + 1).cast("long").alias(rank_col))
    )
    keys = [*group, score]
    ranked = ranked.toDF(*[f"__g{i}" for i in range(len(keys))], rank_col)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__g{i}")) for i, k in enumerate(keys)])
    return df.join(ranked, same).drop(*[f"__g{i}" for i in range(len(keys))])
