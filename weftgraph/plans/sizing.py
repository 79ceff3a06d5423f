"""Size checks made before anything is sent to every executor."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most rows and most bytes of a lookup side that may be broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 256 << 20


def _wide_bytes(df: DataFrame) -> list[Column]:
    """About how many bytes each column of varying size takes in a row."""
    found = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            found.append(F.octet_length(column))
        elif isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StringType):
            found.append(F.octet_length(F.array_join(column, "")) + 16 * F.size(column))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType)):
            found.append(32 * F.size(column))
    return [F.coalesce(c.cast("long"), F.lit(0)) for c in found]


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and, as far as its columns vary in size, ``max_bytes`` bytes.

    Counted in the tasks: a limit would send up to that many rows of each task to a single one. ``df``
    should be a scan, a stored table or cheap to evaluate.
    """
    if df.count() > max_rows:
        return False
    wide = _wide_bytes(df)
    return not wide or (df.agg(F.sum(reduce(lambda a, b: a + b, wide))).first()[0] or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only after counting its rows and bytes; otherwise leave the join to Spark."""
    return F.broadcast(df) if fits(df, max_rows) else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Cut a table of fewer splits than cores into one part per core.

    Meant for a plain scan before work that is heavy per row (text, vectors). A large table has more
    splits than the cluster has cores and is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def absent_from(rows: DataFrame, large: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` whose keys do not occur in ``large``.

    When ``rows`` fits the bound the large table is only filtered where it lies and never
    shuffled; a plain anti join would shuffle both sides.
    """
    if fits(rows):
        large = large.join(F.broadcast(rows.select(*keys)), keys, "left_semi")
    # Spark splits hot keys on the left side only, so the right one is made distinct, map-side first.
    return rows.join(large.select(*keys).distinct(), keys, "left_anti")
