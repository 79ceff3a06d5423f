"""Predicates and projections on node and edge tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Longest value list kept as a literal ``IN``; longer ones become a semi join.
MAX_LITERALS = 500


def where_equal(df: DataFrame, properties: Mapping[str, Any]) -> DataFrame:
    """Inline property map: all equalities must hold. Reaches the Parquet scan."""
    if not properties:
        return df
    return df.filter(reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in properties.items()]))


def where_in(df: DataFrame, column: str, values: Sequence[Any] | DataFrame, negate: bool = False) -> DataFrame:
    """Membership in a list or in the first column of a DataFrame.

    A NULL in the tested column is never kept; a NULL among the values matches nothing and excludes
    nothing. Both hold for a list of any length and for a DataFrame.
    """
    if isinstance(values, DataFrame):
        # Spark splits hot keys on the left side only; repeats on the right are reduced map-side.
        keys = values.select(F.col(values.columns[0]).alias(column)).distinct()
        if negate:
            return df.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")
        return df.join(keys, column, "left_semi")
    values = [v for v in values if v is not None]
    if len(values) > MAX_LITERALS:
        spark = df.sparkSession
        keys = spark.createDataFrame([(v,) for v in values], f"`{column}` {df.schema[column].dataType.simpleString()}")
        return where_in(df, column, keys, negate)
    test = F.col(column).isin(values)
    return df.filter(F.col(column).isNotNull() & ~test if negate else test)


def stable_label(labels: Column | str) -> Column:
    """The smallest label of a node, NULL when it has none."""
    return F.array_min(labels)


def unwind_labels(nodes: DataFrame, alias: str = "label") -> DataFrame:
    """One row per node and label."""
    return nodes.withColumn(alias, F.explode("labels"))


def scope(df: DataFrame, column: str, value: Any) -> DataFrame:
    """Restrict a table to one scope tag; applied to every side of a match."""
    return where_equal(df, {column: value})


def created_now(df: DataFrame, column: str = "created") -> DataFrame:
    """Stamp rows with the time of the query (one value for the whole query)."""
    return df.withColumn(column, F.current_timestamp())
