"""Indexes that registered queries share: written once per session and state of the table they are made from."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.plans.materialize import ensure_checkpoint_dir

Index = TypeVar("Index")

#: What this process has written, by session, name and state of the files it was made from.
WRITTEN: dict[tuple, object] = {}


def files_state(df: DataFrame) -> tuple:
    """Number and a digest of the files of a scan, with their sizes and times; no column of the table is read."""
    files = df.select(*[F.col(f"_metadata.{c}").alias(c) for c in ("file_path", "file_size", "file_modification_time")]).distinct()
    return tuple(files.agg(F.count("*"), F.sum(F.xxhash64(*files.columns).cast("decimal(38,0)"))).first())


def written(name: str, table: DataFrame, make: Callable[[str], Index]) -> Index:
    """What ``make`` puts into a folder of its own in the shared one, made anew when the files of ``table`` change."""
    spark = table.sparkSession
    key = (spark.sparkContext.applicationId, name, files_state(table))
    if key not in WRITTEN:
        WRITTEN[key] = make(f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return WRITTEN[key]
