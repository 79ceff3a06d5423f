"""Exact duplicates by deterministic naming of text blocks.

Each text is cut into blocks of fixed size. All blocks are sorted and every distinct block gets an
integer name; then adjacent pairs of names are sorted and named again, and so on, until one name is
left for each text. Two texts of equal block count have the same last name only if they are equal:
names stand for compared content, hashes only decide the order of the sort.

Only blocks move, once; every later round moves three numbers a pair and halves the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.llm.runs import name_runs
from weftgraph.llm.store import numbered, store
from weftgraph.llm.words import buffers, cuts
from weftgraph.plans.sizing import broadcast_if_small

#: Bytes of a block.
BLOCK_BYTES = 2048
#: Bytes of text cut together.
TEXT_BYTES = 2 << 20

BLOCKS = T.StructType(
    [
        T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()),
        T.StructField("pos", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("block", T.BinaryType()), T.StructField("sha", T.BinaryType()),
    ]
)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        _, bounds = buffers(whole.column(2))
        for at, to in cuts(bounds, TEXT_BYTES):
            yield from _cut_part(whole.slice(at, to - at))


def _cut_part(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    if batch.num_rows:
        data, offsets = buffers(batch.column(2))
        lengths = np.diff(offsets)
        counts = np.maximum(1, -(-lengths // BLOCK_BYTES))
        owner = np.repeat(np.arange(len(counts)), counts)
        pos = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        begins = np.append(offsets[owner] + pos * BLOCK_BYTES, offsets[-1]).astype(np.int64)
        whole = data.tobytes()
        shas = [None] * len(owner)
        for i, first in enumerate(np.flatnonzero(pos == 0)):
            shas[first] = hashlib.sha256(whole[offsets[i] : offsets[i + 1]]).digest()
        blocks = pa.Array.from_buffers(
            pa.large_binary(), len(owner), [None, pa.py_buffer(begins), pa.py_buffer(whole)]
        ).cast(pa.binary())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(owner)), batch.column(1).take(pa.array(owner)),
                pa.array(pos, pa.int64()), pa.array(counts[owner], pa.int64()), blocks, pa.array(shas, pa.binary()),
            ],
            names=BLOCKS.names,
        )


def text_names(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``row, doc_id, n, name, sha``.

    Equal ``(n, name)`` means equal text and nothing else does; ``n`` is the number of blocks,
    ``sha`` the SHA-256 of the UTF-8 text. ``row`` is the row's number (``row_col``, or one that
    ``with_row`` gives). A null text is the empty text; the empty text is one empty block. Ids may be
    null or repeat.
    """
    docs, row = numbered(docs, row_col)
    rows = docs.select(F.col(row).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    blocks = rows.mapInArrow(_cut, BLOCKS)
    level = name_runs(blocks, ["block"], ["row", "pos"], ["row", "doc_id", "pos", "n", "sha"], name="blocks")
    level = store(level, "block-names")
    heads = level.filter("pos = 0").select("row", "doc_id", "n", "name", "sha")
    longest = level.agg(F.max("n")).first()[0] or 1
    if longest == 1:
        return heads

    pairs = level.filter("n > 1").select("row", "pos", F.col("n").alias("left"), "name")
    ended = []
    while longest > 1:
        half = F.shiftright("pos", 1)
        odd = F.col("pos").bitwiseAND(F.lit(1)) == 1
        folded = (
            pairs.groupBy("row", half.alias("pos"), "left")
            .agg(F.max(F.when(~odd, F.col("name"))).alias("a"), F.max(F.when(odd, F.col("name"))).alias("b"))
            .select("row", "pos", F.ceil(F.col("left") / 2).cast("long").alias("left"), "a", F.coalesce("b", F.lit(-1)).alias("b"))
        )
        named = name_runs(store(folded, "pairs"), ["a", "b"], ["row", "pos"], ["row", "pos", "left"], name="pair-names")
        ended.append(named.filter("left = 1").select("row", F.col("name").alias("last")))
        pairs = named.filter("left > 1").select("row", "pos", "left", "name")
        longest = -(-longest // 2)
    last = ended[0]
    for more in ended[1:]:
        last = last.union(more)
    return heads.filter("n = 1").union(
        heads.filter("n > 1").join(last, "row").select("row", "doc_id", "n", F.col("last").alias("name"), "sha")
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """The copies of each text: ``row, doc_id, keep_id, group_size, kept, text_sha256`` per row of ``docs``.

    Of equal texts the row with the largest id stays (a null id is smaller than any; of repeated ids
    the last row). A group of any size is counted map-side, and only groups of two and more meet the
    rows again.
    """
    names = store(text_names(docs, id_col, text_col, row_col), "text-names")
    groups = (
        names.groupBy("n", "name")
        .agg(F.max(F.struct("doc_id", "row")).alias("stays"), F.count("*").alias("group_size"))
        .filter("group_size > 1")
    )
    found = names.join(broadcast_if_small(store(groups, "copy-groups")), ["n", "name"], "left")
    single = F.col("group_size").isNull()
    return found.select(
        "row",
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("stays.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(single, True).otherwise(F.col("row") == F.col("stays.row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each text, the one ``exact_groups`` keeps; all columns stay, whatever their names.

    Null and empty texts are one text; of equal texts with equal or no ids the last row stays. A table
    without rows stays empty; a text of any length is compared whole.
    """
    rows, row = numbered(docs)
    gone = exact_groups(rows, id_col, text_col, row).filter("NOT kept").select(F.col("row").alias(row))
    return rows.join(broadcast_if_small(store(gone, "copies")), row, "left_anti").drop(row)
