"""Repeated passages from sparse suffixes at minimisers.

Of all suffixes of all texts only those that begin at a minimiser are kept: the word positions whose
ten-word fingerprint is the least of some window of 41 positions. Which they are depends on the words
alone, and every passage of ``LEAST_WORDS`` words holds one, so equal passages keep suffixes at
equal places. The kept suffixes are sorted by the fingerprint of their first words and compared with their
neighbours, which leaves those that some other suffix shares these words with.

What lies to their left and right is then compared for all partners at once, not for neighbours alone: the passages of
``LEAST_WORDS`` words around matched suffixes are sorted by fingerprint and compared in turn, and the ones found twice are
joined into the longest stretches. Extending neighbours of the one sorted order would lose passages: of three suffixes
A < B < C, A and C may share 20 words to the left and 30 to the right while B, between them, shares 35
to the right and none to the left; then neither pair of neighbours reaches 50 words, and A with C does.

A passage that millions of texts share is many equal rows in sorted slices, never one group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.llm.runs import name_runs
from weftgraph.llm.store import free_name, numbered, store
from weftgraph.llm.words import WORD_BASE, Words, buffers, cuts, running, sliced, spans
from weftgraph.plans.sizing import broadcast_if_small

#: Words of the shortest passage that is found.
LEAST_WORDS = 50
#: Words by which suffixes are sorted first, and positions of which one is kept.
SEED_WORDS = 10
WINDOW = LEAST_WORDS - SEED_WORDS + 1

PLACE = "key long, row long, pos long"
TOP = np.uint64(2**64 - 1)


def sliding(values: np.ndarray, size: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``size`` neighbours, by doubling."""
    out, have = values, 1
    while have < size:
        step = min(have, size - have)
        out = best(out[:-step], out[step:])
        have += step
    return out


def minimisers(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in the flat word array) of the kept suffixes and the fingerprint of their first words."""
    n = len(words.starts)
    if n < LEAST_WORDS:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first, prints = words.windows(SEED_WORDS, words.hashes())
    seeds = np.full(n, TOP)
    seeds[first] = prints
    least = sliding(seeds, WINDOW, np.minimum)  # of the positions i .. i + WINDOW - 1
    last = np.repeat(words.bounds[1:], words.counts)
    whole = np.arange(len(least)) + LEAST_WORDS <= last[: len(least)]
    least = np.where(whole, least, np.uint64(0))  # windows over two texts choose nothing
    around = np.concatenate([np.zeros(WINDOW - 1, np.uint64), least, np.zeros(n - len(least), np.uint64)])
    chosen = np.flatnonzero((sliding(around, WINDOW, np.maximum)[:n] == seeds) & (seeds != TOP) & (seeds != 0))
    return chosen, seeds[chosen]


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column(0).to_numpy()
        for at, to, words in sliced(batch.column(1)):
            chosen, prints = minimisers(words)
            owner = words.owner[chosen]
            yield pa.RecordBatch.from_arrays(
                [pa.array(prints.view(np.int64)), pa.array(rows[at:to][owner]), pa.array(chosen - words.bounds[owner])],
                names=["key", "row", "pos"],
            )


def _around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints of all passages of ``LEAST_WORDS`` words that hold a matched suffix's first words."""
    for batch in batches:
        rows = batch.column(0).to_numpy()
        data, offsets = buffers(batch.column(1))
        matched = batch.column(2)
        for at, to in cuts(offsets):
            part = offsets[at : to + 1]
            words = Words(data[part[0] : part[-1]], part - part[0])
            n = len(words.starts)
            mark = np.zeros(n + 1, np.int64)
            for i in range(at, to):
                base, end = words.bounds[i - at], words.bounds[i - at + 1]
                pos = np.asarray(matched[i].values.to_numpy()) + base
                np.add.at(mark, np.maximum(pos - WINDOW + 1, base), 1)
                np.add.at(mark, np.minimum(pos + 1, end), -1)
            first = np.flatnonzero(np.cumsum(mark)[:n] > 0)
            last = np.repeat(words.bounds[1:], words.counts)
            first = first[first + LEAST_WORDS <= last[first]]
            prints = spans(running(words.hashes(), WORD_BASE), WORD_BASE, first, first + LEAST_WORDS)
            owner = words.owner[first]
            for b in range(0, len(first), 200_000):
                e = b + 200_000
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(prints[b:e].view(np.int64)), pa.array(rows[at:to][owner[b:e]]),
                        pa.array(first[b:e] - words.bounds[owner[b:e]]),
                    ],
                    names=["key", "row", "pos"],
                )


STRETCH = "row long, begin_word long, end_word long, lead long"


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join overlapping and adjoining passages of a text."""
    for batch in batches:
        out: tuple[list, list, list, list] = ([], [], [], [])
        for row, found in zip(batch.column(0).to_pylist(), batch.column(1)):
            pos, lead = found.values.field(0).to_numpy(), found.values.field(1).to_numpy()
            order = np.argsort(pos, kind="stable")
            pos, lead = pos[order], lead[order]
            opens = np.flatnonzero(np.concatenate([[True], np.diff(pos) > LEAST_WORDS]))
            out[0].extend([row] * len(opens))
            out[1].extend(pos[opens])
            out[2].extend(pos[np.append(opens[1:], len(pos)) - 1] + LEAST_WORDS)
            out[3].extend(np.minimum.reduceat(lead, opens))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["row", "begin_word", "end_word", "lead"])


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row per stretch of a text that occurs elsewhere, in another text or again in its own.

    ``row, doc_id, begin_word, end_word, n_words, first_doc_id, copy``: word numbers from 0, the end
    exclusive; ``copy`` tells that an earlier row holds (part of) the stretch, ``first_doc_id`` is the
    earliest such row's id. Words are compared in ASCII lower case. Texts of fewer than
    ``LEAST_WORDS`` words, null and empty ones have no stretch. Every word of a passage of
    that many words found twice is in a stretch, and no other word is.
    """
    docs, row = numbered(docs, row_col)
    rows = docs.select(F.col(row).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    texts = rows.select("row", F.coalesce("text", F.lit("")).alias("text"))
    suffixes = store(texts.mapInArrow(_suffixes, PLACE), "suffixes")
    matched = name_runs(suffixes, ["key"], ["row", "pos"], ["row", "pos"], hash_col="key", name="seeds", only_repeated=True)
    matched = store(matched.filter("repeated").groupBy("row").agg(F.collect_list("pos").alias("pos")), "matched")
    near = texts.join(broadcast_if_small(matched.select("row")), "row", "left_semi")
    passages = store(near.join(matched, "row").select("row", "text", "pos").mapInArrow(_around, PLACE), "passages")
    found = name_runs(
        passages, ["key"], ["row", "pos"], ["row", "pos"], lead="row", hash_col="key", name="repeats", only_repeated=True
    ).filter("repeated")
    by_row = found.groupBy("row").agg(F.collect_list(F.struct("pos", "lead")).alias("found"))
    stretches = store(by_row.mapInArrow(_stretches, STRETCH), "stretches")
    ids = rows.select("row", "doc_id")
    wanted = store(stretches.select("row").union(stretches.select("lead")).distinct(), "stretch-rows")
    ids = store(ids.join(broadcast_if_small(wanted), "row", "left_semi"), "stretch-ids")
    return (
        stretches.join(ids, "row")
        .join(ids.toDF("lead", "first_doc_id"), "lead")
        .select(
            "row", "doc_id", "begin_word", "end_word", (F.col("end_word") - F.col("begin_word")).alias("n_words"),
            "first_doc_id", (F.col("lead") != F.col("row")).alias("copy"),
        )
    )


def _cut_out(at: int, spans_at: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans_ in zip(batch.column(at).to_pylist(), batch.column(spans_at).to_pylist()):
                raw = (text or "").encode()
                words = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                kept, last = [], 0
                for s in sorted((s["begin_word"], s["end_word"]) for s in spans_):
                    kept.append(raw[last : words.starts[s[0]]])
                    last = words.ends[s[1] - 1]
                texts.append(b"".join([*kept, raw[last:]]).decode())
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            del columns[spans_at]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for i, f in enumerate(batch.schema) if i != spans_at])

    return task


def cut_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the stretches that an earlier row holds; rows without any pass unchanged."""
    rows, row = numbered(docs)
    found = free_name(rows, "found_")
    copies = (
        repeated_passages(rows, id_col, text_col, row).filter("copy")
        .groupBy(F.col("row").alias(row)).agg(F.collect_list(F.struct("begin_word", "end_word")).alias(found))
    )
    copies = store(copies, "copies")
    rest = rows.join(broadcast_if_small(copies.select(row)), row, "left_anti").drop(row)
    hit = rows.join(copies, row).drop(row)
    schema = T.StructType([f for f in hit.schema if f.name != found])
    return rest.unionByName(hit.mapInArrow(_cut_out(docs.columns.index(text_col), len(docs.columns)), schema))
