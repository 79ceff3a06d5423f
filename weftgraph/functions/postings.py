"""Postings of a block of tokenised documents: the Arrow helper that runs inside tasks.

All tokens of a document sit in one row, so its postings can be formed where it was read; a
shuffle of single tokens would move the whole collection for nothing.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Gap left between two indexed properties, so that no phrase crosses them.
PROPERTY_GAP = 100
#: Every document has one posting under this term; it carries the document length.
DOCUMENT_MARK = ""
#: Documents handled at once, to bound memory whatever the batch size of the session.
SLICE = 500
#: Tokens handled at once where documents are handled by their length.
SLICE_TOKENS = 2_000_000

POSTING = "id long, dl long, term string, tf long"
#: Of two neighbouring words: both names, how often the document has either, where the first one stands.
PAIR = f"{POSTING}, tf_next long, positions array<int>"

#: The same by block: the postings of a term in a run of documents are one row, with a list per column.
BLOCK = "term string, id array<long>, dl array<int>, tf array<int>, positions array<array<int>>"
PAIR_BLOCK = "term string, id array<long>, dl array<int>, tf array<int>, tf_next array<int>, positions array<array<int>>"
#: Columns of numbers that fit 32 bits, as no document has more tokens.
COUNTS = ("dl", "tf", "tf_next")


def in_slices(batch: pa.RecordBatch, columns: list[str]):
    """The rows of a batch in runs of about ``SLICE_TOKENS`` tokens; a longer document is a run of its own."""
    sizes = sum(np.asarray(batch.column(c).value_lengths().fill_null(0), dtype=np.int64) for c in columns)
    run = np.cumsum(sizes) // SLICE_TOKENS
    cuts = [0, *(np.flatnonzero(run[1:] != run[:-1]) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def to_blocks(postings: pa.RecordBatch) -> pa.RecordBatch:
    """One row per term, with the other columns of its postings as lists in the order given."""
    coded = postings.column("term").dictionary_encode()
    codes = np.asarray(coded.indices, dtype=np.int64)
    offsets = np.r_[0, np.cumsum(np.bincount(codes, minlength=len(coded.dictionary)))].astype(np.int32)
    rows = postings.take(pa.array(np.argsort(codes, kind="stable")))
    names = [n for n in postings.schema.names if n != "term"]
    columns = [rows.column(n).cast(pa.int32()) if n in COUNTS else rows.column(n) for n in names]
    lists = [pa.ListArray.from_arrays(pa.array(offsets), c) for c in columns]
    return pa.RecordBatch.from_arrays([coded.dictionary, *lists], names=["term", *names])


def distinct_terms(batches, columns: list[str]):
    """The terms of all batches of a task, each once."""
    found, waiting, size = pa.array([], pa.string()), [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            lists = [part.column(name).flatten().cast(pa.string()) for name in columns]
            waiting.append(pa.concat_arrays(lists).unique())
            size += len(waiting[-1])
            if size > max(len(found), 100_000):  # merged when as many wait as are known, so each term is handled a few times
                found, waiting, size = pa.concat_arrays([found, *waiting]).unique(), [], 0
    yield pa.RecordBatch.from_arrays([pa.concat_arrays([found, *waiting]).unique()], names=["term"])


class Laid(NamedTuple):
    """All tokens of a batch in order of column, row and place: ``terms[codes]`` at ``place`` of ``row``."""

    ids: np.ndarray
    length: np.ndarray
    row: np.ndarray
    place: np.ndarray
    codes: np.ndarray
    terms: pa.Array


def lay_out(batch: pa.RecordBatch, columns: list[str]) -> Laid:
    ids = np.asarray(batch.column("id"), dtype=np.int64)
    base = np.zeros(len(ids), np.int64)
    length = np.zeros(len(ids), np.int64)
    rows, places, words = [], [], []
    for name in columns:
        lists = batch.column(name)
        sizes = np.asarray(lists.value_lengths().fill_null(0), dtype=np.int64)
        row = np.repeat(np.arange(len(ids)), sizes)
        start = np.cumsum(sizes) - sizes
        rows.append(row)
        places.append(np.arange(len(row)) - start[row] + base[row])
        words.append(lists.flatten())
        base += sizes + PROPERTY_GAP
        length += sizes
    coded = pa.concat_arrays(words).dictionary_encode()
    codes = np.asarray(coded.indices, dtype=np.int64)
    return Laid(ids, length, np.concatenate(rows), np.concatenate(places), codes, coded.dictionary.cast(pa.string()))


def form_pairs(batch: pa.RecordBatch, columns: list[str], frequent: pa.Array) -> pa.RecordBatch:
    """Postings of neighbouring words that are both in ``frequent``, with the number of times the document has either."""
    ids, length, row, place, codes, terms = lay_out(batch, columns)
    often = np.asarray(pc.is_in(terms, value_set=frequent), dtype=bool)[codes]
    # The gap between properties keeps the last word of one from standing beside the first of the next.
    beside = often[:-1] & often[1:] & (row[:-1] == row[1:]) & (place[:-1] + 1 == place[1:])
    at = np.flatnonzero(beside)
    key = row * max(1, len(terms)) + codes
    known, times = np.unique(key[often], return_counts=True)
    at = at[np.lexsort((place[at], key[at + 1], key[at]))]
    left, right = key[at], key[at + 1]
    new = np.r_[True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])] if len(at) else np.empty(0, bool)
    first = np.flatnonzero(new)
    one = at[first]
    names = [terms.take(pa.array(codes[one + step])) for step in (0, 1)]
    data = {
        "id": pa.array(ids[row[one]]),
        "dl": pa.array(length[row[one]]),
        "term": pc.binary_join_element_wise(*names, " "),
        "tf": pa.array(times[np.searchsorted(known, left[first])].astype(np.int64)),
        "tf_next": pa.array(times[np.searchsorted(known, right[first])].astype(np.int64)),
        "positions": pa.ListArray.from_arrays(pa.array(np.r_[first, len(at)].astype(np.int32)), pa.array(place[at].astype(np.int32))),
    }
    return pa.RecordBatch.from_pydict(data)


def form_postings(
    batch: pa.RecordBatch,
    columns: list[str],
    wanted: pa.Array | None = None,
    removed: pa.Array | None = None,
    positions: bool = False,
) -> pa.RecordBatch:
    """Postings of the token lists in ``columns``, plus one document mark per row."""
    ids, length, row, place, codes, terms = lay_out(batch, columns)
    keep = np.ones(len(terms), bool)
    if wanted is not None:
        keep &= np.asarray(pc.is_in(terms, value_set=wanted))
    if removed is not None:
        keep &= ~np.asarray(pc.is_in(terms, value_set=removed))
    if not keep.all():
        chosen = keep[codes]
        row, place, codes = row[chosen], place[chosen], codes[chosen]
    order = np.argsort(row * max(1, len(terms)) + codes, kind="stable")
    row, place, codes = row[order], place[order], codes[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (codes[1:] != codes[:-1])] if len(row) else np.empty(0, bool)
    first = np.flatnonzero(new)
    count = np.diff(np.r_[first, len(row)])
    marks = pa.array([DOCUMENT_MARK] * len(ids), pa.string())
    data = {
        "id": pa.array(np.r_[ids[row[first]], ids]),
        "dl": pa.array(np.r_[length[row[first]], length]),
        "term": pa.concat_arrays([terms.take(pa.array(codes[first])), marks]),
        "tf": pa.array(np.r_[count, np.ones(len(ids), np.int64)]),
    }
    if positions:
        starts = np.r_[first, np.arange(len(row), len(row) + len(ids) + 1)].astype(np.int32)
        flat = pa.array(np.r_[place, np.full(len(ids), -1)].astype(np.int32))
        data["positions"] = pa.ListArray.from_arrays(pa.array(starts), flat)
    return pa.RecordBatch.from_pydict(data)
