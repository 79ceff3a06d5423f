"""Quality rules: word statistics, and bands of the zstandard compression ratio.

Prose compresses within a narrow band that depends on its length (a short text has not repeated
anything yet, a long one has). A document is rejected when its ratio as a whole, or the
ratio of too many of its fixed chunks, lies outside the band of its length: above it the
text repeats itself, below it the text is noise.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.llm.store import numbered
from weftgraph.llm.words import Words, buffers, byte_spans, cuts

#: The characters counted as symbols.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

LEVEL = 3
CHUNK_BYTES = 4096
#: (bytes from, least ratio, most ratio) of a whole document, by rising length. Prose measured with
#: level 3 lies at 1.4 to 1.9 below 500 bytes, 1.7 to 2.2 about 2,000, 2.2 to 2.5 above 16,000.
WHOLE_BANDS = (
    (200, 1.15, 2.3), (500, 1.3, 2.4), (1_000, 1.4, 2.5), (4_000, 1.45, 2.65), (16_000, 1.5, 3.0), (64_000, 1.5, 3.4),
)
#: The same for a chunk; the last chunk of a document may be short and has the band of its length.
CHUNK_BANDS = ((1_000, 1.4, 2.5), (4_000, 1.45, 2.65))
#: Part of the judged chunks that must be outside their band before the document goes.
CHUNK_SHARE = 0.5


@dataclass(frozen=True)
class Bands:
    """Limits of the method; the defaults keep prose of many languages and scripts."""

    whole: Sequence[tuple[int, float, float]] = WHOLE_BANDS
    chunk: Sequence[tuple[int, float, float]] = CHUNK_BANDS
    chunk_share: float = CHUNK_SHARE
    chunk_bytes: int = CHUNK_BYTES
    level: int = LEVEL

    def outside(self, bands: Sequence[tuple[int, float, float]], size: int, ratio: float) -> bool:
        limits = None
        for least, low, high in bands:
            if size >= least:
                limits = (low, high)
        return limits is not None and not limits[0] <= ratio <= limits[1]


STATS = T.StructType(
    [
        T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()), T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()), T.StructField("ratio", T.DoubleType()),
        T.StructField("bad_chunks", T.LongType()), T.StructField("n_chunks", T.LongType()),
        T.StructField("in_band", T.BooleanType()),
    ]
)

_DOC_SALT = np.uint64(0x9FB21C651E98DF25)


def per_text(sums: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Totals of a per-byte array for each text, from its running sums."""
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _running(flags: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])


def repeated_lines(words: Words) -> np.ndarray:
    """For each text: lines that hold a word and equal an earlier line of it."""
    data, offsets, n = words.data, words.offsets, len(words.offsets) - 1
    newline = np.flatnonzero(data == 10)
    begins = np.concatenate([offsets[:-1], newline + 1])
    ends = np.concatenate([offsets[1:], newline])
    owner = np.concatenate([np.arange(n), np.searchsorted(offsets, newline, "right") - 1])
    order = np.lexsort((begins, owner))
    begins, owner = begins[order], owner[order]
    # A line ends before the next line of its text, the last one with the text.
    more = np.concatenate([owner[1:] == owner[:-1], [False]])
    ends = np.where(more, np.concatenate([begins[1:] - 1, [0]]), offsets[owner + 1])
    full = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, begins)
    begins, ends, owner = begins[full], ends[full], owner[full]
    hashes = byte_spans(words.data, words.byte_sums, begins, ends) + owner.astype(np.uint64) * _DOC_SALT
    _, first = np.unique(hashes, return_index=True)
    return np.bincount(owner, minlength=n) - np.bincount(owner[first], minlength=n)


def repeated_words(words: Words, size: int = 3) -> np.ndarray:
    """For each text: words that lie in a window of ``size`` words found at least twice in it."""
    n = len(words.counts)
    first, hashes = words.windows(size, words.hashes())
    if not len(first):
        return np.zeros(n, np.int64)
    owner = words.owner
    hashes += owner[first].astype(np.uint64) * _DOC_SALT
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    twice = np.zeros(len(first), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(owner), bool)
    for i in range(size):
        covered[first[twice] + i] = True
    return np.bincount(owner[covered], minlength=n)


def compression(text: bytes, packer: zstandard.ZstdCompressor, bands: Bands) -> tuple[float, int, int, bool]:
    """Ratio of the whole text, chunks outside their band, chunks judged, and the verdict."""
    size = len(text)
    if not size:
        return 0.0, 0, 0, True
    ratio = size / len(packer.compress(text))
    bad = judged = 0
    for at in range(0, size, bands.chunk_bytes):
        chunk = text[at : at + bands.chunk_bytes]
        if len(chunk) >= bands.chunk[0][0]:
            judged += 1
            bad += bands.outside(bands.chunk, len(chunk), len(chunk) / len(packer.compress(chunk)))
    return ratio, bad, judged, not (
        bands.outside(bands.whole, size, ratio) or (judged and bad > bands.chunk_share * judged)
    )


def _measure(bands: Bands):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=bands.level, write_content_size=False)
        for batch in batches:
            data, offsets = buffers(batch.column(2))
            for at, to in cuts(offsets):
                part = offsets[at : to + 1]
                words = Words(data[part[0] : part[-1]], part - part[0], lower=False)
                bytes_in_words = _running(~(words.data >> 6 == 2) & ~np.isin(words.data, [32, 9, 10, 11, 12, 13]))
                raw = words.data.tobytes()
                zipped = [compression(raw[b:e], packer, bands) for b, e in zip(words.offsets[:-1], words.offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, to - at), batch.column(1).slice(at, to - at),
                        pa.array(words.counts, pa.int64()),
                        pa.array(per_text(bytes_in_words, words.offsets)),
                        pa.array(per_text(_running(SYMBOLS[words.data]), words.offsets)),
                        pa.array(repeated_lines(words), pa.int64()),
                        pa.array(repeated_words(words), pa.int64()),
                        pa.array([z[0] for z in zipped], pa.float64()),
                        pa.array([z[1] for z in zipped], pa.int64()),
                        pa.array([z[2] for z in zipped], pa.int64()),
                        pa.array([z[3] for z in zipped], pa.bool_()),
                    ],
                    names=STATS.names,
                )

    return task


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: Bands = Bands()) -> DataFrame:
    """Per row of ``docs``: ``STATS`` and ``base_failed, kept``; nothing is shuffled.

    ``base_failed``: fewer than 50 words, or over half of the words in repeated three-word windows.
    ``kept``: not ``base_failed`` and within the compression bands. A null or empty text has no words,
    so it fails. Every whole text is read; a task holds a quarter of a MB of text in arrays at a time, or
    one text if that is longer.
    """
    docs, row = numbered(docs)
    rows = docs.select(F.col(row).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    measured = rows.mapInArrow(_measure(bands), STATS)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & F.col("in_band"))


def _judge(bands: Bands, text_at: int):
    """The task that lets only rows through that the rules keep, all columns untouched."""
    measure = _measure(bands)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            ids = pa.array(np.arange(n))
            three = pa.RecordBatch.from_arrays([ids, ids, batch.column(text_at)], names=["row", "doc_id", "text"])
            keep = []
            for part in measure(iter([three])):
                words, repeats = part.column(2).to_numpy(), part.column(6).to_numpy()
                keep.append((words >= 50) & (100 * repeats <= 50 * words) & part.column(10).to_numpy(zero_copy_only=False))
            if n:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return task


def keep_good(docs: DataFrame, text_col: str = "text", bands: Bands = Bands()) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with all their columns, whatever their names, in one pass.

    Null, empty and short texts go. A verdict depends on the text alone, so repeated rows go or stay
    together; a text of any length is read whole; a table without rows stays empty.
    """
    return docs.mapInArrow(_judge(bands, docs.columns.index(text_col)), docs.schema)
