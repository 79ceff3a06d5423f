"""Language identification by rank-order profiles of character n-grams.

A profile lists the most frequent n-grams of a text or of a language. The distance of a text to a
language sums, over the text's n-grams, how far each is out of place in the language's list. The
nearest language is the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.llm.store import numbered, store
from weftgraph.llm.words import buffers, cuts

#: Longest n-gram (three code points fill one 63-bit key), and length of every profile.
LONGEST = 3
PROFILE = 300
#: Most languages whose profiles are sent to a task; more are compared in blocks.
MOST_LANGUAGES = 8_000
UNKNOWN = "und"

_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTERS[0]


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of letters and single blanks, as keys, and their counts.

    Everything but letters counts as a blank; text is lower-cased and words have a blank on either side.
    N-grams never reach over a blank, so ``" a "`` is the longest around a one-letter word.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32).astype(np.int64)
    keep = letters()[points]
    points = np.where(keep, points, 32)
    points = np.concatenate([[32], points, [32]])
    blank = points == 32
    fresh = ~(blank[1:] & blank[:-1])  # one blank between words
    points = points[np.concatenate([[True], fresh])]
    blank = points == 32
    keys = [points[~blank]]
    for size in range(2, LONGEST + 1):
        n = len(points) - size + 1
        if n <= 0:
            break
        key = np.zeros(n, np.int64)
        for i in range(size):
            key = key << 21 | points[i : i + n]
        inside = np.ones(n, bool)
        for i in range(1, size - 1):
            inside &= ~blank[i : i + n]
        keys.append(key[inside])
    return np.unique(np.concatenate(keys), return_counts=True)


def ranked(keys: np.ndarray, counts: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The most frequent keys, the most frequent first; equal counts by key."""
    return keys[np.lexsort((keys, -counts))[:most]]


def _texts(column: pa.Array) -> Iterator[tuple[int, str]]:
    data, offsets = buffers(column)
    for at, to in cuts(offsets):
        raw = data[offsets[at] : offsets[to]].tobytes()
        for i in range(at, to):
            yield i, raw[offsets[i] - offsets[at] : offsets[i + 1] - offsets[at]].decode()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts of each language, added up over a batch."""
    for batch in batches:
        langs = batch.column(0).to_pylist()
        waiting: dict[str, list] = {}

        def totals(lang: str) -> tuple[np.ndarray, np.ndarray]:
            keys, place = np.unique(np.concatenate([k for k, _ in waiting[lang]]), return_inverse=True)
            return keys, np.bincount(place, np.concatenate([c for _, c in waiting[lang]])).astype(np.int64)

        for i, text in _texts(batch.column(1)):
            waiting.setdefault(langs[i], []).append(ngrams(text))
            if len(waiting[langs[i]]) >= 200:
                waiting[langs[i]] = [totals(langs[i])]
        for lang in waiting:
            keys, counts = totals(lang)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts)], names=["lang", "gram", "n"]
            )


def fit(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text") -> dict[str, list[int]]:
    """Profile of each language: its ``PROFILE`` most frequent n-grams over all given texts.

    Rows with a null language or text teach nothing. The driver holds ``PROFILE`` numbers a language. Counts are added up inside the tasks, so a
    language that holds most rows is a few thousand rows by the time they meet.
    """
    counts = (
        labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
        .filter("lang IS NOT NULL AND text IS NOT NULL")
        .mapInArrow(_count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = store(counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= PROFILE), "profiles")
    profiles: dict[str, list[int]] = {}
    for r in top.orderBy("lang", "place").collect():
        profiles.setdefault(r.lang, []).append(r.gram)
    return profiles


DISTANCES = T.StructType(
    [
        T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("far", T.LongType()),
        T.StructField("lang", T.StringType()), T.StructField("most", T.LongType()),
    ]
)


class Places:
    """Where each known n-gram stands in the lists of the languages that have it; languages that lack it take no room."""

    def __init__(self, profiles: dict[str, list[int]]):
        self.langs = sorted(profiles)
        grams = np.concatenate([np.array(profiles[g], np.int64) for g in self.langs] or [np.zeros(0, np.int64)])
        lang = np.repeat(np.arange(len(self.langs)), [len(profiles[g]) for g in self.langs])
        place = np.concatenate([np.arange(len(profiles[g])) for g in self.langs] or [np.zeros(0, np.int64)])
        order = np.argsort(grams, kind="stable")
        self.lang, self.place = lang[order], place[order]
        self.known, begins = np.unique(grams[order], return_index=True)
        self.bounds = np.append(begins, len(grams))

    def distances(self, own: np.ndarray) -> np.ndarray:
        """Out-of-place distance of the ranked n-grams ``own`` to every language; one that a list lacks is ``PROFILE`` off."""
        at = np.searchsorted(self.known, own)
        at[at == len(self.known)] = 0
        rank = np.flatnonzero(self.known[at] == own) if len(self.known) else np.zeros(0, np.int64)
        at = at[rank]
        sizes = self.bounds[at + 1] - self.bounds[at]
        entry = np.arange(int(sizes.sum())) + np.repeat(self.bounds[at] - (np.cumsum(sizes) - sizes), sizes)
        off = np.abs(self.place[entry] - np.repeat(rank, sizes)) - PROFILE
        return PROFILE * len(own) + np.bincount(self.lang[entry], off, minlength=len(self.langs)).astype(np.int64)


def _nearest(profiles: dict[str, list[int]]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places(profiles)

        def one(text: str) -> tuple[int | None, str, int]:
            if not places.langs or not any(map(str.isalpha, text)):
                return None, UNKNOWN, 0
            own = ranked(*ngrams(text))
            out = places.distances(own)
            best = int(out.argmin())
            return int(out[best]), places.langs[best], PROFILE * len(own)

        for batch in batches:
            found = [one(text) for _, text in _texts(batch.column(2))]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=DISTANCES.names)

    return task


def predict(docs: DataFrame, profiles: dict[str, list[int]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``row, doc_id, lang_pred, score``.

    ``lang_pred`` is the nearest language (of equal distances the first by name), ``und`` with score 0
    for a text that is null or has no letter, or when no language was learned. ``score`` is 1 less the
    distance over the largest possible one. The whole text counts. Ids may be null or repeat; other
    columns are left behind. More than ``MOST_LANGUAGES`` languages are compared in blocks of that many, and the
    nearest of the blocks' nearest is the answer.
    """
    docs, row = numbered(docs)
    rows = docs.select(F.col(row).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    langs = sorted(profiles)
    blocks = [langs[i : i + MOST_LANGUAGES] for i in range(0, len(langs), MOST_LANGUAGES)] or [[]]
    found = [rows.mapInArrow(_nearest({g: profiles[g] for g in block}), DISTANCES) for block in blocks]
    nearest = found[0]
    if len(found) > 1:
        for more in found[1:]:
            nearest = nearest.union(more)
        nearest = nearest.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"), F.min(F.struct("far", "lang", "most")).alias("best")
        ).select("row", "doc_id", "best.*")
    score = F.coalesce(1 - F.try_divide("far", "most"), F.lit(0.0))
    return nearest.select("row", "doc_id", F.col("lang").alias("lang_pred"), score.alias("score"))


def fold(id_col: Column, folds: int) -> Column:
    """CRC-32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % folds
