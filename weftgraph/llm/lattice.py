"""Likelihood of texts under a subword lattice.

Every word is a lattice of vocabulary pieces over its bytes; the weights of all its segmentations add
up by the forward recursion, in logarithms. A text's probability is the product over its words and
the end of text. The piece weights start from the vocabulary's own scores and are fitted to the words
of the training texts by expected counts over all segmentations.

Two passes over the texts and one over the distinct words. Training words are counted in
the tasks first. Frequent words, a bounded list, go to all tasks; only rarer ones meet their counts in
a join, so no word holds more than a bounded part of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.llm.langid import fold
from weftgraph.llm.store import numbered, store
from weftgraph.llm.words import BYTE_BASE, BYTE_WEIGHT, Words, buffers, running, sliced, spans

#: Most words whose counts are sent to all tasks (16 bytes each); the rest are joined.
FREQUENT = 200_000
#: Rounds of expected counts.
ROUNDS = 2
#: Count added to every piece, so that none has probability zero.
PSEUDO_COUNT = 0.1
#: Rank at which the start weights of the vocabulary, 1 / (rank + FLAT), begin to fall.
FLAT = 50.0
#: The word that ends a text has its own key; words never hold a line feed.
END = int(spans(running(BYTE_WEIGHT[np.array([10])], BYTE_BASE), BYTE_BASE, np.array([0]), np.array([1]))[0].astype(np.int64))
WORD_MARK = "▁".encode()
#: Words scored together; bounds the arrays of the recursion.
TOGETHER = 50_000


@dataclass(frozen=True)
class Pieces:
    """A piece table: sorted hashes, log10 weights by the same order, and the length of the longest."""

    hashes: np.ndarray
    weights: np.ndarray
    longest: int
    end: float = 0.0

    @cached_property
    def seen(self) -> np.ndarray:
        """Flags by the low bits of a hash: whether a piece has them. Most spans are ruled out here."""
        flags = np.zeros(1 << 21, bool)
        flags[(self.hashes & np.uint64(len(flags) - 1)).astype(np.int64)] = True
        return flags

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "seen"}


def read_pieces(model_file: str) -> Pieces:
    """Pieces of a sentencepiece vocabulary as byte strings, weighted by their scores' order.

    The score of a merge vocabulary is its negative rank; weight falls as one over the rank. Byte pieces
    stand for single bytes, so every text has a segmentation; control pieces are left out.
    """
    import sentencepiece

    vocabulary = sentencepiece.SentencePieceProcessor(model_file=model_file)
    scores: dict[bytes, float] = {}
    for i in range(vocabulary.get_piece_size()):
        if vocabulary.is_control(i) or vocabulary.is_unknown(i):
            continue
        name = vocabulary.id_to_piece(i)
        text = bytes([int(name[3:5], 16)]) if vocabulary.is_byte(i) else name.encode()
        if text:
            scores[text] = max(scores.get(text, -np.inf), vocabulary.get_score(i))
    for byte in range(256):
        scores.setdefault(bytes([byte]), -float(len(scores)))
    texts = list(scores)
    rank = np.argsort(np.argsort(-np.array([scores[t] for t in texts]), kind="stable"), kind="stable")
    weights = 1 / (rank + FLAT)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    hashes = spans(running(BYTE_WEIGHT[raw], BYTE_BASE), BYTE_BASE, starts, ends)
    order = np.argsort(hashes)
    return Pieces(hashes[order], np.log10(weights / weights.sum())[order], max(map(len, texts)))


class Lattice:
    """The lattices of many words, by increasing length of their start."""

    def __init__(self, pieces: Pieces, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """``data`` holds the words one after the other, each behind the word mark, at ``starts:ends``."""
        self.starts, self.ends, self.data_size = starts, ends, len(data)
        n = len(data)
        sums = running(BYTE_WEIGHT[data], BYTE_BASE)
        left = np.repeat(ends, ends - starts) - np.arange(n)  # bytes to the end of the word
        begin, end, piece = [], [], []
        for size in range(1, min(pieces.longest, int(left.max(initial=0))) + 1):
            b = np.flatnonzero(left >= size)
            h = spans(sums, BYTE_BASE, b, b + size)
            maybe = pieces.seen[(h & np.uint64(len(pieces.seen) - 1)).astype(np.int64)]
            b, h = b[maybe], h[maybe]
            place = np.searchsorted(pieces.hashes, h)
            place[place == len(pieces.hashes)] = 0
            hit = pieces.hashes[place] == h
            begin.append(b[hit])
            end.append(b[hit] + size)
            piece.append(place[hit])
        self.begin, self.end, self.piece = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (begin, end, piece))
        # Arcs by how far from the start of their word they end; those of one step are handled together.
        word_start = np.repeat(starts, ends - starts)
        depth = self.end - word_start[self.begin]
        order = np.lexsort((self.end, depth))
        self.begin, self.end, self.piece = self.begin[order], self.end[order], self.piece[order]
        self.steps = np.searchsorted(depth[order], np.arange(1, int(depth.max()) + 2)) if len(depth) else np.zeros(1, np.int64)

    def forward(self, weights: np.ndarray) -> np.ndarray:
        """log10 of the weight of all ways from the start of its word to each position."""
        alpha = np.full(self.data_size + 1, -np.inf)
        alpha[self.starts] = 0.0
        # A word starts where the one before ends, so its end is kept apart.
        total = np.full(len(self.starts), -np.inf)
        last = np.full(self.data_size + 1, -1, np.int64)
        last[self.ends] = np.arange(len(self.ends))
        for b, e in zip(self.steps[:-1], self.steps[1:]):
            if b == e:
                continue
            to, value = self.end[b:e], alpha[self.begin[b:e]] + weights[self.piece[b:e]]
            first = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
            top = np.maximum.reduceat(value, first)
            sizes = np.diff(np.append(first, len(to)))
            summed = top + np.log10(np.add.reduceat(10 ** (value - np.repeat(top, sizes)), first))
            to = to[first]
            ending = last[to] >= 0
            total[last[to[ending]]] = summed[ending]
            alpha[to[~ending]] = summed[~ending]
        self.alpha = alpha
        return total

    def expected(self, weights: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over all segmentations of all words, each word ``counts`` times."""
        total = self.forward(weights)
        beta = np.full(self.data_size + 1, -np.inf)
        owner = np.zeros(self.data_size + 1, np.int64)
        owner[self.starts] = np.arange(len(self.starts))
        owner = np.maximum.accumulate(owner)
        last = np.zeros(self.data_size + 1, bool)
        last[self.ends] = True
        # Arcs by the distance of their begin to the end of their word: the words are read right to left.
        reach = self.ends[owner[self.begin]] - self.begin
        order = np.lexsort((self.begin, reach))
        begin, end, piece, reach = self.begin[order], self.end[order], self.piece[order], reach[order]
        steps = np.searchsorted(reach, np.arange(1, int(reach.max()) + 2)) if len(reach) else [0]
        for b, e in zip(steps[:-1], steps[1:]):
            if b == e:
                continue
            onward = np.where(last[end[b:e]], 0.0, beta[end[b:e]])
            value = onward + weights[piece[b:e]]
            first = np.flatnonzero(np.concatenate([[True], begin[b:e][1:] != begin[b:e][:-1]]))
            top = np.maximum.reduceat(value, first)
            sizes = np.diff(np.append(first, e - b))
            beta[begin[b:e][first]] = top + np.log10(np.add.reduceat(10 ** (value - np.repeat(top, sizes)), first))
        onward = np.where(last[end], 0.0, beta[end])
        part = 10 ** (self.alpha[begin] + weights[piece] + onward - total[owner[begin]])
        return np.bincount(piece, part * counts[owner[begin]], minlength=len(weights))


def marked(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words one after the other, each behind the word mark."""
    mark = np.frombuffer(WORD_MARK, np.uint8)
    sizes = ends - starts + len(mark)
    to = np.cumsum(sizes)
    out = np.empty(int(to[-1]) if len(to) else 0, np.uint8)
    begins = to - sizes
    for i, byte in enumerate(mark):
        out[begins + i] = byte
    inner = sizes - len(mark)
    at = np.arange(int(inner.sum())) - np.repeat(np.cumsum(inner) - inner, inner)
    out[np.repeat(begins + len(mark), inner) + at] = data[np.repeat(starts, inner) + at]
    return out, begins, to


def word_scores(pieces: Pieces, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """log10 probability of each word, the sum over all its segmentations."""
    found = [np.zeros(0)]
    for at in range(0, len(starts), TOGETHER):
        lattice = Lattice(pieces, *marked(data, starts[at : at + TOGETHER], ends[at : at + TOGETHER]))
        found.append(lattice.forward(pieces.weights))
    return np.concatenate(found)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of each slice with their counts; the end of text is a word."""
    for batch in batches:
        for at, to, words in sliced(batch.column(0), most=4 << 20):
            keys, first, counts = np.unique(words.hashes(), return_index=True, return_counts=True)
            raw = words.data.tobytes()
            texts = [raw[b:e] for b, e in zip(words.starts[first], words.ends[first])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(keys.astype(np.int64), END)), pa.array([*texts, b"\n"], pa.binary()),
                    pa.array(np.append(counts, to - at).astype(np.int64)),
                ],
                names=["key", "word", "n"],
            )


def word_counts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """``key, word, n``: every distinct word of all texts, in lower case, with its count."""
    found = texts.select(text_col).mapInArrow(_count_words, "key long, word binary, n long")
    return store(found.groupBy("key", "word").agg(F.sum("n").alias("n")), "word-counts")


def fit(counts: DataFrame, pieces: Pieces, rounds: int = ROUNDS) -> Pieces:
    """Piece weights by expected counts over the segmentations of all training words."""
    now = pieces
    for _ in range(rounds):
        seen = now

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(seen.weights))
            for batch in batches:
                data, offsets = buffers(batch.column(0))
                n = batch.column(1).to_numpy()
                for at in range(0, len(n), TOGETHER):
                    part = offsets[at : at + TOGETHER + 1]
                    lattice = Lattice(seen, *marked(data, part[:-1], part[1:]))
                    total += lattice.expected(seen.weights, n[at : at + TOGETHER].astype(float))
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["piece", "uses"])

        words = counts.filter(F.col("key") != END).select("word", "n")
        rows = words.mapInArrow(expect, "piece long, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).collect()
        uses = np.full(len(now.weights), PSEUDO_COUNT)
        for r in rows:
            uses[r.piece] += r.uses
        ends = (counts.filter(F.col("key") == END).agg(F.sum("n")).first()[0] or 0) + PSEUDO_COUNT
        total = uses.sum() + ends
        now = Pieces(now.hashes, np.log10(uses / total), now.longest, float(np.log10(ends / total)))
    return now


SCORED = T.StructType(
    [
        T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()), T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType()), T.StructField("rare_keys", T.BinaryType()), T.StructField("rare_counts", T.BinaryType()),
    ]
)


def _score_words(pieces: Pieces):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            scores = word_scores(pieces, data, offsets[:-1], offsets[1:])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(scores)], names=["key", "n", "score"])

    return task


def _score(pieces: Pieces, keys: np.ndarray, counts: np.ndarray, lattice_scores: np.ndarray, size: int):
    """``keys``: sorted keys of the frequent words; ``size``: N + V + 1."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = np.log10((counts + 1.0) / size)
        end_place = np.searchsorted(keys, END)
        has_end = end_place < len(keys) and keys[end_place] == END
        for batch in batches:
            for at, to, words in sliced(batch.column(2)):
                n = to - at
                distinct, first, place = np.unique(words.hashes().view(np.int64), return_index=True, return_inverse=True)
                where = np.searchsorted(keys, distinct)
                where[where == len(keys)] = 0
                known = keys[where] == distinct if len(keys) else np.zeros(len(distinct), bool)
                scores = np.empty(len(distinct))
                scores[known] = lattice_scores[where[known]]
                scores[~known] = word_scores(pieces, words.data, words.starts[first[~known]], words.ends[first[~known]])
                owner = words.owner
                score = np.bincount(owner, scores[place], minlength=n) + pieces.end
                token_known = known[place]
                base_score = np.bincount(owner[token_known], base[where[place[token_known]]], minlength=n)
                n_known = np.bincount(owner[token_known], minlength=n)
                if has_end:
                    base_score, n_known = base_score + base[end_place], n_known + 1
                else:
                    base_score = base_score + np.log10(1.0 / size)
                rare = np.flatnonzero(~token_known)
                # One entry for each text and rare word.
                pair = owner[rare] * np.int64(len(distinct)) + place[rare]
                pair, times = np.unique(pair, return_counts=True)
                rare_owner = pair // max(1, len(distinct))
                rare_keys = distinct[pair % max(1, len(distinct))]
                cut = np.searchsorted(rare_owner, np.arange(n + 1))
                times = times.astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, n), batch.column(1).slice(at, n), pa.array(words.counts + 1, pa.int64()),
                        pa.array(n_known, pa.int64()), pa.array(base_score), pa.array(score),
                        pa.array([rare_keys[b:e].tobytes() for b, e in zip(cut[:-1], cut[1:])], pa.binary()),
                        pa.array([times[b:e].tobytes() for b, e in zip(cut[:-1], cut[1:])], pa.binary()),
                    ],
                    names=SCORED.names,
                )

    return task


def _unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
        times = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32)
        _, offsets = buffers(batch.column(1))
        rows = np.repeat(batch.column(0).to_numpy(), np.diff(offsets) // 8)
        for at in range(0, len(keys), 100_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[at : at + 100_000]), pa.array(keys[at : at + 100_000]), pa.array(times[at : at + 100_000].astype(np.int64))],
                names=["row", "key", "times"],
            )


def score(
    docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2
) -> DataFrame:
    """Per row of ``docs``: ``row, doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Texts whose CRC-32 of the id modulo ``folds`` is ``held`` are held out; the others, and rows with a
    null id, teach. Tokens are words in ASCII lower case and one end. ``base_score`` adds
    ``log10((c + 1) / (N + V + 1))`` over the tokens, ``score`` the log10 probabilities of the lattices and
    of the end. A null text is empty: one token. With nothing to learn from, the weights stay
    those of the vocabulary, and N and V are 0.
    """
    held_out = F.coalesce(fold(F.col(id_col), folds) == held, F.lit(False))
    docs, row = numbered(docs)
    rows = docs.select(
        F.col(row).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), held_out.alias("held_out")
    )
    counts = word_counts(rows.filter(~F.col("held_out")).select("text"))
    pieces = fit(counts, read_pieces(model_file))
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    tokens, size = totals["n"] or 0, (totals["n"] or 0) + totals["v"] + 1

    # The lowest count at which the words still fit the list that goes to all tasks.
    classes = counts.groupBy(F.ceil(F.log2(F.col("n") + 1) * 4).alias("level")).agg(F.count("*").alias("words"), F.min("n").alias("least"))
    least, fits = None, 0
    for r in classes.orderBy(F.desc("level")).collect():
        fits += r.words
        if fits > FREQUENT:
            break
        least = r.least
    frequent = counts.filter(F.col("n") >= least) if least else counts.limit(0)
    frequent = frequent.select("key", "word", "n").mapInArrow(_score_words(pieces), "key long, n long, score double")
    rows_ = sorted(frequent.collect())
    keys, n = np.array([r.key for r in rows_], np.int64), np.array([r.n for r in rows_], np.int64)
    lattice_scores = np.array([r.score for r in rows_], float)

    scored = store(rows.select("row", "doc_id", "text").mapInArrow(_score(pieces, keys, n, lattice_scores, size), SCORED), "scored")
    rare = scored.select("row", "rare_keys", "rare_counts").mapInArrow(_unfold, "row long, key long, times long")
    known = counts.filter(F.col("n") < least) if least else counts
    met = rare.join(known.select("key", "n"), "key", "left")
    more = met.groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 1.0) / size)).alias("more_base"),
    )
    out = scored.drop("rare_keys", "rare_counts").join(more, "row", "left")
    return out.select(
        "row",
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        "score",
    )
