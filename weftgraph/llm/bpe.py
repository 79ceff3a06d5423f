"""Byte-level BPE encoding and decoding by rounds of numpy merges over many words at once.

The text is cut into pieces at changes of character class. The distinct pieces a task has not met yet
go through the merges together: all their symbols lie in one flat array, every adjacent pair is looked up by
binary search in the sorted pair keys, and in each round every piece merges its pair of lowest rank. A piece of
thousands of bytes would need as many rounds; it takes its pairs from a heap instead.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.llm.store import free_name
from weftgraph.llm.words import BYTE_BASE, BYTE_WEIGHT, buffers, byte_spans, cuts, running

# Classes of code points, and the apostrophe endings that are pieces of their own.
WHITE, LETTER, NUMBER, OTHER = range(4)
#: Fixed values of the byte-level vocabularies: white space (the controls 28 to 31 do not count) and endings.
WHITE_SPACE = r"[\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Bytes of distinct pieces a task remembers before it starts anew.
REMEMBERED_BYTES = 4 << 20
#: Bytes of text tokenised together.
TEXT_BYTES = 1 << 18
#: Bytes from which a piece is merged alone, by a heap.
LONG_PIECE = 2048
NONE = np.iinfo(np.int64).max


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabulary files, by letter.

    Printable Latin-1 stands for itself; the other bytes follow, in order, from code point 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Pair keys in sorted order with their rank and the merged id; bytes of each id; special texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        ids = spec["model"]["vocab"]
        size = max(ids.values(), default=-1) + 1
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([size, *(i + 1 for i in added.values())])
        self.text = [b""] * self.size
        for token, i in ids.items():
            self.text[i] = bytes(letters[c] for c in token)
        for token, i in added.items():
            self.text[i] = token.encode()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([ids[a] * self.size + ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)[order]
        self.byte_id = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.byte_id[byte] = ids[letter]
        self.special = added
        longest_first = sorted((t.encode() for t in added), key=len, reverse=True)
        self.special_texts = re.compile(b"|".join(map(re.escape, longest_first))) if added else None
        lengths = np.array([len(t) for t in self.text])
        self.token_starts = np.concatenate([[0], np.cumsum(lengths)])
        self.token_bytes = np.frombuffer(b"".join(self.text), np.uint8)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index into the sorted pairs, or -1."""
        key = left * self.size + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, at, -1) if len(self.keys) else np.full(len(key), -1)

    def merge(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the symbols of many pieces (``owner`` is ascending) until no known pair is left."""
        done_symbols, done_owner = [], []
        pair = self._pairs(symbols, owner)
        while True:
            rank = np.where(pair >= 0, self.ranks[pair], NONE)
            piece_starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else []
            if not len(piece_starts):
                break
            lowest = np.minimum.reduceat(rank, piece_starts)
            sizes = np.diff(np.append(piece_starts, len(owner)))
            active = np.repeat(lowest != NONE, sizes)
            if not active.all():  # finished pieces leave the array
                done_symbols.append(symbols[~active])
                done_owner.append(owner[~active])
                symbols, owner, pair, rank = symbols[active], owner[active], pair[active], rank[active]
                sizes, lowest = sizes[lowest != NONE], lowest[lowest != NONE]
                if not len(owner):
                    break
            hit = rank == np.repeat(lowest, sizes)
            # In a row of overlapping hits (a a a) every second one merges, from the left.
            at = np.flatnonzero(hit)
            new_row = np.concatenate([[True], (np.diff(at) != 1) | (owner[at[1:]] != owner[at[:-1]])])
            place = np.arange(len(at)) - np.flatnonzero(new_row)[np.cumsum(new_row) - 1]
            at = at[place % 2 == 0]
            symbols = symbols.copy()
            symbols[at] = self.merged[pair[at]]
            stays = np.ones(len(symbols), bool)
            stays[at + 1] = False
            # Only pairs next to a merge change.
            touched = np.zeros(len(symbols), bool)
            touched[at] = True
            touched[np.maximum(at - 1, 0)] = True
            symbols, owner, pair, touched = symbols[stays], owner[stays], pair[stays], touched[stays]
            # The symbol before a merge may itself be a merge whose right half went; look again there.
            touched[:-1] |= touched[1:]
            again = np.flatnonzero(touched)
            pair[again] = self._pairs_at(symbols, owner, again)
        if not done_symbols:
            return symbols, owner
        symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return symbols[order], owner[order]

    def merge_long(self, symbols: np.ndarray) -> list[int]:
        """The same merges for one piece: always the pair of lowest rank, of equal ones the first, in n log n steps."""
        sym = symbols.tolist()
        n = len(sym)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        found = self.look_up(symbols[:-1], symbols[1:])
        known = np.flatnonzero(found >= 0)
        heap = list(zip(self.ranks[found[known]].tolist(), known.tolist()))
        heapq.heapify(heap)

        def push(i: int) -> None:
            pair = self.pair.get(sym[i] * self.size + sym[right[i]])
            if pair is not None:
                heapq.heappush(heap, (pair[0], i))

        while heap:
            rank, i = heapq.heappop(heap)
            j = right[i]
            if sym[i] < 0 or j >= n:
                continue
            pair = self.pair.get(sym[i] * self.size + sym[j])
            if pair is None or pair[0] != rank:
                continue  # a neighbour was merged since
            sym[i], sym[j], right[i] = pair[1], -1, right[j]
            if right[j] < n:
                left[right[j]] = i
                push(i)
            if left[i] >= 0:
                push(left[i])
        return [s for s in sym if s >= 0]

    @cached_property
    def pair(self) -> dict[int, tuple[int, int]]:
        """Rank and merged id by pair key."""
        return dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.merged.tolist())))

    def merge_all(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the pieces ``data[begin:end]`` after all merges, and the piece of each, ascending."""
        short = np.flatnonzero(ends - begins < LONG_PIECE)
        symbols = self.byte_id[gather(data, begins[short], ends[short])]
        symbols, owner = self.merge(symbols, np.repeat(short, ends[short] - begins[short]))
        if len(short) == len(begins):
            return symbols, owner
        parts, owners = [symbols], [owner]
        for i in np.flatnonzero(ends - begins >= LONG_PIECE):
            parts.append(np.array(self.merge_long(self.byte_id[data[begins[i] : ends[i]]]), np.int64))
            owners.append(np.full(len(parts[-1]), i))
        symbols, owner = np.concatenate(parts), np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return symbols[order], owner[order]

    def _pairs(self, symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
        return self._pairs_at(symbols, owner, np.arange(len(symbols)))

    def _pairs_at(self, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        pair = np.full(len(at), -1, np.int64)
        inner = at < len(symbols) - 1
        i = at[inner]
        same = owner[i] == owner[i + 1]
        found = self.look_up(symbols[i], symbols[i + 1])
        pair[inner] = np.where(same, found, -1)
        return pair


_CLASSES: list[np.ndarray] = []


def classes() -> np.ndarray:
    """Class of every code point."""
    if not _CLASSES:
        kinds = np.full(0x110000, OTHER, np.uint8)
        points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, WHITE_SPACE + "+")):
            for found in regex.finditer(pattern, points):
                kinds[[ord(c) for c in found.group()]] = kind
        _CLASSES.append(kinds)
    return _CLASSES[0]


def piece_starts(points: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Where the pieces begin, as flags over code points. ``edge`` marks the first code point of each text.

    A piece is a run of letters, of numbers or of other signs, each with one blank before it if there
    is one, or what is left of a run of white space. An apostrophe ending is split off when the
    apostrophe opens its run.
    """
    n = len(points)
    kind = classes()[points]
    white = kind == WHITE
    start = edge.copy()
    if n > 1:
        inner = ~edge[1:]
        changes = kind[1:] != kind[:-1]
        start[1:] |= inner & ~white[1:] & changes & (points[:-1] != 32)
        start[1:] |= inner & white[1:] & changes
        last_white = white[1:-1] & white[:-2] & ~white[2:] & ~edge[1:-1] & ~edge[2:]
        start[1:-1] |= last_white
    quotes = np.flatnonzero((points == 39) & start)
    # Code points after a quote in the same text; -1 beyond its end.
    one = np.full(len(quotes), -1, np.int64)
    two = np.full(len(quotes), -1, np.int64)
    has_one = quotes + 1 < n
    has_one[has_one] = ~edge[quotes[has_one] + 1]
    one[has_one] = points[quotes[has_one] + 1]
    has_two = has_one & (quotes + 2 < n)
    has_two[has_two] = ~edge[quotes[has_two] + 2]
    two[has_two] = points[quotes[has_two] + 2]
    length = np.zeros(len(quotes), np.int64)
    for ending in ENDINGS:
        fits = one == ord(ending[0])
        if len(ending) == 2:
            fits &= two == ord(ending[1])
        length[fits & (length == 0)] = len(ending)
    quotes, length = quotes[length > 0], length[length > 0]
    start[quotes + 1] = False
    after = quotes + 1 + length
    start[after[after < n]] = True
    return start


class Encoder:
    """Encodes texts with one vocabulary and remembers the pieces it has merged.

    Pieces are found by 64-bit hash and then compared byte by byte with the remembered ones; they never become
    Python objects.
    """

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # of the known pieces, sorted
        self.slots = np.zeros(0, np.int64)
        self.n = self.held = 0
        self.flat = np.zeros(1024, np.uint32)
        self.ends = np.zeros(1025, np.int64)  # the ids of piece i lie at ends[i]:ends[i + 1] of flat
        self.bytes = np.zeros(1024, np.uint8)
        self.byte_ends = np.zeros(1025, np.int64)  # its bytes at byte_ends[i]:byte_ends[i + 1] of bytes
        for text, i in self.vocabulary.special.items():
            raw = np.frombuffer(text.encode(), np.uint8)
            begin, end = np.array([0]), np.array([len(raw)])
            hashes = byte_spans(raw, running(BYTE_WEIGHT[raw], BYTE_BASE), begin, end)
            self._learn(hashes, np.array([i], np.int64), np.array([0], np.int64), raw, end)

    def _learn(self, hashes: np.ndarray, symbols: np.ndarray, owner: np.ndarray, raw: np.ndarray, sizes: np.ndarray) -> None:
        """Remember pieces by their sorted hashes; ``owner`` is the piece of each symbol, ascending; ``raw`` their bytes."""
        n, m = self.n, len(hashes)
        self.flat = _append(self.flat, int(self.ends[n]), symbols)
        self.ends = _append(self.ends, n + 1, self.ends[n] + np.cumsum(np.bincount(owner, minlength=m)))
        self.bytes = _append(self.bytes, int(self.byte_ends[n]), raw)
        self.byte_ends = _append(self.byte_ends, n + 1, self.byte_ends[n] + np.cumsum(sizes))
        place = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, place, hashes)
        self.slots = np.insert(self.slots, place, np.arange(n, n + m))
        self.n += m

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts ``data[offsets[i]:offsets[i + 1]]`` in one array, and where each text's begin."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        raw = data.tobytes()
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        at = np.append(np.flatnonzero(data >> 6 != 2), len(data))  # first byte of each code point
        edge = np.zeros(len(points) + 1, bool)
        edge[np.searchsorted(at, offsets)] = True
        special = self._special_spans(raw, offsets)
        for begin, end in special:
            edge[np.searchsorted(at, [begin, end])] = True
        start = piece_starts(points, edge[:-1])
        for begin, end in special:
            b, e = np.searchsorted(at, [begin, end])
            start[b + 1 : e] = False
        begins = at[:-1][start]
        ends = np.append(begins[1:], len(data))
        hashes = byte_spans(data, running(BYTE_WEIGHT[data], BYTE_BASE), begins, ends)
        distinct, first, piece = np.unique(hashes, return_index=True, return_inverse=True)
        if self.held > REMEMBERED_BYTES:
            self._forget()
        place = np.searchsorted(self.hashes, distinct)
        place[place == len(self.hashes)] = 0
        new = self.hashes[place] != distinct if self.n else np.ones(len(distinct), bool)
        if new.any():
            b, e = begins[first[new]], ends[first[new]]
            self.held += int((e - b).sum())
            self._learn(distinct[new], *self.vocabulary.merge_all(data, b, e), gather(data, b, e), e - b)
            place = np.searchsorted(self.hashes, distinct)
        slots = self.slots[place][piece]
        flat, starts, stops = self.flat, self.ends[slots], self.ends[slots + 1]
        other = self._differ(data, begins, ends, slots)
        if len(other):  # pieces that share a hash with another one
            symbols, owner = self.vocabulary.merge_all(data, begins[other], ends[other])
            stop = len(flat) + np.cumsum(np.bincount(owner, minlength=len(other)))
            flat = np.concatenate([flat, symbols.astype(np.uint32)])
            starts[other], stops[other] = np.concatenate([[len(self.flat)], stop[:-1]]), stop
        sizes = np.concatenate([[0], np.cumsum(stops - starts)])
        return gather(flat, starts, stops), sizes[np.searchsorted(begins, offsets)]

    def _differ(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Pieces whose bytes are not those remembered under their hash; the pieces cover ``data`` from end to end."""
        first, last = self.byte_ends[slots], self.byte_ends[slots + 1]
        same = last - first == ends - begins
        if same.all():
            equal = gather(self.bytes, first, last) == data
            return np.flatnonzero(~np.logical_and.reduceat(equal, begins)) if not equal.all() else np.zeros(0, np.int64)
        equal = np.zeros(len(data), bool)
        inside = np.repeat(same, ends - begins)
        equal[inside] = gather(self.bytes, first[same], last[same]) == data[inside]
        return np.flatnonzero(~np.logical_and.reduceat(equal, begins))

    def _special_spans(self, raw: bytes, offsets: np.ndarray) -> list[tuple[int, int]]:
        """Byte spans of special texts, none across two texts."""
        if self.vocabulary.special_texts is None:
            return []
        found = []
        search = self.vocabulary.special_texts.search
        hit = search(raw)
        while hit:
            begin, end = hit.span()
            text_end = int(offsets[np.searchsorted(offsets, begin, "right")])
            if end <= text_end:
                found.append((begin, end))
                hit = search(raw, end)
            else:
                hit = search(raw, begin + 1)
        return found


def _append(array: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
    """``array`` with ``values`` from ``at`` on, twice as long as often as needed."""
    while len(array) < at + len(values):
        array = np.concatenate([array, np.zeros(len(array), array.dtype)])
    array[at : at + len(values)] = values
    return array


def gather(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``flat[start:end]`` of all spans, one after the other."""
    sizes = ends - starts
    total = int(sizes.sum())
    if not total:
        return flat[:0]
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return flat[np.arange(total) + shift]


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col``: the token ids of the whole text as little-endian unsigned 32-bit integers.

    As the vocabulary's own library does without adding special tokens: a special text inside a text
    is its one token. A null or empty text has no tokens; each row stands for itself, so ties and repeats do not
    matter; a text of any length is encoded whole. All columns stay; if one is called ``ids_col``, the
    new one, always the last, has underscores behind that name. Nothing is shuffled. Use ``unpack`` for an array.
    """
    at = docs.columns.index(text_col)
    ids_col = free_name(docs, ids_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(ids_col, T.BinaryType(), False)])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            data, offsets = buffers(batch.column(at))
            for first, end in cuts(offsets, TEXT_BYTES):
                inner = offsets[first : end + 1]
                ids, begins = encoder.encode(data[inner[0] : inner[-1]], inner - inner[0])
                raw = ids.astype("<u4", copy=False).tobytes()
                ids = pa.array([raw[4 * b : 4 * e] for b, e in zip(begins[:-1], begins[1:])], pa.binary())
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([*part.columns, ids], names=schema.names)

    return docs.mapInArrow(task, schema)


def decode(docs: DataFrame, vocabulary: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with ``text_col``: the text of the packed ids, special tokens included.

    Bytes that are no UTF-8 become U+FFFD. A null list of ids is the empty text. An id the vocabulary
    does not have is an error. The new column is the last; its name gives way as in ``encode``.
    """
    text_col = free_name(docs, text_col)
    at = docs.columns.index(ids_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(text_col, T.StringType(), False)])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(vocabulary)
        for batch in batches:
            data, offsets = buffers(batch.column(at))
            for first, end in cuts(offsets, TEXT_BYTES):
                ids = data[offsets[first] : offsets[end]].view("<u4").astype(np.int64)
                text = gather(words.token_bytes, words.token_starts[ids], words.token_starts[ids + 1]).tobytes()
                sizes = np.concatenate([[0], np.cumsum(words.token_starts[ids + 1] - words.token_starts[ids])])
                inner = sizes[(offsets[first : end + 1] - offsets[first]) // 4]
                texts = [text[b:e].decode("utf-8", "replace") for b, e in zip(inner[:-1], inner[1:])]
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=schema.names)

    return docs.mapInArrow(task, schema)


def unpack(ids: str = "ids"):
    """The packed ids as an array of longs."""
    quads = F.regexp_extract_all(F.hex(ids), F.lit("(.{8})"), F.lit(1))

    def number(quad):
        swapped = F.concat(*[F.substring(quad, at, 2) for at in (7, 5, 3, 1)])
        return F.conv(swapped, 16, 10).cast("long")

    return F.transform(quads, number)
