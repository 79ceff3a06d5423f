"""Fill-in-the-middle: texts cut at two unit ranks and put together in another order.

A unit is a word with the white space before it, or the white space that ends a text. The units of a text
lie in an indexable skip list: each link of an express lane knows how many units and how many code points
it passes, so going right and down by accumulated widths finds the code point at which any unit ends
without walking over the units before it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.llm.words import SPACE, Words, buffers, cuts

#: The marks before the three parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
#: Of a hundred texts so many are cut, and of a hundred cut ones so many begin with the suffix.
CUT_PERCENT, SPM_PERCENT = 50, 80
SEED = 42
#: Links of a lane that one link of the lane above passes.
FAN = 16


class SkipList:
    """Units in order under express lanes; lane 0 has a link for each unit, each higher one a ``FAN``-th of the links."""

    def __init__(self, points: np.ndarray):
        """``points``: code points of each unit."""
        self.lanes = [(np.ones(len(points), np.int64), points.astype(np.int64))]
        while len(self.lanes[-1][0]) > FAN:
            begins = np.arange(0, len(self.lanes[-1][0]), FAN)
            units, chars = self.lanes[-1]
            self.lanes.append((np.add.reduceat(units, begins), np.add.reduceat(chars, begins)))

    def __len__(self) -> int:
        return int(self.lanes[-1][0].sum())

    def points_before(self, rank: int) -> int:
        """Code points of the first ``rank`` units, by at most ``FAN`` links a lane."""
        if not 0 <= rank <= len(self):
            raise IndexError(rank)
        at = units_passed = points_passed = 0
        for units, points in reversed(self.lanes):
            while at < len(units) and units_passed + units[at] <= rank:
                units_passed += int(units[at])
                points_passed += int(points[at])
                at += 1
            at *= FAN
        return points_passed


def unit_widths(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all units of all texts, and where each text's units begin."""
    data, offsets = words.data, words.offsets
    filled = np.flatnonzero(np.diff(offsets))
    open_ended = filled[SPACE[data[offsets[filled + 1] - 1]]] if len(filled) else filled
    ends = np.concatenate([words.ends, offsets[open_ended + 1]])
    owner = np.concatenate([words.owner, open_ended])
    order = np.lexsort((ends, owner))
    ends, owner = ends[order], owner[order]
    before = np.concatenate([[0], np.cumsum(data >> 6 != 2, dtype=np.int64)])  # code points up to each byte
    begins = np.searchsorted(owner, np.arange(len(offsets)))
    first = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, bool)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    starts = np.where(first, offsets[owner], starts)
    return before[ends] - before[starts], begins


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four numbers below 2**32 that depend on the id alone; a null id is an empty one."""
    hexed = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(hexed[i : i + 8], 16) for i in range(0, 32, 8)]


def transform(text: str, widths: np.ndarray, chance: list[int]) -> tuple[str, int | None, int | None, str]:
    """Form (``plain``, ``psm`` or ``spm``), code points of prefix and middle, and the text in that form."""
    if chance[2] % 100 >= CUT_PERCENT or not text or any(m in text for m in MARKS):
        return "plain", None, None, text
    units = SkipList(widths)
    ranks = sorted(h % (len(units) + 1) for h in chance[:2])
    low, high = map(units.points_before, ranks)
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if chance[3] % 100 < SPM_PERCENT:
        return "spm", low, high - low, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return "psm", low, high - low, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def rebuild(output: str, form: str) -> str:
    """The text before ``transform``, from its output and form alone."""
    if form == "plain":
        return output
    order = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}[form]
    if not output.startswith(order[0]):
        raise ValueError(f"text in form {form} begins with {order[0]}")
    parts, rest = {}, output[len(order[0]) :]
    for mark, following in zip(order, order[1:]):
        parts[mark], found, rest = rest.partition(following)
        if not found:
            raise ValueError(f"text in form {form} has no {following}")
    parts[order[-1]] = rest
    return parts[PREFIX] + parts[MIDDLE] + parts[SUFFIX]


FILLED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType()),
    ]
)


def _fill(seed: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for at, to in cuts(offsets):
                part = offsets[at : to + 1]
                words = Words(data[part[0] : part[-1]], part - part[0], lower=False)
                widths, begins = unit_widths(words)
                raw = words.data.tobytes()
                ids = batch.column(0).slice(at, to - at)
                done = [
                    transform(raw[b:e].decode(), widths[x:y], draws(doc_id, seed))
                    for doc_id, b, e, x, y in zip(ids.to_pylist(), words.offsets[:-1], words.offsets[1:], begins[:-1], begins[1:])
                ]
                form, prefix, middle, output = zip(*done)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, pa.array(np.diff(begins), pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                        pa.array(middle, pa.int64()), pa.array(output, pa.string()),
                    ],
                    names=FILLED.names,
                )

    return task


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n, form, prefix_chars, middle_chars, output``; nothing is shuffled.

    ``n`` counts the units. The cuts and the form follow from the seed and the id, so rows of one id are
    cut at ranks drawn alike and reruns agree. A null text is empty; an empty text, one that holds a mark and
    those not drawn are ``plain``, with null widths and the text as output. A null id draws as an empty one. Other
    columns are left behind, so no name clashes. Whole texts are read, a bounded number of bytes at a
    time or one text if that is longer.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(_fill(seed), FILLED)


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = {name: i for i, name in enumerate(batch.schema.names)}
        outputs, forms = batch.column(at["output"]), batch.column(at["form"])
        _, offsets = buffers(outputs)
        for b, e in cuts(offsets):
            texts = [rebuild(o, f) for o, f in zip(outputs.slice(b, e - b).to_pylist(), forms.slice(b, e - b).to_pylist())]
            part = batch.slice(b, e - b)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "restored"])


def restore(filled: DataFrame) -> DataFrame:
    """``filled`` with ``restored``: the text that ``output`` and ``form`` of each row stand for."""
    schema = T.StructType([*filled.schema.fields, T.StructField("restored", T.StringType())])
    return filled.mapInArrow(_restore, schema)
