"""Near duplicates by MinHash: bands of universal hash minima, checked links, components.

A text's shingles are its five-word windows. Every text gets ``BANDS * ROWS`` minima; texts that agree
in all rows of a band share a bucket. Texts of equal words are one representative from the start.

Buckets are never expanded into pairs. First each member meets the smallest member of its bucket, and
the checked links give components. Only buckets that still hold several components are compared
further, in pieces of a bounded number of members: there the pairs that the signatures leave possible
are checked on the full shingle sets, until each is linked, by itself or over others, or ruled
out. So every candidate pair of a bucket is either within a component, ruled out by 250 minima, or
checked, and what the tasks give back are at most as many links as a piece has members.
"""

from __future__ import annotations

from collections.abc import Iterator
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.llm.graph import components
from weftgraph.llm.runs import name_runs
from weftgraph.llm.store import numbered, store
from weftgraph.llm.words import Words, mix, running, sliced, spans, WORD_BASE
from weftgraph.plans.sizing import broadcast_if_small

SHINGLE = 5
#: Link where 100 * intersection >= PERCENT * union.
PERCENT = 75
#: A pair at exactly the threshold shares no band with probability (1 - 0.75**5)**50, about 1 in 740,000.
BANDS, ROWS = 50, 5
#: A pair goes to the full check if so many of its minima agree; five standard deviations below 75%. Their lowest byte is
#: kept: equal minima always agree in it, and one in 256 others, so it only lets more pairs through.
LEAST_AGREE = int(BANDS * ROWS * 0.61)
#: Signatures compared with each other in one piece of a bucket.
BLOCK = 256

_rng = np.random.default_rng(20)
FACTORS = _rng.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)

SIGNED = T.StructType(
    [
        T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()), T.StructField("form", T.BinaryType()),
        T.StructField("bands", T.BinaryType()), T.StructField("minima", T.BinaryType()),
    ]
)


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every shingle, by text; repeated ones included.

    A text of one to four words is one shingle; a text without words has none.
    """
    hashes = words.hashes()
    first, windows = words.windows(SHINGLE, hashes)
    owner = words.owner[first] if len(first) else np.zeros(0, np.int64)
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    if not len(short):
        return windows, owner
    whole = spans(running(hashes, WORD_BASE), WORD_BASE, words.bounds[short], words.bounds[short + 1])
    owner = np.concatenate([owner, short])
    order = np.argsort(owner, kind="stable")
    return np.concatenate([windows, whole])[order], owner[order]


def distinct_shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The shingle sets, sorted within each text: hashes, and where each text's begin."""
    hashes, owner = shingles(words)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[fresh], owner[fresh]
    return hashes, np.searchsorted(owner, np.arange(len(words.counts) + 1))


def signatures(hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Minima of all hash functions ``a * x + b`` modulo 2**64 for each (non-empty) set."""
    out = np.empty((len(begins), BANDS * ROWS), np.uint64)
    work = np.empty_like(hashes)
    for i in range(BANDS * ROWS):
        np.multiply(hashes, FACTORS[i], out=work)
        work += OFFSETS[i]
        out[:, i] = np.minimum.reduceat(work, begins)
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, to, words in sliced(batch.column(2)):
            hashes, begins = distinct_shingles(words)
            sizes = np.diff(begins)
            full = np.flatnonzero(sizes)
            bands: list[bytes | None] = [None] * (to - at)
            minima: list[bytes | None] = [None] * (to - at)
            if len(full):
                least = signatures(hashes, begins[:-1][full])
                keys = np.zeros((len(full), BANDS), np.uint64)
                for r in range(ROWS):
                    keys = keys * np.uint64(0x9E3779B97F4A7C15) + mix(least[:, r::ROWS].copy())
                keys = mix(keys + np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
                low = least.astype(np.uint8)
                for i, doc in enumerate(full):
                    bands[doc], minima[doc] = keys[i].tobytes(), low[i].tobytes()
            raw = words.data.tobytes()
            forms = [
                hashlib.blake2b(b" ".join(raw[b:e].split()), digest_size=16).digest()
                for b, e in zip(words.offsets[:-1], words.offsets[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(at, to - at), batch.column(1).slice(at, to - at), pa.array(sizes, pa.int64()),
                    pa.array(forms, pa.binary()), pa.array(bands, pa.binary()), pa.array(minima, pa.binary()),
                ],
                names=SIGNED.names,
            )


def _unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text and band."""
    for batch in batches:
        keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
        rows = np.repeat(batch.column(0).to_numpy(), BANDS)
        for at in range(0, len(rows), 100_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[at : at + 100_000]), pa.array(rows[at : at + 100_000])], names=["key", "row"]
            )


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose minima agree often enough."""
    for batch in batches:
        left = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)
        right = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)
        keep = pa.array((left == right).sum(axis=1) >= LEAST_AGREE)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full shingle sets overlap enough."""
    for batch in batches:
        n = batch.num_rows
        for at in range(0, n, 256):
            part = batch.slice(at, 256)
            sets = []
            for column in (2, 3):
                found: list[np.ndarray] = []
                for _, _, words in sliced(part.column(column)):
                    hashes, begins = distinct_shingles(words)
                    found += [hashes[b:e] for b, e in zip(begins[:-1], begins[1:])]
                sets.append(found)
            keep = []
            for x, y in zip(*sets):
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= PERCENT * (len(x) + len(y) - common))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep)], names=["a", "b"])


def overlaps(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Which of the other sets link with ``own``; all sets are sorted."""
    sizes = np.array([len(x) for x in others])
    flat = np.concatenate(others)
    place = np.searchsorted(own, flat)
    place[place == len(own)] = 0
    common = np.add.reduceat((own[place] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
    return 100 * common >= PERCENT * (len(own) + sizes - common)


def piece_links(
    one: np.ndarray, two: np.ndarray, label: np.ndarray, minima: np.ndarray, sets: list[np.ndarray]
) -> Iterator[tuple[int, int]]:
    """Links between members of different components, as many as join them (indices into the arrays).

    Each of ``one`` meets each of ``two`` that is not in its component by then. The likely ones are tried
    first, a few at a time; a link makes one component of two, so there are fewer links than members.
    """
    label = label.copy()
    for i in one:
        agree = (minima[two] == minima[i]).sum(axis=1)
        near = two[(agree >= LEAST_AGREE) & (label[two] != label[i])]
        near = near[np.argsort(-(minima[near] == minima[i]).sum(axis=1), kind="stable")]
        size = 1
        while len(near):
            for j in near[:size][overlaps(sets[i], [sets[k] for k in near[:size]])]:
                if label[j] != label[i]:
                    yield int(i), int(j)
                    label[label == label[j]] = label[i]
            near = near[size:]
            near = near[label[near] != label[i]]
            size *= 8


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Pieces with more than one component, and the places in them of the two blocks to compare.

    Rows come sorted by piece; a piece has at most two blocks. Columns: bucket, first block, second
    block, own block, row, component, minima, and more.
    """
    held: pa.Table | None = None

    def parted(table: pa.Table) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
        piece = np.stack([table[i].to_numpy() for i in range(3)])
        cut = np.flatnonzero((piece[:, 1:] != piece[:, :-1]).any(axis=0)) + 1
        own, label = table[3].to_numpy(), table[5].to_numpy()
        for b, e in zip(np.concatenate([[0], cut]), np.concatenate([cut, [table.num_rows]])):
            if e - b < 2 or label[b:e].min() == label[b:e].max():
                continue
            one = two = np.arange(e - b)
            if piece[1][b] != piece[2][b]:
                one, two = one[own[b:e] == piece[1][b]], two[own[b:e] == piece[2][b]]
            yield table.slice(b, e - b).combine_chunks(), one, two

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        piece = np.stack([table[i].to_numpy() for i in range(3)])
        cut = np.flatnonzero((piece[:, 1:] != piece[:, :-1]).any(axis=0)) + 1
        last = int(cut[-1]) if len(cut) else 0
        if last:
            yield from parted(table.slice(0, last))
        held = table.slice(last).combine_chunks()
    if held is not None:
        yield from parted(held)


def _minima(part: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(part[6].to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)


HOPEFUL = "bucket long, one int, two int, own int, row long, component long"


def _hopeful(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of a piece whose minima leave a link to another component possible; only these need their texts."""
    for part, one, two in _pieces(batches):
        minima, label = _minima(part), part[5].to_numpy()
        near = np.zeros(part.num_rows, bool)
        for i in one:
            agree = two[(label[two] != label[i]) & ((minima[two] == minima[i]).sum(axis=1) >= LEAST_AGREE)]
            near[agree] = True
            near[i] |= len(agree) > 0
        if near.any():
            kept = part.select(list(range(6))).filter(pa.array(near)).combine_chunks()
            yield from kept.to_batches()


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Checked links that join components inside each piece of a bucket; the text follows the minima."""
    for part, one, two in _pieces(batches):
        rows, minima = part[4].to_numpy(), _minima(part)
        sets: list[np.ndarray] = []
        for _, _, words in sliced(part[7]):
            hashes, begins = distinct_shingles(words)
            sets += [hashes[x:y] for x, y in zip(begins[:-1], begins[1:])]
        found = list(piece_links(one, two, part[5].to_numpy(), minima, sets))
        if found:
            left, right = rows[[i for i, _ in found]], rows[[j for _, j in found]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(left, right)), pa.array(np.maximum(left, right))], names=["a", "b"])


PAIR = "a long, b long"


def _bodies(texts: DataFrame, wanted: DataFrame, name: str) -> DataFrame:
    """The texts of the rows ``wanted``, written once."""
    wanted = store(wanted.distinct(), f"{name}-rows")
    return store(texts.join(broadcast_if_small(wanted), "row", "left_semi"), f"{name}-texts")


def _checked(pairs: DataFrame, signed: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """Those of ``pairs`` (``a``, ``b``, distinct) that link."""
    minima = signed.select("row", "minima")
    pairs = (
        pairs.join(minima.toDF("a", "left"), "a")
        .join(minima.toDF("b", "right"), "b")
        .select("a", "b", "left", "right")
        .mapInArrow(_agreeing, PAIR)
    )
    pairs = store(pairs, f"{name}-possible")
    bodies = _bodies(texts, pairs.select(F.col("a").alias("row")).union(pairs.select("b")), name)
    with_both = pairs.join(bodies.toDF("b", "right"), "b").join(bodies.toDF("a", "left"), "a")
    return store(with_both.select("a", "b", "left", "right").mapInArrow(_linked, PAIR), f"{name}-links")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """Per row of ``docs``: ``row, doc_id, n_shingles, component_id, kept``.

    Words are runs of other than white space, ASCII letters in lower case. ``component_id`` is the
    smallest id that links reach (its own where there is none); the row of that id is kept, the first
    one if the id repeats. Rows without words link with nothing. A null text has no words; a null id
    counts as larger than any.
    """
    docs, row = numbered(docs, row_col)
    rows = docs.select(F.col(row).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = store(rows.mapInArrow(_sign, SIGNED), "signatures")
    worded = signed.filter("n_shingles > 0")
    classes = store(
        name_runs(worded.select("form", "row"), ["form"], ["row"], ["row"], lead="row", name="forms").select("row", "lead"),
        "classes",
    )
    copies = store(classes.filter("row <> lead").select("row"), "copies")
    leaders = worded.join(broadcast_if_small(copies), "row", "left_anti")

    keys = leaders.select("row", "bands").mapInArrow(_unfold, "key long, row long")
    buckets = store(
        name_runs(keys, ["key"], ["row"], ["row"], lead="row", hash_col="key", name="bands", only_repeated=True)
        .filter("repeated")
        .select(F.col("name").alias("bucket"), "row", "lead"),
        "buckets",
    )
    texts = rows.select("row", "text")
    stars = buckets.filter("row <> lead").select(F.col("lead").alias("a"), F.col("row").alias("b")).distinct()
    stars = store(stars, "stars")
    links = _checked(stars, signed, texts, "stars")
    linked = store(components(links), "components")

    # What the stars left open: buckets of three and more with several components.
    labelled = buckets.join(linked.withColumnRenamed("node", "row"), "row", "left").select(
        "bucket", "row", F.coalesce("component", "row").alias("component")
    )
    labelled = store(labelled, "labelled")
    open_ = labelled.groupBy("bucket").agg(
        F.count("*").alias("members"), F.min("component").alias("low"), F.max("component").alias("high")
    ).filter("members > 2 AND low <> high")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    open_ = store(open_.select("bucket", blocks.alias("blocks")), "open-buckets")
    left_open = store(labelled.join(open_, "bucket"), "open-members")
    minima = signed.select("row", "minima")

    def by_piece(rows: DataFrame) -> DataFrame:
        return rows.repartition("bucket", "one", "two").sortWithinPartitions("bucket", "one", "two")

    placed = (
        left_open.withColumn("own", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
        .join(minima, "row")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "bucket", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "own", "row", "component", "minima"
        )
    )
    # Signatures meet in all pieces of a bucket, texts only where two signatures leave a link possible.
    hopeful = store(by_piece(placed).mapInArrow(_hopeful, HOPEFUL), "hopeful")
    bodies = _bodies(texts, hopeful.select("row"), "open")
    # A member meets its signature and text once; its pieces, as many as its bucket has blocks at most, are a list till then.
    members = hopeful.groupBy("bucket", "row", "component").agg(F.collect_list(F.struct("one", "two", "own")).alias("pieces"))
    sent = members.join(minima, "row").join(bodies, "row").withColumn("piece", F.explode("pieces"))
    sent = sent.select("bucket", "piece.one", "piece.two", "piece.own", "row", "component", "minima", "text")
    links = store(links.union(by_piece(sent).mapInArrow(_across, PAIR)), "links")
    linked = store(components(links), "components")

    member = classes.join(linked.withColumnRenamed("node", "lead"), "lead", "left").select(
        "row", F.coalesce("component", "lead").alias("component")
    )
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row"))
    member = store(member.join(signed.select("row", "doc_id"), "row"), "members")
    groups = (
        member.groupBy("component").agg(F.min(place).alias("stays"), F.count("*").alias("n")).filter("n > 1")
        .select("component", F.col("stays.doc_id").alias("component_id"), F.col("stays.row").alias("stays"))
    )
    grouped = member.join(broadcast_if_small(store(groups, "groups")), "component").select("row", "component_id", "stays")
    grouped = grouped.withColumn("in_group", F.lit(True))
    return signed.select("row", "doc_id", "n_shingles").join(grouped, "row", "left").select(
        "row", "doc_id", "n_shingles",
        F.when(F.col("in_group"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("in_group"), F.col("row") == F.col("stays")).otherwise(True).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near copies, the one ``near_groups`` keeps; all columns stay.

    Rows without words (null, empty or blank text) are no copies of each other and stay. Of rows with
    one id the first stays. A table without rows stays empty; a text of any length is compared whole.
    """
    rows, row = numbered(docs)
    gone = near_groups(rows, id_col, text_col, row).filter("NOT kept").select(F.col("row").alias(row))
    return rows.join(broadcast_if_small(store(gone, "near-copies")), row, "left_anti").drop(row)
