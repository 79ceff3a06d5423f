"""Full-text search: an index of postings and BM25 over a table of query clauses.

Queries are rows ``query_id, clause, role, kind, text, boost``:

* ``role``: ``should`` (any of them), ``must`` (all of them), ``must_not``;
* ``clause``: a name that is unique within the query;
* ``kind``: ``term``, ``prefix``, ``fuzzy`` (one edit) or ``phrase`` (tokens in a row);
* ``boost``: factor on the score of the clause.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftgraph.functions.postings import BLOCK, COUNTS, DOCUMENT_MARK, PAIR_BLOCK, POSTING, SLICE, distinct_terms, form_pairs, form_postings, in_slices, to_blocks
from weftgraph.functions.text import SCORE_DECIMALS, bm25, half_keys, one_edit_keys, prefix_keys, snippet, tokens
from weftgraph.operators.filters import where_in
from weftgraph.plans.materialize import materialize
from weftgraph.plans.ordering import check_limit, top_k_per_group
from weftgraph.plans.sizing import BROADCAST_ROWS, broadcast_if_small, fits

# Language names and the codes found in language columns.
LANGUAGES = {"english": "en", "german": "de", "french": "fr", "spanish": "es", "russian": "ru", "italian": "it"}


#: Parts of a stored index, by a hash of the term; a search opens only the parts of its terms.
PARTS = 64
#: The part that holds one row per document instead of postings.
DOCUMENT_PART = -1
#: Tasks that write postings for each split of the input.
SPLIT_TASKS = 16
#: Parts of the table of prefixes and shortened forms, by a hash of the key.
KEY_PARTS = 16
#: Most terms named one by one in a filter on the postings.
NAMED_TERMS = 500
#: Pairs of query and document that a task sums up, as far as ``MOST_TASKS`` tasks suffice.
TASK_PAIRS, MOST_TASKS = 400_000, 20_000
#: Words in at least this share of the documents, and in two, are frequent: where two of them stand side by side,
#: a posting of the pair is stored as well. At most so many words, the commonest first; phrases find the rest by their
#: own postings.
PAIR_SHARE, PAIR_WORDS = 0.01, 50_000

#: Join keys of a vocabulary term by the kind of clause that looks it up.
KEYS = {"prefix": prefix_keys, "fuzzy": half_keys}


class Matched(NamedTuple):
    """What a search reads: postings, one row with the collection's size, and ``(term, df)``."""

    postings: DataFrame
    size: DataFrame
    frequencies: DataFrame


class TextIndex:
    """Postings ``(id, dl, term, tf, positions)``, still to be formed from text or stored at ``path``.

    ``lists`` holds the tokens of every document, one array column per indexed property.

    A stored index is a number of segments that add up: postings and document lengths, counts of terms and of
    documents, and the keys of the terms. Adding documents writes a segment of their own; removing some writes a
    segment with their ids and with negative counts. An object reads the segments it was made with, so
    earlier ones still answer as before.

    With ``pairs`` a stored index also has postings of two neighbouring frequent words, so a phrase of such words
    reads the documents that have them side by side and not every document that has either. Which words are
    frequent is settled by the first segment and kept as a table.
    """

    def __init__(self, lists: DataFrame | None = None, removed: Sequence[str] = (), path: str | None = None,
                 spark: SparkSession | None = None, segments: int = 0, gone: bool = False, pairs: bool = False):
        self.lists = lists
        self.removed = sorted(set(removed))
        self.path = path
        self.spark = spark or lists.sparkSession
        self.segments, self.gone, self.pairs = segments, gone, pairs

    def _columns(self) -> list[str]:
        return [c for c in self.lists.columns if c != "id"]

    def _formed(self, wanted: pa.Array | None = None, positions: bool = True) -> DataFrame:
        columns = self._columns()
        removed = pa.array(self.removed, pa.string()) if self.removed else None

        def run(batches):
            for batch in batches:
                for start in range(0, batch.num_rows, SLICE):
                    yield form_postings(batch.slice(start, SLICE), columns, wanted, removed, positions)

        return self.lists.mapInArrow(run, POSTING + (", positions array<int>" if positions else ""))

    def _blocks(self) -> DataFrame:
        """Rows of ``BLOCK``, to be stored: the shuffle moves a term once for a run of documents."""
        columns = self._columns()
        removed = pa.array(self.removed, pa.string()) if self.removed else None

        def run(batches):
            for batch in batches:
                for part in in_slices(batch, columns):
                    yield to_blocks(form_postings(part, columns, None, removed, True))

        return self.lists.mapInArrow(run, BLOCK)

    def _write_blocks(self, blocks: DataFrame, path: str) -> None:
        """One folder per part, sorted by term inside a file. A part is dealt to tasks by term and first document, so a term
        of every document is spread too; the number of tasks grows with the splits of the input. Tasks are named
        outright: a hash of part and share would put several into one task, which has to sort them all.
        """
        tasks = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), SPLIT_TASKS * self.lists.rdd.getNumPartitions())
        shares = max(1, tasks // PARTS)
        share = F.pmod(F.xxhash64("term", F.col("id")[0]), F.lit(shares))
        # The rows of the documents go with the first part.
        place = F.greatest("part", F.lit(0)) * shares + share
        rows = blocks.repartitionById(PARTS * shares, place.cast("int")).sortWithinPartitions("part", "term")
        rows.write.mode("overwrite").partitionBy("part").parquet(path)

    def _stored(self, name: str, *wanted: Column) -> DataFrame:
        """Stored rows of this object's segments, those ``wanted`` only."""
        rows = self.spark.read.parquet(f"{self.path}/{name}")
        for condition in wanted:
            rows = rows.filter(condition)
        return rows.filter(F.coalesce("segment", F.lit(0)) < self.segments)

    def _entries(self, *wanted: Column, columns: Sequence[str] = ("id", "dl", "tf", "positions")) -> DataFrame:
        """Stored postings, one row each: ``term``, ``columns``, ``part`` and ``segment``."""
        return _opened(self._stored("postings", *wanted), columns)

    def _alive(self, rows: DataFrame) -> DataFrame:
        """Stored postings without those of documents that were removed after their segment was written."""
        if not self.gone:
            return rows
        gone = self._stored("gone").groupBy("id").agg(F.max("segment").alias("gone"))
        left = rows.join(broadcast_if_small(materialize(gone)), "id", "left")
        return left.filter(F.col("gone").isNull() | (F.col("segment") >= F.col("gone"))).drop("gone")

    def postings(self) -> DataFrame:
        """All postings."""
        if self.path:
            rows = self._alive(self._entries(F.col("part") != DOCUMENT_PART))
            return rows.select("id", "dl", "term", "tf", "positions")
        return self._formed().filter(F.col("term") != DOCUMENT_MARK)

    def _counted(self, rows: DataFrame) -> DataFrame:
        """``term, df`` over all segments, without terms that no document has any more."""
        if self.segments == 1:
            return rows.select("term", "df")
        return rows.groupBy("term").agg(F.sum("df").alias("df")).filter("df > 0")

    def matching(self, terms: DataFrame, positions: bool = False) -> Matched:
        """Postings of the given terms, with positions only if asked.

        A stored index is filtered with literals: the parts the terms fall in, the range they span and, if they are
        not many, the terms themselves, so other folders and row groups are not read. What is left over is dropped by the join on the
        term that follows every use. Read from text this is one pass without a shuffle: a bounded set
        of terms goes to the tasks, which form the postings of these only; it is written once because
        counts and scores both need it.
        """
        wanted = terms.select("term").distinct()
        columns = ["id", "dl", "term", "tf", *(["positions"] if positions else [])]
        if self.path:
            kept = [c for c in columns if c != "term"]
            rows = self._alive(self._entries(_named(wanted), columns=kept)).select(columns)
            return Matched(rows, self.documents_indexed(), self.frequencies(wanted))
        wanted = materialize(wanted)
        if fits(wanted, BROADCAST_ROWS):
            listed = wanted.toArrow()["term"].combine_chunks()
            rows = self._formed(listed, positions)
        else:
            rows = self._formed(None, positions).join(wanted, "term", "left_semi")
            rows = rows.unionByName(self._formed(pa.array([], pa.string()), positions))
        rows = materialize(rows)
        postings = rows.filter(F.col("term") != DOCUMENT_MARK)
        df = postings.groupBy("term").agg(F.count("*").alias("df"))
        return Matched(postings, _totals(rows.filter(F.col("term") == DOCUMENT_MARK)), df)

    def frequencies(self, terms: DataFrame) -> DataFrame:
        """``term, df`` of a stored index, for the range that the given terms span."""
        low, high = terms.agg(F.coalesce(F.min("term"), F.lit("")), F.coalesce(F.max("term"), F.lit(""))).first()
        return self._counted(self._stored("terms").filter(F.col("term").between(low, high)))

    def pair_postings(self, wanted: DataFrame) -> DataFrame:
        """Postings of the given pairs of frequent words (column ``term``)."""
        rows = self.spark.read.schema(f"{PAIR_BLOCK}, segment int, part int").parquet(f"{self.path}/pairs")
        rows = rows.filter((F.col("segment") < self.segments) & _named(wanted.select("term").distinct()))
        rows = _opened(rows, ["id", "dl", "tf", "tf_next", "positions"])
        return self._alive(rows).select("id", "dl", "term", "tf", "tf_next", "positions")

    def frequent(self) -> DataFrame:
        """The words whose neighbourhoods are stored; at most ``PAIR_WORDS``."""
        return self.spark.read.schema("term string").parquet(f"{self.path}/frequent")

    def _write_pairs(self, to: "TextIndex", folder: str) -> None:
        if to.segments == 0:
            counted = self.spark.read.schema("term string, df long").parquet(f"{to.path}/terms/{folder}")
            documents = self.spark.read.parquet(f"{to.path}/totals/{folder}").first()["documents"]
            often = counted.filter(F.col("df") >= max(2, PAIR_SHARE * documents)).orderBy(F.desc("df"), "term").limit(PAIR_WORDS)
            often.select("term").write.mode("overwrite").parquet(f"{to.path}/frequent")
        words = to.frequent().toArrow()["term"].combine_chunks()
        columns = self._columns()

        def run(batches):
            for batch in batches:
                for part in in_slices(batch, columns):
                    yield to_blocks(form_pairs(part, columns, words))

        self._write_blocks(self.lists.mapInArrow(run, PAIR_BLOCK).withColumn("part", term_part()), f"{to.path}/pairs/{folder}")

    def vocabulary(self) -> DataFrame:
        """Distinct terms; every task sends each of its terms once."""
        if self.path:
            return self._counted(self._stored("terms")).select("term")
        columns = self._columns()
        words = self.lists.mapInArrow(lambda batches: distinct_terms(batches, columns), "term string").distinct()
        return where_in(words, "term", self.removed, negate=True) if self.removed else words

    def by_key(self, kind: str, asked: DataFrame) -> DataFrame:
        """``__key, term`` of the vocabulary for the keys asked for (column ``__key``), of prefixes or of forms one edit away.

        A stored index keeps them as a table; only the parts of the keys asked for are read.
        """
        if not self.path:
            return self.vocabulary().withColumn("__key", F.explode(KEYS[kind](F.col("term"))))
        parts = [r["part"] for r in asked.select(key_part(F.col("__key")).alias("part")).distinct().collect()]  # KEY_PARTS at most
        rows = self._stored("keys", F.col("part").isin(parts), F.col("kind") == kind)
        rows = rows.select(F.col("key").alias("__key"), "term")
        return rows if self.segments == 1 else rows.distinct()

    def documents_indexed(self) -> DataFrame:
        """One row: number of documents and of tokens."""
        if self.path:
            added = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("documents", "tokens")]
            return self._stored("totals").agg(*added)
        sizes = [F.size(c) for c in self._columns()]
        return _totals(self.lists.select(sum(sizes[1:], sizes[0]).cast("long").alias("dl")))

    def write(self, path: str, pairs: bool = False) -> "TextIndex":
        """Store postings, document lengths, term counts, keys and totals under ``path`` as the first segment.

        ``pairs`` stores neighbouring frequent words too, here and in segments added later.
        """
        return self._write_segment(TextIndex(path=path, spark=self.spark, pairs=pairs))

    def with_pairs(self, source: "TextIndex") -> "TextIndex":
        """This stored index of one segment, written without pairs, with those of ``source``, the text it was formed from."""
        if self.pairs or self.segments != 1:
            raise ValueError("pairs are added to an index of one segment that has none")
        source._write_pairs(TextIndex(path=self.path, spark=self.spark), "segment=0")
        return TextIndex(path=self.path, spark=self.spark, segments=1, gone=self.gone, pairs=True)

    def add(self, new: "TextIndex") -> "TextIndex":
        """This stored index with the documents of ``new``, which is formed from text the same way; their ids must be new."""
        return new._write_segment(self)

    def _write_segment(self, to: "TextIndex") -> "TextIndex":
        """Postings lie in one folder per part, sorted by term. Document lengths are a folder of their own."""
        folder = f"segment={to.segments}"
        part = F.when(F.col("term") == DOCUMENT_MARK, F.lit(DOCUMENT_PART)).otherwise(term_part())
        self._write_blocks(self._blocks().withColumn("part", part), f"{to.path}/postings/{folder}")
        entries = self.spark.read.schema(f"{BLOCK}, part int").parquet(f"{to.path}/postings/{folder}")
        counted = entries.filter(F.col("part") != DOCUMENT_PART).groupBy("term").agg(F.sum(F.size("id").cast("long")).alias("df"))
        counted.repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{to.path}/terms/{folder}")
        marks = _opened(entries.filter(F.col("part") == DOCUMENT_PART), ["id", "dl"])
        _totals(marks).write.mode("overwrite").parquet(f"{to.path}/totals/{folder}")
        words = self.spark.read.schema("term string").parquet(f"{to.path}/terms/{folder}")
        keys = [words.select(F.lit(k).alias("kind"), F.explode(make(F.col("term"))).alias("key"), "term") for k, make in KEYS.items()]
        rows = reduce(DataFrame.unionByName, keys).withColumn("part", key_part(F.col("key")))
        # Each folder's rows go to as many tasks as the shuffle has to give.
        shares = max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")) // (len(KEYS) * KEY_PARTS))
        rows = rows.repartition("kind", "part", F.pmod(F.hash("key"), F.lit(shares))).sortWithinPartitions("kind", "part", "key")
        rows.write.mode("overwrite").partitionBy("kind", "part").parquet(f"{to.path}/keys/{folder}")
        if to.pairs:
            self._write_pairs(to, folder)
        return TextIndex(path=to.path, spark=to.spark, segments=to.segments + 1, gone=to.gone, pairs=to.pairs)

    def remove(self, ids: DataFrame) -> "TextIndex":
        """This stored index without the documents whose ``id`` is in ``ids``; unknown ones change nothing.

        What they counted for is read from their postings, which stay where they are, and written as negative counts.
        """
        folder = f"segment={self.segments}"
        wanted = ids.select(F.col("id").cast("long")).distinct()
        wanted.write.mode("overwrite").parquet(f"{self.path}/gone/{folder}")
        wanted = self.spark.read.schema("id long").parquet(f"{self.path}/gone/{folder}")
        theirs = self._alive(self._entries(columns=["id", "dl"])).join(broadcast_if_small(wanted), "id", "left_semi")
        theirs = materialize(theirs.select("id", "dl", "term"))
        less = theirs.filter(F.col("term") != DOCUMENT_MARK).groupBy("term").agg((-F.count("*")).alias("df"))
        less.repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{self.path}/terms/{folder}")
        sums = _totals(theirs.filter(F.col("term") == DOCUMENT_MARK)).select((-F.col("documents")).alias("documents"), (-F.col("tokens")).alias("tokens"))
        sums.write.mode("overwrite").parquet(f"{self.path}/totals/{folder}")
        return TextIndex(path=self.path, spark=self.spark, segments=self.segments + 1, gone=True, pairs=self.pairs)

    def replace(self, new: "TextIndex") -> "TextIndex":
        """This stored index with the documents of ``new`` in place of those that have their ids."""
        return self.remove(new.lists.select("id")).add(new)


def _opened(blocks: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per posting of rows of lists; lists that are not among ``columns`` are not read."""
    others = [c for c in ("term", "part", "segment") if c in blocks.columns]
    one = {c: F.col("__one")[c] for c in columns}
    named = [(one[c].cast("long") if c in COUNTS else one[c]).alias(c) for c in columns]
    return blocks.select(*others, F.explode(F.arrays_zip(*columns)).alias("__one")).select(*others, *named)


def term_part() -> Column:
    """The part of a stored index that holds a term."""
    return F.pmod(F.xxhash64("term"), F.lit(PARTS)).cast("int")


def _named(wanted: DataFrame) -> Column:
    """A filter with literals: the parts that the distinct terms fall in, the range they span and, if not many, the terms."""
    spans = wanted.groupBy(term_part().alias("part")).agg(
        F.min("term").alias("low"), F.max("term").alias("high"), F.count("*").alias("n"),
        # More than are named anyway need not come to the driver.
        F.when(F.count("*") <= NAMED_TERMS, F.collect_list("term")).alias("named"),
    )
    found = spans.collect()  # at most one row per part
    low, high = min((r["low"] for r in found), default=""), max((r["high"] for r in found), default="")
    inside = F.col("part").isin([r["part"] for r in found]) & F.col("term").between(low, high)
    if sum(r["n"] for r in found) <= NAMED_TERMS:
        inside = inside & F.col("term").isin([t for r in found for t in r["named"]])
    return inside


def key_part(key: Column) -> Column:
    """The part of the key table that holds a key."""
    return F.pmod(F.xxhash64(key), F.lit(KEY_PARTS)).cast("int")


def _totals(marks: DataFrame) -> DataFrame:
    return marks.agg(F.count("*").alias("documents"), F.coalesce(F.sum("dl"), F.lit(0)).alias("tokens"))


def stop_words(language: str) -> list[str]:
    """Spark's stop words of a language."""
    return StopWordsRemover.loadDefaultStopWords(language)


def build_text_index(
    nodes: DataFrame,
    properties: str | Sequence[str],
    language: str = "",
    language_column: str | None = None,
    stop_lists: Mapping[str, Sequence[str]] | None = None,
) -> TextIndex:
    """Index one or several text properties of ``nodes`` (which has an ``id``).

    With ``language_column`` only nodes of ``language`` (default English) are indexed. Stop words
    are left out when a language or lists are given; they still count in the document length.
    """
    names = [properties] if isinstance(properties, str) else list(properties)
    if not names:
        raise ValueError("at least one property is needed")
    if language_column:
        nodes = nodes.filter(F.col(language_column) == LANGUAGES.get(language or "english", language))
    arrays = [F.coalesce(tokens(name), F.array().cast("array<string>")) for name in names]
    lists = nodes.select(F.col("id").cast("long"), *[a.alias(f"t{i}") for i, a in enumerate(arrays)])
    removed = stop_lists[language] if stop_lists else stop_words(language) if language else []
    return TextIndex(lists=lists, removed=removed)


def term_clauses(terms: DataFrame, role: str = "should", kind: str = "term") -> DataFrame:
    """Clauses from ``(query_id, term[, boost])`` rows: one clause per term."""
    boost = F.col("boost").cast("double") if "boost" in terms.columns else F.lit(1.0)
    return terms.select(
        "query_id",
        F.concat_ws(":", F.lit(kind), "term").alias("clause"),
        F.lit(role).alias("role"),
        F.lit(kind).alias("kind"),
        F.col("term").alias("text"),
        boost.alias("boost"),
    )


def expand(clauses: DataFrame, index: TextIndex, kinds: Sequence[str]) -> DataFrame:
    """Clauses to index terms ``(query_id, clause, role, kind, term, boost, shift, size)``.

    Prefix and fuzzy clauses are equi-joined with the vocabulary, never with the postings. Words of phrases that an
    index with pairs finds by a neighbour are left to ``paired_phrases``.
    """
    base = [F.col(c) for c in ("query_id", "clause", "role", "kind", "boost")]
    flat = [F.lit(0).alias("shift"), F.lit(1).alias("size")]
    parts = []
    if "term" in kinds:
        parts.append(clauses.filter("kind = 'term'").select(*base, F.lower("text").alias("term"), *flat))
    if "phrase" in kinds:
        words = phrase_words(clauses, index).filter("NOT joined") if index.pairs else phrase_words(clauses)
        parts.append(words.select(*base, "size", "shift", "term"))
    if "prefix" in kinds:
        asked = clauses.filter("kind = 'prefix'").withColumn("__text", F.lower("text"))
        asked = materialize(asked.withColumn("__key", F.substring("__text", 1, 3)))
        found = asked.join(index.by_key("prefix", asked), "__key").filter(F.col("term").startswith(F.col("__text")))
        parts.append(found.select(*base, "term", *flat))
    if "fuzzy" in kinds:
        asked = clauses.filter("kind = 'fuzzy'").withColumn("__text", F.lower("text"))
        asked = materialize(asked.withColumn("__key", F.explode(one_edit_keys(F.col("__text")))))
        found = asked.join(index.by_key("fuzzy", asked), "__key").filter(F.levenshtein("__text", "term", 1) >= 0)
        parts.append(found.select(*base, "term", *flat).distinct())
    if not parts:
        raise ValueError("kinds must name at least one of term, phrase, prefix, fuzzy")
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def phrase_words(clauses: DataFrame, index: TextIndex | None = None) -> DataFrame:
    """One row per word of every phrase: the clause, ``term, shift, size``.

    With an ``index`` that has pairs, a word that is frequent like the one after it stands for both (``joined``, with
    ``next``), and a frequent word that only the one before it can stand for is left out; ``closing``
    marks the last pair of such a run. ``size`` counts the rows left.
    """
    split = clauses.filter("kind = 'phrase'").withColumn("__words", tokens("text"))
    base = [F.col(c) for c in ("query_id", "clause", "role", "kind", "boost")]
    words = split.select(*base, F.size("__words").alias("size"), F.posexplode("__words").alias("shift", "term"))
    if index is None:
        return words
    flagged = words.join(F.broadcast(index.frequent().withColumn("__often", F.lit(True))), "term", "left")
    phrase = Window.partitionBy("query_id", "clause")
    order = phrase.orderBy("shift")
    often = F.coalesce("__often", F.lit(False))
    flagged = flagged.select(
        *base, "shift", "term", often.alias("often"), F.lead("term").over(order).alias("next"),
        F.lag(often, 1, False).over(order).alias("before"),
        F.lead(often, 1, False).over(order).alias("after"), (~F.lead(often, 2, False).over(order)).alias("closing"),
    )
    flagged = flagged.withColumn("joined", F.col("often") & F.col("after"))
    kept = flagged.filter(F.col("joined") | ~(F.col("often") & F.col("before")))
    return kept.withColumn("size", F.count("*").over(phrase).cast("int")).drop("often", "before", "after")


def paired_phrases(index: TextIndex, clauses: DataFrame, needed: DataFrame, size: DataFrame) -> DataFrame:
    """Rows of phrases found by pairs of frequent words, as ``score`` has them for words of their own.

    A pair counts for its first word, the last of a run for both.
    """
    asked = materialize(phrase_words(clauses, index).filter("joined").withColumnRenamed("term", "first"))
    asked = materialize(asked.withColumn("term", F.concat_ws(" ", "first", "next")))
    words = asked.select(F.explode(F.array("first", "next")).alias("term")).distinct()
    df = index.frequencies(words).join(F.broadcast(words), "term") if fits(words) else index.frequencies(words)
    df = materialize(df)
    first = df.select(F.col("term").alias("first"), F.col("df").alias("df"))
    after = df.select(F.col("term").alias("next"), F.col("df").alias("df_next"))
    weighted = materialize(asked.join(first, "first").join(after, "next").join(needed, "query_id").drop("first", "next"))
    found = index.pair_postings(asked).join(broadcast_if_small(weighted), "term")
    sizes = [size.select("documents").scalar(), size.select(F.col("tokens") / F.col("documents")).scalar()]
    own = bm25(F.col("tf"), F.col("df"), F.col("dl"), *sizes)
    other = bm25(F.col("tf_next"), F.col("df_next"), F.col("dl"), *sizes)
    return found.withColumn("__score", F.col("boost") * (own + F.when(F.col("closing"), other).otherwise(0.0)))


def score(
    index: TextIndex, clauses: DataFrame, kinds: Sequence[str] = ("term", "phrase", "prefix", "fuzzy")
) -> DataFrame:
    """Every ``(query_id, id, score)`` that satisfies its query. ``kinds`` names the clause kinds in use.

    The query terms are broadcast when their number allows; the postings they name are then dealt out by document, once
    and not for every query, and a document is summed up where its postings lie.
    """
    terms = materialize(expand(clauses, index, kinds))
    postings, size, df = index.matching(terms, positions="phrase" in kinds)
    needed = clauses.groupBy("query_id").agg(F.count_distinct(F.when(F.col("role") == "must", F.col("clause"))).alias("musts"))
    weighted = materialize(terms.join(df, "term").join(needed, "query_id"))
    if fits(weighted):
        weighted = F.broadcast(weighted)
        postings = _by_document(postings, weighted, needed.count(), size)
    found = postings.join(weighted, "term").withColumn(
        "__score",
        F.col("boost")
        * bm25(
            F.col("tf"),
            F.col("df"),
            F.col("dl"),
            size.select("documents").scalar(),
            size.select(F.col("tokens") / F.col("documents")).scalar(),
        ),
    )
    if "phrase" in kinds:
        columns = ["query_id", "id", "musts", "role", "clause", "kind", "size", "shift", "positions", "__score"]
        found = found.select(columns)
        if index.pairs:
            found = found.unionByName(paired_phrases(index, clauses, needed, size).select(columns))
        found = _keep_phrases(found, only="term" not in kinds and "prefix" not in kinds and "fuzzy" not in kinds)
    if "prefix" in kinds or "fuzzy" in kinds:
        # One clause may stand for several terms of a document: one row per clause from here on.
        found = found.groupBy("query_id", "id", "musts", "role", "clause").agg(F.sum("__score").alias("__score"))
    kept = F.col("role") != "must_not"
    return (
        found.groupBy("query_id", "id", "musts")
        .agg(
            F.round(F.sum(F.when(kept, F.col("__score"))), SCORE_DECIMALS).alias("score"),
            F.count(F.when(F.col("role") == "must", 1)).alias("__met"),
            F.count(F.when(~kept, 1)).alias("__banned"),
        )
        .filter((F.col("__met") == F.col("musts")) & (F.col("__banned") == 0) & (F.col("score") > 0))
        .select("query_id", "id", "score")
    )


def _by_document(postings: DataFrame, weighted: DataFrame, queries: int, size: DataFrame) -> DataFrame:
    """The postings of the terms in ``weighted``, those of a document in one task, which has ``TASK_PAIRS`` pairs of query and document at most.

    Later groups by query and document need no shuffle of their own.
    """
    named = postings.join(F.broadcast(weighted.select("term").distinct()), "term", "left_semi")
    met = weighted.agg(F.sum("df")).first()[0] or 0
    pairs = min(met, queries * (size.first()["documents"] or 0))
    tasks = max(int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-pairs // TASK_PAIRS))
    return named.repartition(min(tasks, MOST_TASKS), "id")


def _keep_phrases(found: DataFrame, only: bool) -> DataFrame:
    """Drop phrase rows of documents in which the tokens do not stand in a row.

    Positions are shifted to the start of the phrase; the phrase is there when the shifted lists
    of all its tokens share a value. A group holds one row per token of the phrase.
    """
    columns = ["query_id", "id", "musts", "role", "clause", "__score"]
    phrases = (
        found.filter("kind = 'phrase'")
        .withColumn("__starts", F.transform("positions", lambda p: p - F.col("shift")))
        .groupBy("query_id", "id", "musts", "role", "clause", "size")
        .agg(
            F.sum("__score").alias("__score"),
            F.collect_list("__starts").alias("__lists"),
        )
        .filter(F.size("__lists") == F.col("size"))
        .filter(
            F.size(F.aggregate("__lists", F.element_at("__lists", 1), lambda acc, x: F.array_intersect(acc, x))) > 0
        )
    )
    if only:
        return phrases.select(*columns)
    return found.filter("kind <> 'phrase'").select(*columns).unionByName(phrases.select(*columns))


def text_search(
    index: TextIndex | None,
    clauses: DataFrame,
    limit: int = 10,
    kinds: Sequence[str] = ("term", "phrase", "prefix", "fuzzy"),
) -> DataFrame:
    """The best ``limit`` documents of every query: ``query_id, id, score, rank``; none without an index."""
    check_limit(limit)
    if index is None:
        return clauses.sparkSession.createDataFrame([], "query_id long, id long, score double, rank int")
    clauses, same = asked_once(clauses)
    best = top_k_per_group(score(index, clauses, kinds), ["query_id"], [F.desc("score"), F.col("id")], limit)
    return best.withColumnRenamed("query_id", "__first").join(broadcast_if_small(same), "__first").select("query_id", "id", "score", "rank")


def asked_once(clauses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The clauses of one of the queries that ask the same, and ``__first, query_id``: that query and each it stands for.

    Many short queries are often alike; searched one by one, their hits would grow with their number times the documents.
    """
    clauses = materialize(clauses)
    whole = F.sort_array(F.collect_list(F.struct("clause", "role", "kind", "text", "boost")))
    asked = clauses.groupBy("query_id").agg(whole.alias("__whole")).filter("query_id IS NOT NULL")
    first = asked.groupBy("__whole").agg(F.min("query_id").alias("__first"), F.collect_list("query_id").alias("__all"))
    same = materialize(first.select("__first", F.explode("__all").alias("query_id")))
    kept = same.filter("__first = query_id").select("query_id")
    return clauses.join(broadcast_if_small(kept), "query_id", "left_semi"), same


def with_snippets(hits: DataFrame, nodes: DataFrame, clauses: DataFrame, text: str = "text") -> DataFrame:
    """Add a ``snippet`` to hits. Only the texts of the hits are cut and marked."""
    words = (
        clauses.filter("role <> 'must_not'")
        .select("query_id", F.explode(tokens("text")).alias("term"))
        .groupBy("query_id")
        .agg(F.collect_set("term").alias("__terms"))
    )
    texts = nodes.select("id", F.col(text).alias("__text"))
    # A few hits of each query go to the texts, which stay where they are; a query's terms go there once.
    joined = broadcast_if_small(materialize(hits)).join(texts, "id").join(broadcast_if_small(materialize(words)), "query_id")
    return joined.withColumn("snippet", snippet(F.col("__text"), F.col("__terms"))).drop("__terms", "__text")


def keyword_search(index: TextIndex | None, nodes: DataFrame, clauses: DataFrame, k: int = 5, text: str = "text",
                   kinds: Sequence[str] = ("term", "phrase", "prefix", "fuzzy")) -> DataFrame:
    """``query_id, id, score, snippet`` of the best ``k`` documents; no rows without an index."""
    hits = text_search(index, clauses, k, kinds)
    return with_snippets(hits, nodes, clauses, text).select("query_id", "id", "score", "snippet")
