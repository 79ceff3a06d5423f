"""Tokens, the BM25 formula, term variants and snippets as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A token is a run of letters and digits of any script.
TOKEN = r"[\p{L}\p{N}]+"
K1 = 1.2
B = 0.75
#: Scores equal to this many decimals are ties.
SCORE_DECIMALS = 9


def tokens(text: Column | str) -> Column:
    """Lower-case tokens of a text, in order."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def bm25(tf: Column, df: Column, length: Column, documents: Column, mean_length: Column) -> Column:
    """Robertson BM25 of one term in one document; always above zero."""
    idf = F.log(1 + (documents - df + 0.5) / (df + 0.5))
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean_length))


def half_keys(term: Column) -> Column:
    """The two halves of a term, each with the term's length: what it is stored under for one-edit look-ups."""
    cut = F.floor(F.length(term) / 2).cast("int")
    size = F.length(term).cast("string")
    return F.array(F.concat(F.lit("<"), size, F.lit(":"), F.substring(term, F.lit(1), cut)), F.concat(F.lit(">"), size, F.lit(":"), F.substring(term, cut + 1, F.length(term))))


def one_edit_keys(text: Column) -> Column:
    """The halves that a term one edit away from ``text``, of its length or one more or less, can share with it.

    An edit falls into one half and leaves the other as it is, at its end of the text. So a fuzzy match is an
    equi-join of these keys with ``half_keys``, followed by an exact test.
    """
    sizes = F.filter(F.transform(F.array(*[F.lit(d) for d in (-1, 0, 1)]), lambda d: F.length(text) + d), lambda n: n > 0)
    halves = F.transform(sizes, lambda n: F.struct(n.cast("string").alias("size"), F.floor(n / 2).cast("int").alias("front"), (n - F.floor(n / 2)).cast("int").alias("back")))
    fronts = F.transform(halves, lambda h: F.concat(F.lit("<"), h["size"], F.lit(":"), F.substring(text, F.lit(1), h["front"])))
    backs = F.transform(halves, lambda h: F.concat(F.lit(">"), h["size"], F.lit(":"), F.substring(text, F.greatest(F.length(text) - h["back"], F.lit(0)) + 1, h["back"])))
    return F.concat(fronts, backs)


def prefix_keys(term: Column) -> Column:
    """First one, two and three characters: the join keys of prefix search."""
    return F.array_distinct(F.array(*[F.substring(term, 1, n) for n in (1, 2, 3)]))


def snippet(text: Column, terms: Column, before: int = 5, width: int = 15) -> Column:
    """Words round the first hit, hits in ``<b>``; empty when no word matches."""
    words = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    hits = F.transform(words, lambda w: F.array_contains(terms, F.lower(w)))
    first = F.array_position(hits, True).cast("int")
    around = F.slice(words, F.greatest(first - before, F.lit(1)), F.lit(width))
    marked = F.transform(
        around, lambda w: F.when(F.array_contains(terms, F.lower(w)), F.concat(F.lit("<b>"), w, F.lit("</b>"))).otherwise(w)
    )
    return F.when(first > 0, F.array_join(marked, " ")).otherwise(F.lit(""))
