from __future__ import annotations

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that the operators use themselves.
    "row string, size string, kept string, name string, lead string, copies string"
)


def rows(*docs):
    return [(i, t, lang, src, len(t or ""), "r", "s", "k", "n", "l", "c") for i, t, lang, src in docs]


PROSE = (
    "the quick brown fox jumps over a lazy dog while seven wise owls watch from an old oak tree near the quiet river "
    "where children play every summer and their parents talk about weather work music and distant places they hope to see "
    "before winter brings snow again to these hills that nobody has ever measured with any care or particular interest"
)


def edge_docs():
    long = " ".join(f"w{i * 7919 % 10007}" for i in range(12_000))
    near = PROSE.split()
    near[3] = "cat"
    return rows(
        (1, PROSE, "en", "a"),
        (2, PROSE, "en", "b"),
        (2, PROSE, "en", "b"),  # a repeated row
        (3, None, "en", None),
        (4, "", None, "a"),
        (5, "one two", "en", ""),
        (6, "ONE  two\n", "en", "é"),
        (7, " ".join(near), "de", "a"),
        (8, long, "de", "c"),
        (9, long + " x", "de", "c"),
        (None, "no id here but some words", None, None),
        (10, "\n \t", "en", "a"),
        (11, "a b \u0001 日本語 🙂", "ja", "a"),
        (12, "x y z\n" * 200, "en", "a"),
        (13, PROSE + "\n" + PROSE, "en", "z"),
        (14, long, "de", "c"),
        (15, "12 34 !!", "en", "a"),
    )


@pytest.fixture(scope="session")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edge") / "documents.parquet")
    spark.createDataFrame(edge_docs(), SCHEMA).repartition(3, "n_chars").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def data(docs):
    return [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
