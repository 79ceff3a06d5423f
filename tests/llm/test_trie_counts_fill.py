"""Prefix trie, token counts and fill-in-the-middle against brute force, and row numbers under changed splits."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftgraph.llm import exact, fill, tokencount, trie, warc
from weftgraph.llm.queries import tokenizer_file
from weftgraph.llm.store import is_scan, new_folder, with_row
from weftgraph.llm.words import Words

# prefix trie


def brute_rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + turns[h:]
    return out


def brute_trie(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, ids in members.items():
        below = [n for n in members if n[: len(node)] == node]
        ends = sorted(c for c in ids if len(convs[c]) == len(node))
        out.append(
            (
                min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids),
                sum(len(n) == len(node) + 1 for n in below),
                sum(not any(m[: len(n)] == n and len(m) == len(n) + 1 for m in below) for n in below),
                sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def rows_of(nodes):
    return sorted((tuple(r[c] for c in trie.NODE_COLUMNS) for r in nodes.collect()), key=repr)


def conversations(spark):
    """Copies, shared beginnings, a long one, conversations that end inside others, and families with and without a head."""
    rng = np.random.default_rng(11)
    convs = {}
    for c in [*range(0, 40), *range(100, 130), *range(301, 330), 950, 951]:
        convs[c] = [("user" if d % 2 else "é", f"t{rng.integers(3)}") for d in range(int(rng.integers(1, 9)))]
    for c in range(400, 470):
        convs[c] = [("user", "same"), ("assistant", "same 🙂"), ("user", "")]
    convs[500] = [("user", f"x{i}") for i in range(300)]
    convs[700] = convs[500][:200] + [("user", "else")]
    rows = [(c, d, r, t) for c, turns in convs.items() for d, (r, t) in enumerate(turns)]
    return convs, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)


@pytest.mark.parametrize("container", [10, 150, trie.CONTAINER])
def test_trie_against_brute_force(spark, container):
    convs, df = conversations(spark)
    if container == 150:
        assert rows_of(trie.conversation_trie(df, container)) == brute_trie(convs)
    nodes = trie.prefix_trie(*trie.rebuilt(trie.named_turns(df)), container)
    assert rows_of(nodes) == brute_trie(brute_rebuilt(convs))


def test_trie_of_awkward_rows(spark):
    rows = [
        (7, None, "user", "first"), (7, 0, None, None), (7, 3, "", ""), (7, 3, "", ""), (None, 1, "user", "nobody"),
        (8, 1, "user", "first"), (8, 2, "", None), (9, 5, "", "x" * 100_000), (-3, 0, "user", "first"), (301, 0, "user", "a"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumns({c: F.lit("clash") for c in ("depth", "name", "pos", "conv", "n", "tie")})
    convs = {
        7: [("user", "first"), ("", ""), ("", ""), ("", "")], 8: [("user", "first"), ("", "")], 9: [("", "x" * 100_000)],
        -3: [("user", "first")], 301: [("user", "a")],
    }
    assert rows_of(trie.conversation_trie(df)) == brute_trie(convs)
    # Without the head of its family a conversation of few turns may have none left, and is still a member of the root.
    left = {c: t[zlib.crc32(str(c).encode()) % 6 :] for c, t in convs.items()}
    assert any(not t for t in left.values())
    for container in (2, trie.CONTAINER):
        assert rows_of(trie.prefix_trie(*trie.rebuilt(trie.named_turns(df)), container)) == brute_trie(left)
    none = df.limit(0)
    assert trie.conversation_trie(none).count() == 0
    assert trie.prefix_trie(*trie.rebuilt(trie.named_turns(none))).count() == 0


# token counts


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_counts_against_the_library(spark, docs, data, name):
    path, cache = tokenizer_file(name), new_folder(spark, "test-counts")
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t))
    else:
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.no_truncation()
        count = lambda t: len(model.encode(t, add_special_tokens=False).ids)
    got = tokencount.count_tokens(docs, path, cache).collect()
    want = [(i, len((t or "").encode()), count(t or "")) for i, t, *_ in data]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=repr) == sorted(want, key=repr)


def test_special_strings_and_odd_texts(spark):
    import sentencepiece

    path = tokenizer_file("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["<s>", "</s> a", "<unk>", "▁", "  two  blanks ", "\n\t", "\x00", "ﬁ", "é", "🙂" * 50, "<0x41>", "ab" * 30_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in tokencount.count_tokens(df, path, new_folder(spark, "test-counts")).collect()}
    assert got == {i: len(model.encode(t)) for i, t in enumerate(texts)}


def test_cache_is_used_and_extended(spark, docs, data, none, monkeypatch):
    path, cache = tokenizer_file("piece_bpe_32k.model"), new_folder(spark, "test-counts")
    version = tokencount.tokenizer_version(path)
    distinct = {t or "" for _, t, *_ in data}
    assert tokencount.count_tokens(none, path, cache).count() == 0
    first = sorted(map(repr, tokencount.count_tokens(docs, path, cache).drop("row").collect()))
    stored = lambda: spark.read.parquet(cache).count()
    assert stored() == len(distinct)  # one entry for each distinct text
    # A full cache encodes nothing; a count in it is what comes back, so it is really read from there.
    with monkeypatch.context() as patch:
        patch.setattr(tokencount, "_encode", None)
        assert sorted(map(repr, tokencount.count_tokens(docs, path, cache).drop("row").collect())) == first
    # The next batch adds its new texts only; many of them, so both ways of finding them are used.
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(99, "a new text")], "doc_id long, text string"))
    for few in (tokencount.FEW, 0):
        monkeypatch.setattr(tokencount, "FEW", few)
        monkeypatch.setattr(tokencount, "FEW_SHARE", 1.0)
        grown = new_folder(spark, "test-counts")
        spark.read.parquet(cache).write.partitionBy("version").parquet(grown)
        assert tokencount.count_tokens(more, path, grown).count() == len(data) + 1
        assert spark.read.parquet(grown).count() == len(distinct) + 1
    # Counts of another tokenizer do not mix with these; an entry stored twice counts once.
    spark.read.parquet(cache).write.mode("append").partitionBy("version").parquet(grown)
    tokencount.count_tokens(docs, tokenizer_file("byte_bpe_50k.json"), grown).count()
    assert sorted(map(repr, tokencount.count_tokens(docs, path, grown).drop("row").collect())) == first
    assert spark.read.parquet(grown).filter(F.col("version") != version).count() == len(distinct)


# fill-in-the-middle


def brute_fill(doc_id, text):
    import regex

    units = regex.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = [int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_against_brute_force(spark, docs, data, none):
    rng = np.random.default_rng(13)
    parts = ["a", "bc", " ", "  ", "\n", "\x0b", "\x1c", "é", "日本", "🙂", " ", " ", "<P", ">", "<M>", "word"]
    own = [(i, "".join(rng.choice(parts, int(rng.integers(0, 60)), p=[0.066] * 14 + [0.01, 0.066]))) for i in range(1000, 1600)]
    own += [(i, " " * (i - 1600)) for i in range(1600, 1620)] + [(i, f"x <S> {i}") for i in range(1620, 1660)]
    more = spark.createDataFrame(own, "doc_id long, text string")
    for df, rows in ((docs, [d[:2] for d in data]), (more, own)):
        got = fill.restore(fill.fill_in_middle(df)).collect()
        want = [(i, *brute_fill(i, t or ""), t or "") for i, t in rows]
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert {r.form for r in fill.fill_in_middle(more).collect()} == {"plain", "psm", "spm"}
    assert fill.fill_in_middle(none).count() == 0 == fill.restore(fill.fill_in_middle(none)).count()


def test_skip_list_reaches_every_rank():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 15, 16, 17, 255, 256, 257, 5000):
        widths = rng.integers(1, 9, n)
        units = fill.SkipList(widths)
        assert len(units) == n and len(units.lanes) <= 5
        upto = np.concatenate([[0], np.cumsum(widths)])
        assert [units.points_before(r) for r in range(n + 1)] == upto.tolist()
        with pytest.raises(IndexError):
            units.points_before(n + 1)


def test_units_of_neighbouring_texts():
    texts = ["", " ", "a", " a ", "", "b\n", "  ", "é é"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    widths, begins = fill.unit_widths(Words(np.frombuffer(b"".join(raw), np.uint8), offsets, lower=False))
    assert [widths[b:e].tolist() for b, e in zip(begins[:-1], begins[1:])] == [[], [1], [1], [2, 1], [], [1, 1], [2], [1, 2]]


@pytest.mark.parametrize("output, form", [("x", "psm"), ("<P>a", "psm"), ("<P>a<M>b", "psm"), ("<S>a<M>b", "spm")])
def test_damaged_output_is_an_error(output, form):
    with pytest.raises(ValueError):
        fill.rebuild(output, form)


# row numbers


def test_row_numbers_do_not_move(spark, docs):
    """Other splits, as after a change of the executors, leave every row its number."""
    assert is_scan(docs) and not is_scan(docs.repartition(3)) and not is_scan(docs.limit(5))
    big = spark.range(200_000).select((F.col("id") % 1000).alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    path = new_folder(spark, "test-rows")
    big.coalesce(2).write.option("parquet.block.size", 100_000).parquet(path)
    df = spark.read.parquet(path)
    numbered = with_row(df.select("text", "doc_id"), "row")
    was = {r.text: r.row for r in numbered.collect()}
    try:
        spark.conf.set("spark.sql.files.minPartitionNum", "40")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        again = with_row(spark.read.parquet(path), "row")
        assert again.rdd.getNumPartitions() > numbered.rdd.getNumPartitions()
        assert {r.text: r.row for r in again.collect()} == was and len(set(was.values())) == len(was) == 200_000
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_inputs_that_are_no_scan(spark, docs):
    """A shuffled input gives its rows in another order each time; its numbers are written once."""
    shuffled = docs.repartition(4).orderBy(F.rand())
    numbered = with_row(shuffled, "at")
    assert sorted(map(str, numbered.collect())) == sorted(map(str, numbered.collect()))
    left = exact.drop_exact_copies(shuffled)
    assert left.columns == docs.columns and left.count() == exact.drop_exact_copies(docs).count()
    pages = docs.select(F.lit(5).cast("long").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html")).repartition(3)
    made = warc.page_records(pages)
    assert made.filter("record_type = 'response'").count() == docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert made.select("record_id").distinct().count() == docs.count()
