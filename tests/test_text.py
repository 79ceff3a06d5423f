"""Full-text search against answers worked out by hand and a brute-force scorer."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weftgraph.operators import text

BODIES = {
    1: "machine learning and neural networks",
    2: "the machine stopped; learning did not",
    3: "graph databases store graphs",
    4: "Learning machine learning, machine by machine",
    5: "12345 678",
    6: "Maschinelles Lernen und die Graphen",
}


@pytest.fixture(scope="module")
def nodes(spark):
    rows = [(i, body, "de" if i == 6 else "en") for i, body in BODIES.items()]
    return spark.createDataFrame(rows, "id long, text string, lang string")


@pytest.fixture(scope="module")
def index(nodes):
    return text.build_text_index(nodes, "text")


def clauses(spark, *rows, query_id=0):
    """Rows ``(role, kind, text[, boost])``."""
    data = [(query_id, str(i), r[0], r[1], r[2], float(r[3]) if len(r) > 3 else 1.0) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "query_id long, clause string, role string, kind string, text string, boost double")


def ids(hits):
    return [r.id for r in hits.orderBy("query_id", "rank").collect()]


def words(body):
    return re.findall(r"\w+", body.lower())


def brute(query, boosts=None):
    docs = {i: words(b) for i, b in BODIES.items()}
    mean = sum(map(len, docs.values())) / len(docs)
    scores = {}
    for i, tokens in docs.items():
        counts = Counter(tokens)
        total = 0.0
        for n, term in enumerate(query):
            df = sum(term in d for d in docs.values())
            if counts[term]:
                idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
                tf = counts[term]
                total += (boosts or [1] * len(query))[n] * idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(tokens) / mean))
        if total:
            scores[i] = total
    return scores


def test_scores_equal_the_formula(spark, index):
    hits = text.score(index, clauses(spark, ("should", "term", "machine"), ("should", "term", "Learning")))
    found = {r.id: r.score for r in hits.collect()}
    expected = brute(["machine", "learning"])
    assert found.keys() == expected.keys()
    assert all(math.isclose(found[i], expected[i], abs_tol=1e-8) for i in found)


def test_boost(spark, index):
    hits = text.score(index, clauses(spark, ("should", "term", "machine", 3), ("should", "term", "learning", 0.5)))
    expected = brute(["machine", "learning"], [3, 0.5])
    assert all(math.isclose(r.score, expected[r.id], abs_tol=1e-8) for r in hits.collect())


def test_must_should_must_not(spark, index):
    must = clauses(spark, ("must", "term", "machine"), ("must", "term", "neural"), ("should", "term", "stopped"))
    assert ids(text.text_search(index, must)) == [1]
    banned = clauses(spark, ("should", "term", "learning"), ("must_not", "term", "neural"))
    assert sorted(ids(text.text_search(index, banned))) == [2, 4]
    assert ids(text.text_search(index, clauses(spark, ("must", "term", "machine"), ("must", "term", "absent")))) == []


def test_phrase(spark, index):
    found = text.text_search(index, clauses(spark, ("should", "phrase", "machine learning")))
    assert sorted(ids(found)) == [1, 4]
    assert ids(text.text_search(index, clauses(spark, ("should", "phrase", "machine by machine")))) == [4]
    mixed = clauses(spark, ("must", "phrase", "machine learning"), ("must_not", "term", "neural"))
    assert ids(text.text_search(index, mixed)) == [4]


def test_prefix_and_fuzzy(spark, index):
    assert sorted(ids(text.text_search(index, clauses(spark, ("should", "prefix", "graph"))))) == [3, 6]
    assert ids(text.text_search(index, clauses(spark, ("should", "prefix", "m")), limit=10, kinds=["prefix"])) != []
    for misspelt in ("grap", "graphh", "grapj", "graph"):
        assert ids(text.text_search(index, clauses(spark, ("should", "fuzzy", misspelt)))) == [3]
    assert ids(text.text_search(index, clauses(spark, ("should", "fuzzy", "gra")))) == []
    # A must clause that stands for several terms of one document is met once.
    assert ids(text.text_search(index, clauses(spark, ("must", "prefix", "graph"), ("must", "term", "store")))) == [3]


def test_no_hits_no_index_and_limits(spark, index):
    asked = clauses(spark, ("should", "term", "anything"))
    assert ids(text.text_search(index, asked)) == []
    assert ids(text.text_search(None, asked)) == []
    assert text.keyword_search(None, spark.createDataFrame([], "id long, text string"), asked).count() == 0
    for limit in (0, True, "5"):
        with pytest.raises(ValueError):
            text.text_search(index, asked, limit)


def test_language(spark, nodes):
    german = text.build_text_index(nodes, "text", "german", "lang")
    assert ids(text.text_search(german, clauses(spark, ("should", "term", "graphen")))) == [6]
    # "und" and "die" are stop words, English texts are not in this index.
    assert ids(text.text_search(german, clauses(spark, ("should", "term", "und"), ("should", "term", "machine")))) == []
    assert german.documents_indexed().first().documents == 1


def test_several_properties(spark):
    nodes = spark.createDataFrame([(1, "red apple", "pie tart"), (2, "apple pie", None)], "id long, title string, body string")
    index = text.build_text_index(nodes, ["title", "body"])
    assert tuple(index.documents_indexed().first()) == (2, 6)
    assert sorted(ids(text.text_search(index, clauses(spark, ("should", "term", "pie"))))) == [1, 2]
    # A phrase does not run from one property into the next.
    assert ids(text.text_search(index, clauses(spark, ("should", "phrase", "apple pie")))) == [2]
    with pytest.raises(ValueError):
        text.build_text_index(nodes, [])


def test_stored_index_gives_the_same(spark, index, tmp_path):
    stored = index.write(str(tmp_path / "index"))
    asked = clauses(
        spark, ("should", "term", "learning"), ("should", "phrase", "machine learning"), ("should", "fuzzy", "grap"), ("should", "prefix", "neur")
    )
    rows = [tuple(r) for r in text.text_search(index, asked).orderBy("rank").collect()]
    assert [tuple(r) for r in text.text_search(stored, asked).orderBy("rank").collect()] == rows != []
    assert tuple(stored.documents_indexed().first()) == tuple(index.documents_indexed().first())
    assert stored.vocabulary().exceptAll(index.vocabulary()).count() == 0


def test_more_terms_than_the_bound(spark, index, monkeypatch):
    asked = clauses(spark, ("should", "term", "machine"), ("should", "term", "graph"))
    expected = [tuple(r) for r in text.text_search(index, asked).orderBy("rank").collect()]
    monkeypatch.setattr(text, "BROADCAST_ROWS", 1)
    assert [tuple(r) for r in text.text_search(index, asked).orderBy("rank").collect()] == expected


def test_snippet(spark, nodes, index):
    asked = clauses(spark, ("should", "term", "neural"), ("should", "term", "absent"))
    hit = text.keyword_search(index, nodes, asked).collect()
    assert [(h.id, h.snippet) for h in hit] == [(1, "machine learning and <b>neural</b> networks")]
    # A hit whose text holds none of the words keeps an empty snippet.
    other = nodes.withColumn("text", F.lit("nothing here"))
    assert text.keyword_search(index, other, asked).first().snippet == ""


def test_many_queries_at_once(spark, index):
    both = clauses(spark, ("should", "term", "neural")).unionByName(clauses(spark, ("must", "term", "graph"), query_id=1))
    rows = [(r.query_id, r.id) for r in text.text_search(index, both).orderBy("query_id").collect()]
    assert rows == [(0, 1), (1, 3)]


def test_added_and_removed_documents_equal_a_rebuild(spark, nodes, tmp_path):
    def found(index):
        asked = clauses(
            spark, ("should", "term", "learning"), ("should", "phrase", "machine learning"), ("should", "fuzzy", "grap"), ("should", "prefix", "neur")
        )
        hits = [tuple(r) for r in text.text_search(index, asked).orderBy("rank").collect()]
        words = sorted(r.term for r in index.vocabulary().collect())
        return hits, words, tuple(index.documents_indexed().first()), index.postings().count()

    first = text.build_text_index(nodes.filter("id <= 3"), "text").write(str(tmp_path / "index"))
    was = found(first)
    grown = first.add(text.build_text_index(nodes.filter("id > 3"), "text"))
    assert found(grown) == found(text.build_text_index(nodes, "text"))
    less = grown.remove(spark.createDataFrame([(2,), (4,), (4,), (99,)], "id long"))
    assert found(less) == found(text.build_text_index(nodes.filter("id NOT IN (2, 4)"), "text"))
    # A document that comes again, changed, counts once; removing it twice takes it off once.
    changed = nodes.withColumn("text", F.when(F.col("id") == 4, "neural graph learning").when(F.col("id") == 1, "nothing else").otherwise(F.col("text")))
    again = less.replace(text.build_text_index(changed.filter("id IN (1, 4)"), "text"))
    assert found(again) == found(text.build_text_index(changed.filter("id <> 2"), "text"))
    assert found(again.remove(spark.createDataFrame([(2,)], "id long"))) == found(again)
    assert found(first) == was  # earlier versions answer as before


def test_keys_are_stored(spark, nodes, tmp_path):
    """Prefix and fuzzy terms are looked up in a table; the vocabulary is not taken apart again."""
    stored = text.build_text_index(nodes, "text").write(str(tmp_path / "index"))
    for kind in ("prefix", "fuzzy"):
        plan = text.expand(clauses(spark, ("should", kind, "graph")), stored, [kind])._jdf.queryExecution().executedPlan().toString()
        scan = next(line for line in plan.splitlines() if "FileScan" in line)
        assert "/keys" in scan and "part" in scan.split("PartitionFilters: [")[1].split("]")[0] and "Generate" not in plan


def test_many_terms_are_named_by_their_range(spark, nodes, tmp_path, monkeypatch):
    stored = text.build_text_index(nodes, "text").write(str(tmp_path / "index"))
    asked = clauses(spark, *[("should", "term", w) for w in ("machine", "graph", "databases", "learning", "absent")])
    want = [tuple(r) for r in text.text_search(stored, asked).orderBy("rank").collect()]
    monkeypatch.setattr(text, "NAMED_TERMS", 2)
    assert [tuple(r) for r in text.text_search(stored, asked).orderBy("rank").collect()] == want != []


def test_phrases_by_pairs_of_frequent_words(spark, tmp_path, monkeypatch):
    """Phrases of frequent, rare, repeated and unknown words score as without pairs, also after documents came and went."""
    monkeypatch.setattr(text, "PAIR_SHARE", 0.3)
    dice = random.Random(5)
    words = [f"w{i}" for i in range(12)]
    weights = [2.0**-i for i in range(12)]  # the first few are frequent, the last ones rare
    bodies = [(i, " ".join(dice.choices(words, weights, k=dice.randrange(0, 40))), f"w0 w1 {i}") for i in range(60)]
    docs = spark.createDataFrame(bodies, "id long, text string, title string")
    plain = text.build_text_index(docs, ["text", "title"])
    rows = []
    for query in range(60):
        for clause in range(dice.randrange(1, 4)):
            phrase = " ".join(dice.choices([*words, "unknown"], [*weights, 0.02], k=dice.randrange(0, 6)))
            role = dice.choice(["should", "should", "must", "must_not"])
            rows.append((query, str(clause), role, dice.choice(["phrase", "phrase", "term"]), phrase, dice.choice([1.0, 2.5])))
    asked = spark.createDataFrame(rows, "query_id long, clause string, role string, kind string, text string, boost double")

    def found(index):
        hits = text.text_search(index, asked, 100, ["term", "phrase"])
        return sorted((r.query_id, r.id, round(r.score, 7)) for r in hits.collect())

    stored = plain.write(str(tmp_path / "whole"), pairs=True)
    often = {r.term for r in stored.frequent().collect()}
    assert {"w0", "w1"} <= often and not {"w10", "w11"} & often
    want = found(plain)
    assert len(want) > 500 and found(stored) == want
    first = text.build_text_index(docs.filter("id < 40"), ["text", "title"]).write(str(tmp_path / "grown"), pairs=True)
    grown = first.add(text.build_text_index(docs.filter("id >= 40"), ["text", "title"]))
    assert found(grown) == want
    gone = spark.createDataFrame([(i,) for i in range(0, 60, 7)], "id long")
    assert found(grown.remove(gone)) == found(text.build_text_index(docs.filter("id % 7 <> 0"), ["text", "title"]))


def test_frequent_phrases_leave_the_postings_of_words_alone(spark, nodes, tmp_path):
    stored = text.build_text_index(nodes, "text").write(str(tmp_path / "index"), pairs=True)
    asked = clauses(spark, ("should", "phrase", "machine learning"))
    assert text.expand(asked, stored, ["phrase"]).count() == 0
    plan = text.score(stored, asked, ["phrase"])._jdf.queryExecution().optimizedPlan().toString()
    assert "tf_next" in plan and "/postings" not in plan
    pairs = stored.pair_postings(spark.createDataFrame([("machine learning",)], "term string"))
    assert sorted((r.id, r.tf, r.tf_next, r.positions) for r in pairs.collect()) == [(1, 1, 1, [0]), (4, 3, 2, [1])]


def test_pairs_are_added_to_a_stored_index(spark, nodes, tmp_path):
    plain = text.build_text_index(nodes.coalesce(1), "text")
    stored = plain.write(str(tmp_path / "later"))
    paired = stored.with_pairs(plain)
    assert paired.pairs and not stored.pairs
    asked = clauses(spark, ("should", "phrase", "machine learning"))
    assert text.expand(asked, paired, ["phrase"]).count() == 0
    pairs = paired.pair_postings(spark.createDataFrame([("machine learning",)], "term string"))
    assert sorted((r.id, r.tf, r.tf_next, r.positions) for r in pairs.collect()) == [(1, 1, 1, [0]), (4, 3, 2, [1])]
    with pytest.raises(ValueError):
        paired.with_pairs(plain)


def test_queries_of_single_terms_need_no_pairs(spark, small, monkeypatch):
    """Pairs are written when a phrase is asked for."""
    from weftgraph.catalog import stored, text_queries

    monkeypatch.setattr(stored, "WRITTEN", {})
    made = []
    write = text.TextIndex._write_pairs
    monkeypatch.setattr(text.TextIndex, "_write_pairs", lambda self, *a: made.append(1) or write(self, *a))
    assert text_queries.t2(spark, small).count() and not made
    assert text_queries.phrase_index(spark, small).pairs and len(made) == 1
