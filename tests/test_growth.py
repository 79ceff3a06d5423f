"""Work that must not grow faster than the input: rows kept, moved and written."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftgraph.operators import hybrid, text

CLAUSE = "query_id long, clause string, role string, kind string, text string, boost double"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def documents(spark):
    words = ["graph data", "data graph store", "machine learning of graphs", "graph", "data store"]
    return spark.createDataFrame([(i, words[i % len(words)]) for i in range(40)], "id long, text string")


def test_a_term_has_five_keys_at_most(spark, tmp_path):
    text.build_text_index(documents(spark), "text").write(str(tmp_path / "index"))
    keys = spark.read.parquet(str(tmp_path / "index" / "keys"))
    assert keys.groupBy("term").count().agg(F.max("count")).first()[0] <= 5


def test_postings_are_moved_once_and_not_for_every_query(spark, tmp_path):
    index = text.build_text_index(documents(spark), "text").write(str(tmp_path / "index"))
    clauses = spark.createDataFrame([(q, w, "should", "term", w, 1.0) for q in range(20) for w in ("graph", "data")], CLAUSE)
    plan = plan_of(text.score(index, clauses, ["term"]))
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert not any("query_id" in line and "id#" in line.split("query_id", 1)[1].split(",", 1)[-1] for line in moved)
    assert any("hashpartitioning(id#" in line for line in moved)


def test_equal_queries_are_searched_once(spark, tmp_path, monkeypatch):
    index = text.build_text_index(documents(spark), "text").write(str(tmp_path / "index"), pairs=True)
    clauses = spark.createDataFrame([(q, "phrase", "should", "phrase", "graph data" if q % 2 else "data store", 1.0) for q in range(12)], CLAUSE)
    seen, score = [], text.score
    monkeypatch.setattr(text, "score", lambda i, c, kinds: seen.append(c.select("query_id").distinct().count()) or score(i, c, kinds))
    hits = text.text_search(index, clauses, 3, ["phrase"])
    assert {r["query_id"] for r in hits.collect()} == set(range(12)) and hits.count() == 36
    assert seen == [2]


def test_fuzzy_terms_are_those_one_edit_away(spark):
    terms = ["a", "b", "ab", "ba", "abc", "abd", "abcd", "xbcd", "bcd", "acd", "abxcd", "abcdx", "abcdxy", "dcba", "aabcd"]
    nodes = spark.createDataFrame(list(enumerate(terms)), "id long, text string")
    asked = ["", "a", "ab", "abc", "abcd", "bacd"]
    clauses = spark.createDataFrame([(i, "c", "should", "fuzzy", w, 1.0) for i, w in enumerate(asked)], CLAUSE)
    found = text.expand(clauses, text.build_text_index(nodes, "text"), ["fuzzy"]).select("query_id", "term").collect()

    def near(a: str, b: str) -> bool:
        cut = lambda w: {w[:i] + w[i + 1:] for i in range(len(w))}
        return a == b or a in cut(b) or b in cut(a) or (len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1)

    assert sorted(map(tuple, found)) == sorted((i, t) for i, w in enumerate(asked) for t in terms if near(w, t))


def test_a_task_writes_postings_of_one_part(spark, tmp_path):
    """Parts that a hash put together were sorted in one task, which held several times its share."""
    texts = spark.range(0, 400, 1, 3).select("id", F.concat_ws(" ", *[F.concat(F.lit(f"w{i}x"), F.col("id")) for i in range(8)]).alias("text"))
    text.build_text_index(texts, "text").write(str(tmp_path / "index"))
    writers: dict[str, set] = {}
    for file in (tmp_path / "index" / "postings").rglob("*.parquet"):
        if file.parent.name != f"part={text.DOCUMENT_PART}":
            writers.setdefault(file.name.split("-")[1], set()).add(file.parent.name)
    assert len(writers) == text.PARTS and all(len(parts) == 1 for parts in writers.values())


def test_postings_are_written_by_more_tasks_for_more_splits(spark, tmp_path):
    texts = spark.range(0, 64, 1, 16).select("id", F.concat_ws(" ", *[F.concat(F.lit(f"w{i}x"), F.col("id")) for i in range(200)]).alias("text"))
    text.build_text_index(texts, "text").write(str(tmp_path / "index"))
    files = {f.name.split("-")[1] for f in (tmp_path / "index" / "postings").rglob("*.parquet")}
    assert len(files) > 3 * text.PARTS


def test_a_match_searches_equal_queries_once(spark, monkeypatch):
    nodes, index = documents(spark).select("id"), text.build_text_index(documents(spark), "text")
    clauses = spark.createDataFrame([(q, "term", "should", "term", "graph" if q % 2 else "data", 1.0) for q in range(12)], CLAUSE)
    seen, score = [], text.score
    monkeypatch.setattr(hybrid, "score", lambda i, c, kinds: seen.append(c.select("query_id").distinct().count()) or score(i, c, kinds))
    whole = score(index, clauses, ["term"]).select("id").distinct().count()
    assert hybrid.text_match(nodes, index, clauses).count() == whole > 0
    vectors = nodes.limit(0).withColumn("embedding", F.array(F.lit(1.0)))
    assert hybrid.candidates(nodes, index, clauses, vectors).count() == whole
    assert seen == [2, 2]
