"""Hybrid retrieval. A query is a benchmark item: its words and the embedding of the same id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.catalog.registry import nid, query, with_ctes
from weftgraph.catalog.text_queries import bm25_sql, document_index, documents, item_terms, should_sql
from weftgraph.operators import hybrid, text
from weftgraph.sources.tables import node_id, read_table, table_graph

CLAUSES = should_sql("true")
COSINE = "1 - list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[]))"
# Documents with an embedding, and the query vectors.
VECTORS = f"""docs AS (SELECT doc_id, {nid('Document', 'doc_id')} AS id FROM documents),
    e AS (SELECT d.id, v.embedding FROM docs d JOIN embeddings v ON v.vec_id = d.doc_id),
    q AS (SELECT item_id AS query_id, v.embedding FROM benchmark b JOIN embeddings v ON v.vec_id = b.item_id),
    dist AS (SELECT q.query_id, e.id, round({COSINE}, 12) AS d FROM e, q)"""


def clauses(spark, folder) -> DataFrame:
    return text.term_clauses(item_terms(spark, folder))


def hits(spark, folder) -> DataFrame:
    return text.score(document_index(spark, folder), clauses(spark, folder), ["term"])


def document_vectors(spark, folder) -> DataFrame:
    vectors = read_table(spark, folder, "embeddings").select(node_id("Document", "vec_id").alias("id"), "embedding")
    return vectors.join(documents(spark, folder).select("id"), "id", "left_semi")


def query_vectors(spark, folder) -> DataFrame:
    items = read_table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"))
    vectors = read_table(spark, folder, "embeddings").select(F.col("vec_id").alias("query_id"), "embedding")
    return items.join(vectors, "query_id")


@query(
    "x1_graph_and_vector",
    with_ctes(
        "bought_with",
        """SELECT start, id, depth, round(d, 6) AS distance, rank FROM (SELECT *, CAST(row_number() OVER (
        PARTITION BY start ORDER BY d, id) AS INTEGER) AS rank FROM (
        SELECT r.start, r.id, r.depth, round(1 - list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 12) AS d
        FROM reached r JOIN part_vectors a ON a.id = r.id JOIN part_vectors b ON b.id = r.start)) WHERE rank <= 5""",
        {
            "part_vectors": f"SELECT {nid('Part', 'vec_id')} AS id, embedding FROM embeddings",
            "w": """SELECT id AS start, id, 0 AS depth FROM part_vectors
                UNION SELECT w.start, e.dst, depth + 1 FROM w JOIN bought_with e ON e.src = w.id WHERE depth < 2""",
            "reached": "SELECT start, id, min(depth) AS depth FROM w WHERE id <> start GROUP BY start, id",
        },
    ),
)
def x1(spark, folder):
    """From every part with a vector over the parts bought with it, nearest to the start first."""
    vectors = read_table(spark, folder, "embeddings").select(node_id("Part", "vec_id").alias("id"), "embedding")
    edges = table_graph(spark, folder).edges("BOUGHT_WITH")
    rows = hybrid.hybrid_search(edges, vectors, vectors, top_k=5, max_depth=2)
    return rows.withColumn("distance", F.round("distance", 6))


@query(
    "x2_reciprocal_rank_fusion",
    bm25_sql(
        CLAUSES,
        None,
        final=f""", {VECTORS}, ranks AS (
        SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS r FROM hits
        UNION ALL SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY d, id) FROM dist)
        SELECT query_id, id, round(score, 6) AS score, rank FROM (SELECT *, CAST(row_number() OVER (
        PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM (
        SELECT query_id, id, round(sum(1.0 / (60 + r)::DOUBLE), 12) AS score FROM ranks GROUP BY query_id, id)) WHERE rank <= 10""",
    ),
)
def x2(spark, folder):
    rows = hybrid.rrf_search(hits(spark, folder), document_vectors(spark, folder), query_vectors(spark, folder), 10)
    return rows.withColumn("score", F.round("score", 6))


@query(
    "x3_weighted_fusion",
    bm25_sql(
        CLAUSES,
        None,
        final=f""", {VECTORS}, both_lists AS (
        SELECT query_id, id, 0.4 * CASE WHEN hi > lo THEN (score - lo) / (hi - lo) ELSE 1 END AS s FROM hits
            JOIN (SELECT query_id, min(score) AS lo, max(score) AS hi FROM hits GROUP BY query_id) USING (query_id)
        UNION ALL SELECT query_id, id, 0.6 * CASE WHEN hi > lo THEN ((1 - d) - lo) / (hi - lo) ELSE 1 END FROM dist
            JOIN (SELECT query_id, min(1 - d) AS lo, max(1 - d) AS hi FROM dist GROUP BY query_id) USING (query_id))
        SELECT query_id, id, round(score, 6) AS score, rank FROM (SELECT *, CAST(row_number() OVER (
        PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM (
        SELECT query_id, id, round(sum(s), 9) AS score FROM both_lists GROUP BY query_id, id)) WHERE rank <= 10""",
    ),
)
def x3(spark, folder):
    rows = hybrid.weighted_search(
        hits(spark, folder), document_vectors(spark, folder), query_vectors(spark, folder), 10, 0.4, 0.6
    )
    return rows.withColumn("score", F.round("score", 6))


@query(
    "x4_text_and_vec_score",
    bm25_sql(
        CLAUSES,
        None,
        final=f""", {VECTORS} SELECT h.query_id, h.id, round(h.score, 6) AS text_score, round(coalesce(1 - d, 0), 6) AS vec_score
        FROM hits h LEFT JOIN dist t ON t.query_id = h.query_id AND t.id = h.id""",
    ),
)
def x4(spark, folder):
    rows = hybrid.text_and_vector_scores(
        hits(spark, folder), document_vectors(spark, folder), query_vectors(spark, folder)
    )
    return rows.select("query_id", "id", *[F.round(c, 6).alias(c) for c in ("text_score", "vec_score")])


@query(
    "x5_text_match",
    bm25_sql(
        CLAUSES,
        None,
        final=f"SELECT {nid('Document', 'doc_id')} AS id, lang FROM documents WHERE {nid('Document', 'doc_id')} IN (SELECT id FROM hits)",
    ),
)
def x5(spark, folder):
    nodes = documents(spark, folder).select("id", "lang")
    return hybrid.text_match(nodes, document_index(spark, folder), clauses(spark, folder))


@query(
    "x6_hybrid_candidates",
    bm25_sql(
        CLAUSES,
        None,
        final=f""", {VECTORS} SELECT * FROM (SELECT id, id IN (SELECT id FROM hits) AS matched, id IN (SELECT id FROM e) AS embedded FROM docs)
        WHERE matched OR embedded""",
    ),
)
def x6(spark, folder):
    nodes = documents(spark, folder).select("id")
    index = document_index(spark, folder)
    return hybrid.candidates(nodes, index, clauses(spark, folder), document_vectors(spark, folder))
