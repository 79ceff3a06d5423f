"""Full-text retrieval: the benchmark items are the queries, the documents the collection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.catalog.registry import nid, query
from weftgraph.catalog.stored import written
from weftgraph.functions.text import tokens
from weftgraph.operators import text
from weftgraph.plans.sizing import spread
from weftgraph.sources.tables import read_table, table_graph

DUCK_TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"

# Function words that the queries by language leave out, the same for Spark and for the SQL.
FUNCTION_WORDS = {
    "english": "a an and are as at be but by for from has have he her his i in is it its not of on or she that the their they "
    "this to was we were which will with you",
    "german": "aber als am an auch auf aus bei das dass dem den der des die doch ein eine einem einen einer er es für hat ich im in "
    "ist mit nicht noch nur oder sich sie sind so und von war wie wir zu zum zur",
    "french": "au aux avec ce ces dans de des du elle en est et eux il ils je la le les leur lui mais me ne nous on ou par pas "
    "pour qu que qui sa se ses son sur un une vous",
    "spanish": "a al como con de del el ella en entre es esta este fue ha la las le lo los más me mi no nos o para pero por que se "
    "ser si sin sobre su sus un una y ya",
}
STOP_LISTS = {language: words.split() for language, words in FUNCTION_WORDS.items()}


CORPUS = rf"""doc_tokens AS (SELECT {nid('Document', 'doc_id')} AS id, lang, {DUCK_TOKENS} AS t FROM documents),
    tok AS (SELECT id, lang, len(t) AS dl, unnest(t) AS term, unnest(range(len(t))) AS pos FROM doc_tokens),
    post AS (SELECT id, term, any_value(dl) AS dl, count(*) AS tf FROM tok GROUP BY id, term),
    dfs AS (SELECT term, count(*) AS df FROM post GROUP BY term),
    stats AS (SELECT count(*) AS n, sum(len(t)) / count(*) AS avgdl FROM doc_tokens),
    item_tokens AS (SELECT item_id AS query_id, unnest({DUCK_TOKENS}) AS term,
        unnest(range(len({DUCK_TOKENS}))) AS pos FROM benchmark),
    item_terms AS (SELECT DISTINCT query_id, term FROM item_tokens),
    longest AS (SELECT query_id, max(length(term)) AS l FROM item_terms GROUP BY query_id)"""

SCORE = """boost * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))"""

# Rows of one query and document, from clauses already expanded to terms.
PAIRS = f"""pairs AS (SELECT c.query_id, p.id, c.clause, c.role, {SCORE} AS s
    FROM clauses c JOIN post p ON p.term = c.term JOIN dfs d ON d.term = c.term, stats)"""
TOTALS = """totals AS (SELECT query_id, id, round(sum(CASE WHEN role <> 'must_not' THEN s END), 9) AS score,
    count(DISTINCT CASE WHEN role = 'must' THEN clause END) AS met,
    count(CASE WHEN role = 'must_not' THEN 1 END) AS banned FROM pairs GROUP BY query_id, id),
    musts AS (SELECT query_id, count(DISTINCT CASE WHEN role = 'must' THEN clause END) AS needed
        FROM clauses_in GROUP BY query_id),
    hits AS (SELECT t.query_id, t.id, t.score FROM totals t JOIN musts m ON m.query_id = t.query_id
        WHERE met = needed AND banned = 0 AND score > 0)"""


def bm25_sql(clauses: str, limit: int | None, expanded: str = "SELECT * FROM clauses_in", final: str | None = None) -> str:
    """``clauses`` gives query_id, clause, role, term, boost; ``expanded`` maps them to index terms."""
    top = "" if limit is None else f" WHERE rank <= {limit}"
    final = final or f"""SELECT query_id, id, round(score, 6) AS score, rank FROM (SELECT *, CAST(row_number() OVER (
        PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM hits){top}"""
    return f"""WITH {CORPUS}, clauses_in AS ({clauses}), clauses AS ({expanded}), {PAIRS}, {TOTALS} {final}"""


def should_sql(where: str, boost: str = "1.0") -> str:
    return f"SELECT query_id, 'term:' || term AS clause, 'should' AS role, term, {boost} AS boost FROM item_terms WHERE {where}"


def documents(spark, folder) -> DataFrame:
    return table_graph(spark, folder).nodes("Document")


def stored_index(spark, folder: str, name: str, properties, **how) -> text.TextIndex:
    """The index ``name`` over the documents, stored for the session."""

    def make(path: str) -> text.TextIndex:
        return text.build_text_index(spread(documents(spark, folder), "id"), properties, **how).write(path)

    return written(f"text-{name}", read_table(spark, folder, "documents"), make)


def document_index(spark, folder) -> text.TextIndex:
    return stored_index(spark, folder, "text", "text")


def phrase_index(spark, folder) -> text.TextIndex:
    """The same index with pairs of frequent words, stored beside it when a phrase is first asked for."""

    def make(path: str) -> text.TextIndex:
        source = text.build_text_index(spread(documents(spark, folder), "id"), "text")
        return document_index(spark, folder).with_pairs(source)

    return written("text-pairs", read_table(spark, folder, "documents"), make)


def item_terms(spark, folder) -> DataFrame:
    """Distinct ``(query_id, term)`` of every benchmark item, whole text."""
    items = read_table(spark, folder, "benchmark")
    return items.select(F.col("item_id").alias("query_id"), F.explode(F.array_distinct(tokens("text"))).alias("term"))


def longest_terms(spark, folder) -> DataFrame:
    """The longest term or terms of every item."""
    items = read_table(spark, folder, "benchmark").withColumn("__terms", F.array_distinct(tokens("text")))
    most = F.array_max(F.transform("__terms", F.length))
    kept = items.withColumn("__most", most).select(
        F.col("item_id").alias("query_id"),
        F.explode(F.filter("__terms", lambda t: F.length(t) == F.col("__most"))).alias("term"),
    )
    return kept


def rounded(hits: DataFrame) -> DataFrame:
    return hits.withColumn("score", F.round("score", 6))


@query(
    "t1_text_index",
    f"WITH {CORPUS} SELECT p.term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS occurrences, CAST(min(first) AS INTEGER) AS first_pos "
    "FROM post p JOIN (SELECT id, term, min(pos) AS first FROM tok GROUP BY id, term) f ON f.id = p.id AND f.term = p.term GROUP BY p.term",
)
def t1(spark, folder):
    """The whole index, reduced to one line per term."""
    postings = document_index(spark, folder).postings()
    return postings.groupBy("term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("occurrences"), F.min(F.array_min("positions")).alias("first_pos")
    )


@query(
    "t1_documents_indexed",
    f"WITH {CORPUS} SELECT n AS documents, CAST(round(avgdl * n) AS BIGINT) AS tokens FROM stats",
)
def t1_size(spark, folder):
    return document_index(spark, folder).documents_indexed()


#: The collection without the documents in German.
WITHOUT_GERMAN = CORPUS.replace("FROM documents)", "FROM documents WHERE lang IS NULL OR lang <> 'de')")


def grown_index(spark, folder) -> text.TextIndex:
    """Two thirds of the documents, then the others as a segment of their own, then German ones removed."""

    def make(path: str) -> text.TextIndex:
        nodes = documents(spark, folder)
        first = text.build_text_index(spread(nodes.filter("id % 3 <> 0"), "id"), "text").write(path)
        grown = first.add(text.build_text_index(spread(nodes.filter("id % 3 = 0"), "id"), "text"))
        return grown.remove(nodes.filter("lang = 'de'"))

    return written("text-grown", read_table(spark, folder, "documents"), make)


@query("t1_index_grown", bm25_sql(should_sql("true"), 10).replace(CORPUS, WITHOUT_GERMAN))
def t1_grown(spark, folder):
    """After additions and removals the scores are those of an index built at once."""
    clauses = text.term_clauses(item_terms(spark, folder))
    return rounded(text.text_search(grown_index(spark, folder), clauses, 10, ["term"]))


@query("t2_bm25_search", bm25_sql(should_sql("true"), 10))
def t2(spark, folder):
    """Each item as a whole is an any-term query."""
    clauses = text.term_clauses(item_terms(spark, folder))
    return rounded(text.text_search(document_index(spark, folder), clauses, 10, ["term"]))


BOOLEAN = """SELECT t.query_id, 'term:' || term AS clause, 'must' AS role, term, 1.0 AS boost FROM item_terms t
    JOIN longest g ON g.query_id = t.query_id WHERE length(term) = l
    UNION ALL SELECT t.query_id, 'term:' || term, 'should', term, 1.0 FROM item_terms t JOIN longest g ON g.query_id = t.query_id
        WHERE length(term) < l AND NOT (length(term) = 5 AND term < 'h')
    UNION ALL SELECT query_id, 'term:' || term, 'must_not', term, 1.0 FROM item_terms WHERE length(term) = 5 AND term < 'h'"""


@query("t3_boolean", bm25_sql(BOOLEAN, 10))
def t3(spark, folder):
    terms = item_terms(spark, folder)
    must = text.term_clauses(longest_terms(spark, folder), "must")
    barred = (F.length("term") == 5) & (F.col("term") < "h")
    others = terms.join(longest_terms(spark, folder), ["query_id", "term"], "left_anti")
    should = text.term_clauses(others.filter(~barred), "should")
    banned = text.term_clauses(terms.filter(barred), "must_not")
    clauses = must.unionByName(should).unionByName(banned)
    return rounded(text.text_search(document_index(spark, folder), clauses, 10, ["term"]))


PHRASE = f"""WITH {CORPUS}, starts AS (SELECT t.query_id, min(pos) AS p FROM item_tokens t
        JOIN longest g ON g.query_id = t.query_id WHERE length(term) = l GROUP BY t.query_id),
    two AS (SELECT a.query_id, a.term AS first, b.term AS second FROM starts s
        JOIN item_tokens a ON a.query_id = s.query_id AND a.pos = s.p - 1
        JOIN item_tokens b ON b.query_id = s.query_id AND b.pos = s.p),
    there AS (SELECT DISTINCT two.query_id, x.id FROM two JOIN tok x ON x.term = two.first
        JOIN tok y ON y.id = x.id AND y.pos = x.pos + 1 AND y.term = two.second),
    clauses AS (SELECT query_id, first AS term, 1.0 AS boost FROM two UNION ALL SELECT query_id, second, 1.0 FROM two)
    SELECT query_id, id, round(score, 6) AS score, rank FROM (SELECT query_id, id, score, CAST(row_number() OVER (
        PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM (
        SELECT c.query_id, p.id, round(sum({SCORE}), 9) AS score FROM clauses c JOIN post p ON p.term = c.term
        JOIN dfs d ON d.term = c.term JOIN there h ON h.query_id = c.query_id AND h.id = p.id, stats
        GROUP BY c.query_id, p.id)) WHERE rank <= 10"""


@query("t4_phrase", PHRASE)
def t4(spark, folder):
    """The first longest word of every item with the word before it."""
    words = F.col("__words")
    items = read_table(spark, folder, "benchmark").withColumn("__words", tokens("text"))
    sizes = F.transform(words, F.length)
    place = F.array_position(sizes, F.array_max(sizes)).cast("int")
    clauses = items.withColumn("__at", place).filter(F.col("__at") > 1).select(
        F.col("item_id").alias("query_id"),
        F.lit("phrase").alias("clause"),
        F.lit("should").alias("role"),
        F.lit("phrase").alias("kind"),
        F.array_join(F.slice(words, F.greatest(F.col("__at") - 1, F.lit(1)), F.lit(2)), " ").alias("text"),
        F.lit(1.0).alias("boost"),
    )
    return rounded(text.text_search(phrase_index(spark, folder), clauses, 10, ["phrase"]))


LONGEST = """SELECT DISTINCT t.query_id, '{kind}:' || {form} AS clause, 'should' AS role, {form} AS term, 1.0 AS boost FROM item_terms t
    JOIN longest g ON g.query_id = t.query_id WHERE length(term) = l"""


@query(
    "t5_prefix",
    bm25_sql(
        LONGEST.format(kind="prefix", form="substr(term, 1, 5)"),
        10,
        """SELECT c.query_id, c.clause, c.role, d.term, c.boost FROM clauses_in c JOIN dfs d ON starts_with(d.term, c.term)""",
    ),
)
def t5(spark, folder):
    starts = longest_terms(spark, folder).select("query_id", F.substring("term", 1, 5).alias("term")).distinct()
    clauses = text.term_clauses(starts, kind="prefix")
    return rounded(text.text_search(document_index(spark, folder), clauses, 10, ["prefix"]))


@query("t6_boost", bm25_sql(should_sql("true", "CASE WHEN length(term) >= 8 THEN 3.0 ELSE 0.5 END"), 10))
def t6(spark, folder):
    terms = item_terms(spark, folder).withColumn("boost", F.when(F.length("term") >= 8, 3.0).otherwise(0.5))
    return rounded(text.text_search(document_index(spark, folder), text.term_clauses(terms), 10, ["term"]))


@query(
    "t7_fuzzy",
    bm25_sql(
        LONGEST.format(kind="fuzzy", form="substr(term, 1, length(term) - 1)"),
        10,
        """SELECT c.query_id, c.clause, c.role, d.term, c.boost FROM clauses_in c JOIN dfs d
        ON abs(length(d.term) - length(c.term)) <= 1 AND levenshtein(d.term, c.term) <= 4 AND (d.term = c.term
        OR (length(d.term) = length(c.term)
            AND len([i for i in range(1, length(c.term) + 1) if d.term[i] <> c.term[i]]) = 1)
        OR list_contains([substr(d.term, 1, i - 1) || substr(d.term, i + 1) for i in range(1, length(d.term) + 1)], c.term)
        OR list_contains([substr(c.term, 1, i - 1) || substr(c.term, i + 1) for i in range(1, length(c.term) + 1)], d.term))""",
    ),
)
def t7(spark, folder):
    """The longest words with the last letter missing."""
    cut = longest_terms(spark, folder).select(
        "query_id", F.expr("substring(term, 1, length(term) - 1)").alias("term")
    ).distinct()
    clauses = text.term_clauses(cut, kind="fuzzy")
    return rounded(text.text_search(document_index(spark, folder), clauses, 10, ["fuzzy"]))


def language_sql() -> str:
    parts = []
    for name, stop_words in STOP_LISTS.items():
        code = text.LANGUAGES[name]
        listed = ", ".join(f"'{w}'" for w in stop_words)
        parts.append(
            f"""SELECT '{name}' AS language, query_id, id, round(score, 6) AS score, rank FROM (
            SELECT query_id, id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM (
            SELECT c.query_id, p.id, round(sum({SCORE}), 9) AS score FROM item_terms c
            JOIN (SELECT id, term, any_value(dl) AS dl, count(*) AS tf FROM tok WHERE lang = '{code}' AND term NOT IN ({listed})
                GROUP BY id, term) p ON p.term = c.term
            JOIN (SELECT term, count(DISTINCT id) AS df FROM tok WHERE lang = '{code}' GROUP BY term) d ON d.term = c.term,
            (SELECT count(*) AS n, sum(len(t)) / count(*) AS avgdl FROM doc_tokens WHERE lang = '{code}') stats,
            (SELECT 1.0 AS boost) b GROUP BY c.query_id, p.id)) WHERE rank <= 3"""
        )
    return f"WITH {CORPUS} " + " UNION ALL ".join(parts)


@query("t8_language", language_sql())
def t8(spark, folder):
    """Whole items against each language on its own, without that language's function words."""
    clauses = text.term_clauses(item_terms(spark, folder))
    found = None
    for name in STOP_LISTS:
        index = stored_index(
            spark, folder, f"text-{name}", "text", language=name, language_column="lang", stop_lists=STOP_LISTS
        )
        hits = rounded(text.text_search(index, clauses, 3, ["term"])).withColumn("language", F.lit(name))
        found = hits if found is None else found.unionByName(hits)
    return found


SNIPPET = r"""first_hit AS (SELECT h.query_id, h.id, h.score, h.rank, min(k.pos) AS p FROM (SELECT *, CAST(row_number() OVER (
        PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM hits) h
        JOIN tok k ON k.id = h.id JOIN clauses_in c ON c.query_id = h.query_id AND c.term = k.term WHERE h.rank <= {k}
        GROUP BY h.query_id, h.id, h.score, h.rank),
    words AS (SELECT {doc} AS id, regexp_extract_all(text, '[\p{{L}}\p{{N}}]+') AS w FROM documents),
    cut AS (SELECT f.*, unnest(w[greatest(p - 4, 1):greatest(p - 4, 1) + 14]) AS word,
        unnest(range(15)) AS place FROM first_hit f JOIN words USING (id))
    SELECT query_id, id, round(any_value(score), 6) AS score, {rank} string_agg(CASE WHEN (query_id, lower(word)) IN (
        SELECT (query_id, term) FROM clauses_in) THEN '<b>' || word || '</b>' ELSE word END, ' ' ORDER BY place) AS snippet
    FROM cut WHERE word IS NOT NULL GROUP BY query_id, id"""


def snippet_sql(k: int, rank: bool) -> str:
    final = SNIPPET.format(k=k, doc=nid("Document", "doc_id"), rank="any_value(rank) AS rank," if rank else "")
    return bm25_sql(should_sql("true"), k, final=", " + final)


@query("t9_snippet", snippet_sql(3, True))
def t9(spark, folder):
    clauses = text.term_clauses(item_terms(spark, folder))
    hits = text.text_search(document_index(spark, folder), clauses, 3, ["term"])
    return rounded(text.with_snippets(hits, documents(spark, folder), clauses))


@query("t10_keyword_search", snippet_sql(5, False))
def t10(spark, folder):
    clauses = text.term_clauses(item_terms(spark, folder))
    index = document_index(spark, folder)
    return rounded(text.keyword_search(index, documents(spark, folder), clauses, k=5, kinds=["term"]))


TWO = r"""listed AS (SELECT {doc} AS id, regexp_extract_all(lower(source), '[\p{{L}}\p{{N}}]+') AS s, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS t
        FROM documents),
    tok AS (SELECT id, unnest(s) AS term, unnest(range(len(s))) AS pos FROM listed
        UNION ALL SELECT id, unnest(t), unnest(range(len(t))) + len(s) + 100 FROM listed),
    lens AS (SELECT id, len(s) + len(t) AS dl FROM listed),
    post AS (SELECT k.id, term, any_value(dl) AS dl, count(*) AS tf FROM tok k JOIN lens l ON l.id = k.id GROUP BY k.id, term),
    dfs AS (SELECT term, count(*) AS df FROM post GROUP BY term),
    stats AS (SELECT count(*) AS n, sum(dl) / count(*) AS avgdl FROM lens),
    two AS (SELECT doc_id AS query_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+')[1] AS first,
        regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+')[2] AS second FROM documents WHERE doc_id % 100 = 0),
    there AS (SELECT DISTINCT two.query_id, x.id FROM two JOIN tok x ON x.term = two.first
        JOIN tok y ON y.id = x.id AND y.pos = x.pos + 1 AND y.term = two.second),
    clauses AS (SELECT query_id, first AS term, 1.0 AS boost FROM two UNION ALL SELECT query_id, second, 1.0 FROM two)
    SELECT query_id, id, round(score, 6) AS score, rank FROM (SELECT query_id, id, score, CAST(row_number() OVER (
        PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM (
        SELECT c.query_id, p.id, round(sum({score}), 9) AS score FROM clauses c JOIN post p ON p.term = c.term
        JOIN dfs d ON d.term = c.term JOIN there h ON h.query_id = c.query_id AND h.id = p.id, stats
        GROUP BY c.query_id, p.id)) WHERE rank <= 10"""


def word_at(column: str, place: int):
    return F.try_element_at(tokens(column), F.lit(place))


@query("t1_two_properties", "WITH " + TWO.format(doc=nid("Document", "doc_id"), score=SCORE))
def t1_two(spark, folder):
    """Source and text in one index; documents with an id divisible by 100 ask with the first two words of their text."""
    asked = read_table(spark, folder, "documents").filter("doc_id % 100 = 0").select(
        F.col("doc_id").alias("query_id"), F.lit("phrase").alias("clause"), F.lit("should").alias("role"), F.lit("phrase").alias("kind"),
        F.concat(word_at("text", 1), F.lit(" "), word_at("text", 2)).alias("text"), F.lit(1.0).alias("boost"),
    )
    index = stored_index(spark, folder, "source-text", ["source", "text"])
    return rounded(text.text_search(index, asked.filter("text IS NOT NULL"), 10, ["phrase"]))
