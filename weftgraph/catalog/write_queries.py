"""Upserts, deletes, restructuring and schema checks on the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.catalog.registry import nid, query, with_ctes
from weftgraph.functions.props import document_hash, merge_props
from weftgraph.operators import delete, match, restructure, schema, upsert
from weftgraph.plans.materialize import ensure_checkpoint_dir
from weftgraph.sources.tables import node_id, read_table, table_graph
from weftgraph.streaming import facts

TEXT_MAP = "map<string,string>"


def text(column: str):
    return F.col(column).cast("string")


def flat_props(rows: DataFrame, *keys: str) -> DataFrame:
    """One row per property, so that maps can be compared."""
    return rows.select(*keys, F.explode_outer("props").alias("prop", "value"))


# -- upserts -----------------------------------------------------------------------------

# Later rows win; a NULL segment removes the stored one.
U1_BATCH = """batch AS (SELECT CASE WHEN event_type = 'error' THEN 'Entity' ELSE 'User' END AS label,
        'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS key, event_type, event_id FROM events),
    written AS (SELECT label, key, event_type AS prop, CAST(event_id AS VARCHAR) AS value, event_id FROM batch
        UNION ALL SELECT label, key, 'segment', CASE WHEN event_type = 'purchase' THEN 'BUYER' END, event_id FROM batch
            WHERE event_type IN ('purchase', 'signup')
        UNION ALL SELECT label, key, 'name', key, event_id FROM batch),
    latest AS (SELECT label, key, prop, value FROM (SELECT *, row_number() OVER (PARTITION BY label, key, prop
        ORDER BY event_id DESC) AS r FROM written) WHERE r = 1),
    stored AS (SELECT 'User' AS label, c_name AS key, 'segment' AS prop, c_mktsegment AS value FROM customer
        UNION ALL SELECT 'User', c_name, 'name', c_name FROM customer)"""
MERGED = """SELECT label, key, prop, value FROM latest WHERE value IS NOT NULL
    UNION ALL SELECT s.label, s.key, s.prop, s.value FROM stored s LEFT JOIN latest l
    ON l.label = s.label AND l.key = s.key AND l.prop = s.prop WHERE l.key IS NULL"""


@query("u1_upsert_by_name", f"WITH {U1_BATCH} {MERGED}")
def u1(spark, folder):
    kind = F.col("event_type")
    change = F.when(
        kind.isin("purchase", "signup"), F.create_map(F.lit("segment"), F.when(kind == "purchase", F.lit("BUYER")))
    ).otherwise(F.create_map().cast(TEXT_MAP))
    batch = read_table(spark, folder, "events").select(
        F.when(kind != "error", "User").alias("label"),
        F.concat(F.lit("Customer#"), F.lpad(text("user_id"), 9, "0")).alias("key"),
        F.map_concat(F.create_map(kind, text("event_id")), change).alias("props"),
        F.col("event_id").alias("seq"),
    )
    stored = read_table(spark, folder, "customer").select(
        F.lit("User").alias("label"),
        F.col("c_name").alias("key"),
        F.create_map(F.lit("segment"), "c_mktsegment", F.lit("name"), "c_name").alias("props"),
    )
    return flat_props(upsert.upsert_nodes(stored, batch), "label", "key")


@query(
    "u2_upsert_by_id",
    """WITH latest AS (SELECT 'Chunk' AS label, 'doc' || doc_id AS key, unnest(['text', 'lang', 'id']) AS prop,
            unnest([text, lang, 'doc' || doc_id]) AS value FROM documents
        UNION ALL SELECT p_type, 'part' || p_partkey, unnest(['name', 'size', 'id']),
            unnest([p_name, CAST(p_size AS VARCHAR), 'part' || p_partkey]) FROM part
        UNION ALL SELECT 'Node', 'order' || o_orderkey, unnest(['status', 'id']), unnest([o_orderstatus, 'order' || o_orderkey]) FROM orders),
    stored AS (SELECT p_type AS label, 'part' || p_partkey AS key, unnest(['brand', 'size']) AS prop,
        unnest([p_brand, 'unknown']) AS value FROM part) """
    + MERGED,
)
def u2(spark, folder):
    """Chunks, entities and plain nodes keyed by a string id; a given ``id`` property does not win."""
    none = F.lit(None).cast("string")
    docs = read_table(spark, folder, "documents").select(
        F.concat(F.lit("doc"), "doc_id").alias("id"), none.alias("label"), none.alias("name"), "text",
        F.create_map(F.lit("lang"), "lang", F.lit("id"), F.lit("other")).alias("props"), F.col("doc_id").alias("seq"),
    )
    parts = read_table(spark, folder, "part").select(
        F.concat(F.lit("part"), "p_partkey").alias("id"), F.col("p_type").alias("label"), F.col("p_name").alias("name"),
        none.alias("text"), F.create_map(F.lit("size"), text("p_size")).alias("props"), F.col("p_partkey").alias("seq"),
    )
    orders = read_table(spark, folder, "orders").select(
        F.concat(F.lit("order"), "o_orderkey").alias("id"), none.alias("label"), none.alias("name"),
        none.alias("text"), F.create_map(F.lit("status"), "o_orderstatus").alias("props"), F.col("o_orderkey").alias("seq"),
    )
    stored = read_table(spark, folder, "part").select(
        F.col("p_type").alias("label"), F.concat(F.lit("part"), "p_partkey").alias("key"),
        F.create_map(F.lit("brand"), "p_brand", F.lit("size"), F.lit("unknown")).alias("props"),
    )
    batch = upsert.labelled_batch(docs.unionByName(parts).unionByName(orders))
    return flat_props(upsert.upsert_nodes(stored, batch, "id"), "label", "key")


@query(
    "u3_upsert_edges",
    """WITH written AS (SELECT 'part' || l_partkey AS src_key, 'supplier' || l_suppkey AS dst_key, l_returnflag, l_orderkey,
            row_number() OVER (PARTITION BY l_partkey, l_suppkey, l_returnflag <> 'R' ORDER BY l_orderkey DESC, l_linenumber DESC) AS r
        FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 5000)),
    patch AS (SELECT src_key, dst_key, max(CASE WHEN l_returnflag <> 'R' AND r = 1 THEN CAST(l_orderkey AS VARCHAR) END) AS last_order
        FROM written GROUP BY src_key, dst_key),
    stored AS (SELECT 'part' || l_partkey AS src_key, 'supplier' || l_suppkey AS dst_key FROM lineitem WHERE l_linestatus = 'O'),
    edges AS (SELECT s.src_key, s.dst_key, 'open' AS status, p.last_order FROM stored s
        LEFT JOIN patch p ON p.src_key = s.src_key AND p.dst_key = s.dst_key
        UNION ALL SELECT p.src_key, p.dst_key, NULL, p.last_order FROM patch p
        WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.src_key = p.src_key AND s.dst_key = p.dst_key))
    SELECT src_key, 'SUPPLIED_BY' AS type, dst_key, status, last_order FROM edges""",
)
def u3(spark, folder):
    """Stored parallel edges (open lines) all take the new property.

    Only suppliers with a good balance are nodes; a line of any other one does nothing.
    """
    lines = read_table(spark, folder, "lineitem")
    ends = [F.concat(F.lit("part"), "l_partkey").alias("src_key"), F.concat(F.lit("supplier"), "l_suppkey").alias("dst_key")]
    batch = lines.select(
        *ends,
        F.lit("SUPPLIED_BY").alias("type"),
        F.when(F.col("l_returnflag") != "R", F.create_map(F.lit("last_order"), text("l_orderkey"))).alias("props"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("seq"),
    )
    parts = read_table(spark, folder, "part").select(F.lit("Part").alias("label"), F.concat(F.lit("part"), "p_partkey").alias("key"))
    suppliers = read_table(spark, folder, "supplier").filter("s_acctbal >= 5000").select(
        F.lit("Supplier").alias("label"), F.concat(F.lit("supplier"), "s_suppkey").alias("key")
    )
    stored = lines.filter("l_linestatus = 'O'").select(
        F.lit("Part").alias("src_label"), ends[0], F.lit("SUPPLIED_BY").alias("type"), F.lit("Supplier").alias("dst_label"), ends[1],
        F.create_map(F.lit("status"), F.lit("open")).alias("props"),
    )
    merged = upsert.upsert_edges(stored, parts.unionByName(suppliers), batch)
    return merged.select("src_key", "type", "dst_key", *[F.col("props")[p].alias(p) for p in ("status", "last_order")])


def event_documents(spark, folder) -> DataFrame:
    """Each event as a graph document: its user, its type, two relations and a source."""
    user, following = F.concat(F.lit("user"), text("user_id")), F.concat(F.lit("user"), (F.col("user_id") + 1).cast("string"))
    none = F.lit(None).cast("string")

    def node(key, label, *props):
        return F.struct(key.alias("id"), label.alias("type"), F.create_map(*props).alias("properties"))

    def relation(source_type, source, kind, target_type, target, props):
        return F.struct(
            source.alias("source_id"), source_type.alias("source_type"), target.alias("target_id"),
            target_type.alias("target_type"), F.lit(kind).alias("type"), props.alias("properties"),
        )

    events = read_table(spark, folder, "events")
    return events.select(
        F.col("event_id").alias("doc"),
        F.array(
            node(user, F.lit("User"), F.lit("last"), text("event_id"), F.lit("name"), F.lit("drifted")),
            node(F.col("event_type"), none, F.lit("seen"), text("event_id")),
        ).alias("nodes"),
        F.array(
            relation(F.lit("User"), user, "DID", none, F.col("event_type"), F.create_map(F.lit("event"), text("event_id"))),
            relation(F.lit("User"), user, "FOLLOWS", F.lit("User"), following, F.create_map().cast(TEXT_MAP)),
        ).alias("relationships"),
        F.struct(
            F.when(F.col("event_type") != "view", F.concat(F.lit("ev"), text("event_id"))).alias("id"),
            F.col("props").alias("page_content"),
            F.create_map(F.lit("type"), "event_type").alias("metadata"),
        ).alias("source"),
    )


def stored_users(spark, folder) -> DataFrame:
    return read_table(spark, folder, "supplier").select(
        F.lit("User").alias("label"), F.concat(F.lit("user"), text("s_suppkey")).alias("key"),
        F.create_map(F.lit("origin"), "s_name", F.lit("name"), F.concat(F.lit("user"), text("s_suppkey"))).alias("props"),
    )


def stored_follows(spark, folder) -> DataFrame:
    return read_table(spark, folder, "supplier").select(
        F.lit("User").alias("src_label"), F.concat(F.lit("user"), text("s_suppkey")).alias("src_key"), F.lit("FOLLOWS").alias("type"),
        F.lit("User").alias("dst_label"), F.concat(F.lit("user"), (F.col("s_suppkey") + 1).cast("string")).alias("dst_key"),
        F.create_map(F.lit("old"), F.lit("yes")).alias("props"),
    )


@query(
    "u4_graph_document_nodes",
    """WITH latest AS (SELECT 'User' AS label, 'user' || user_id AS key, unnest(['last', 'name']) AS prop,
            unnest([CAST(max(event_id) AS VARCHAR), 'user' || user_id]) AS value FROM events GROUP BY user_id
        UNION ALL SELECT 'Entity', event_type, unnest(['seen', 'name']), unnest([CAST(max(event_id) AS VARCHAR), event_type]) FROM events GROUP BY event_type),
    stored AS (SELECT 'User' AS label, 'user' || s_suppkey AS key, unnest(['origin', 'name']) AS prop,
        unnest([s_name, 'user' || s_suppkey]) AS value FROM supplier) """
    + MERGED,
)
def u4_nodes(spark, folder):
    nodes, _ = upsert.add_graph_documents(
        stored_users(spark, folder), stored_follows(spark, folder), event_documents(spark, folder)
    )
    return flat_props(nodes, "label", "key")


FOLLOWS = """follows AS (SELECT DISTINCT 'user' || e.user_id AS src_key, 'user' || (e.user_id + 1) AS dst_key FROM events e
        LEFT JOIN (SELECT user_id, min(event_id) AS first FROM events GROUP BY user_id) f ON f.user_id = e.user_id + 1
        WHERE e.user_id + 1 IN (SELECT s_suppkey FROM supplier) OR f.first <= e.event_id),
    kept AS (SELECT 'user' || s_suppkey AS src_key, 'user' || (s_suppkey + 1) AS dst_key FROM supplier)"""


@query(
    "u4_graph_document_edges",
    f"""WITH {FOLLOWS} SELECT src_key, 'FOLLOWS' AS type, dst_key, 'old' AS prop, 'yes' AS value FROM kept
    UNION ALL SELECT src_key, 'FOLLOWS', dst_key, NULL, NULL FROM follows WHERE (src_key, dst_key) NOT IN (SELECT (src_key, dst_key) FROM kept)
    UNION ALL SELECT 'user' || user_id, 'DID', event_type, 'event', CAST(max(event_id) AS VARCHAR) FROM events GROUP BY user_id, event_type""",
)
def u4_edges(spark, folder):
    """A FOLLOWS edge is dropped when its target only shows up in a later document."""
    _, edges = upsert.add_graph_documents(
        stored_users(spark, folder), stored_follows(spark, folder), event_documents(spark, folder)
    )
    return flat_props(edges, "src_key", "type", "dst_key")


SOURCE_KEY = """CASE WHEN event_type <> 'view' THEN 'ev' || event_id ELSE left(sha256('{"content":"' || replace(props, '"', '\\"')
    || '","metadata":{"type":"' || event_type || '"}}'), 32) END"""


@query(
    "u5_source_links",
    f"""WITH s AS (SELECT {SOURCE_KEY} AS src_key, user_id, event_type FROM events)
    SELECT DISTINCT src_key, 'MENTIONS' AS type, 'User' AS dst_label, 'user' || user_id AS dst_key FROM s
    UNION SELECT src_key, 'MENTIONS', 'Entity', event_type FROM s""",
)
def u5(spark, folder):
    _, edges = upsert.add_graph_documents(
        stored_users(spark, folder), stored_follows(spark, folder), event_documents(spark, folder), include_source=True
    )
    return edges.filter(F.col("type") == upsert.MENTIONS).select("src_key", "type", "dst_label", "dst_key")


@query(
    "u5_source_nodes",
    f"""SELECT '__Document__' AS label, {SOURCE_KEY} AS key, any_value(props) AS page_content FROM events GROUP BY key""",
)
def u5_nodes(spark, folder):
    nodes, _ = upsert.add_graph_documents(
        stored_users(spark, folder), stored_follows(spark, folder), event_documents(spark, folder), include_source=True
    )
    found = nodes.filter(F.col("label") == upsert.DOCUMENT_LABEL)
    return found.select("label", "key", F.col("props")["page_content"].alias("page_content"))


@query(
    "u6_document_hash",
    r"""SELECT doc_id, left(sha256('{"content":"' || replace(replace(replace(replace(text, '\', '\\'), '"', '\"'), chr(10), '\n'), chr(9), '\t')
    || '","metadata":{"lang":"' || lang || '","source":"' || source || '"}}'), 32) AS key FROM documents""",
)
def u6(spark, folder):
    metadata = F.create_map(F.lit("source"), "source", F.lit("lang"), "lang")
    return read_table(spark, folder, "documents").select("doc_id", document_hash("text", metadata).alias("key"))


@query(
    "u7_set_properties",
    """SELECT p_partkey, unnest(['brand', 'size', 'price']) AS prop, unnest([p_brand, '0', 'low']) AS value FROM part WHERE p_retailprice < 1000
    UNION ALL SELECT p_partkey, unnest(['brand', 'type', 'size']), unnest([p_brand, p_type, CAST(p_size AS VARCHAR)]) FROM part WHERE p_retailprice >= 1000""",
)
def u7(spark, folder):
    """``SET n += {size: '0', price: 'low', type: null}`` on cheap parts."""
    new = F.create_map(F.lit("size"), F.lit("0"), F.lit("price"), F.lit("low"), F.lit("type"), F.lit(None).cast("string"))
    rows = read_table(spark, folder, "part").select(
        "p_partkey",
        F.create_map(F.lit("brand"), "p_brand", F.lit("type"), "p_type", F.lit("size"), text("p_size")).alias("old"),
        F.when(F.col("p_retailprice") < 1000, new).alias("new"),
    )
    return flat_props(rows.select("p_partkey", merge_props("old", "new").alias("props")), "p_partkey")


FACT_RELATION = "CASE event_type WHEN 'error' THEN 'went-wrong' WHEN 'view' THEN 'looked at' WHEN 'signup' THEN '2nd' ELSE event_type END"


def event_facts(events: DataFrame) -> DataFrame:
    return events.select(
        F.concat(F.lit("s"), text("user_id")).alias("session"),
        F.concat(F.lit("user"), text("user_id")).alias("subject"),
        F.expr(FACT_RELATION).alias("relation"),
        F.col("props").alias("object"),
    )


NEW_FACTS = f"""SELECT DISTINCT 's' || user_id AS session, 'user' || user_id AS subject,
    replace(upper({FACT_RELATION}), ' ', '_') AS relation, props AS object FROM events WHERE event_type IN ('view', 'click', 'purchase')"""


@query("u8_save_facts", f"SELECT * FROM ({NEW_FACTS}) WHERE NOT (relation = 'CLICK' AND session IN (SELECT 's' || s_suppkey FROM supplier))")
def u8(spark, folder):
    """Facts not yet stored; the clicks of some sessions are."""
    events = read_table(spark, folder, "events")
    sessions = read_table(spark, folder, "supplier").select(F.concat(F.lit("s"), text("s_suppkey")).alias("session"))
    stored = facts.split_facts(event_facts(events.filter("event_type = 'click'")))[0].join(sessions, "session", "left_semi")
    return facts.save_facts(stored, event_facts(events))


@query(
    "u8_rejected_facts",
    f"SELECT 's' || user_id AS session, 'user' || user_id AS subject, {FACT_RELATION} AS relation, props AS object FROM events WHERE event_type IN ('error', 'signup')",
)
def u8_rejects(spark, folder):
    return facts.split_facts(event_facts(read_table(spark, folder, "events")))[1]


def fact_stream(spark, folder) -> str:
    """The events read as a stream and merged into a new store, whose folder is returned."""
    store = f"{ensure_checkpoint_dir(spark)}/facts-{uuid.uuid4().hex}"
    columns = read_table(spark, folder, "events").schema
    stream = spark.readStream.schema(columns).option("pathGlobFilter", "events.parquet").parquet(folder)
    facts.ingest_facts(event_facts(stream), store, f"{store}/progress").awaitTermination()
    return store


@query("u8_fact_stream", NEW_FACTS)
def u8_stream(spark, folder):
    """The events read as a stream, facts written by micro-batch and read back."""
    return facts.read_facts(spark, fact_stream(spark, folder))


FACT_NODES = f"""SELECT session, subject AS name, 'Entity' AS label FROM ({NEW_FACTS})
    UNION SELECT session, object, 'Entity' FROM ({NEW_FACTS})"""


@query("u8_fact_stream_nodes", FACT_NODES)
def u8_stream_nodes(spark, folder):
    return facts.read_fact_nodes(spark, fact_stream(spark, folder))


@query(
    "u8_fact_nodes",
    f"""SELECT * FROM ({FACT_NODES}) WHERE (session, name) NOT IN (SELECT ('s' || s_suppkey, 'user' || s_suppkey) FROM supplier)""",
)
def u8_nodes(spark, folder):
    """Entities of the facts; those of some users are stored already."""
    stored = read_table(spark, folder, "supplier").select(
        F.concat(F.lit("s"), text("s_suppkey")).alias("session"), F.concat(F.lit("user"), text("s_suppkey")).alias("name")
    )
    return facts.save_fact_nodes(stored, event_facts(read_table(spark, folder, "events")))


# -- deletes and restructuring -----------------------------------------------------------

GONE = "SELECT id FROM part_n WHERE name LIKE 'small %'"


def part_names(spark, folder) -> DataFrame:
    names = table_graph(spark, folder).nodes("Part").select("name").distinct()
    return names.filter(F.col("name").startswith("small "))


@query("d1_delete_nodes", with_ctes("part_n", f"SELECT id, name FROM part_n WHERE id NOT IN ({GONE})"))
def d1_nodes(spark, folder):
    graph = table_graph(spark, folder)
    parts = graph.nodes("Part").select("id", "name")
    return delete.delete(parts, graph.links("BOUGHT_WITH"), entity_names=part_names(spark, folder))[0]


@query(
    "d1_delete_edges",
    with_ctes(
        "part_n bought_with",
        f"SELECT src, 'BOUGHT_WITH' AS type, dst FROM bought_with WHERE src NOT IN ({GONE}) AND dst NOT IN ({GONE})",
    ),
)
def d1_edges(spark, folder):
    graph = table_graph(spark, folder)
    parts = graph.nodes("Part").select("id", "name")
    return delete.delete(parts, graph.links("BOUGHT_WITH"), entity_names=part_names(spark, folder))[1]


@query(
    "d2_blocked_deletes",
    with_ctes(
        "part_n bought_with",
        f"SELECT id, count(*) AS edges FROM (SELECT src AS id FROM bought_with UNION ALL SELECT dst FROM bought_with) WHERE id IN ({GONE}) GROUP BY id",
    ),
)
def d2(spark, folder):
    graph = table_graph(spark, folder)
    targets = graph.nodes("Part").filter(F.col("name").startswith("small ")).select("id")
    return delete.blocked_deletes(graph.links("BOUGHT_WITH"), targets)


@query(
    "d3_scoped_purge",
    with_ctes(
        "part_n bought_with",
        """SELECT src, type, dst FROM (SELECT src, 'BOUGHT_WITH' AS type, dst FROM bought_with)
        WHERE src NOT IN (SELECT id FROM part_n WHERE type = 'PROMO' AND brand = 'Brand#5')
          AND dst NOT IN (SELECT id FROM part_n WHERE type = 'PROMO' AND brand = 'Brand#5')""",
    ),
)
def d3(spark, folder):
    graph = table_graph(spark, folder)
    return delete.purge(graph.nodes("Part"), graph.links("BOUGHT_WITH"), {"type": "PROMO", "brand": "Brand#5"})[1]


ALL_GONE = "SELECT id FROM part_n WHERE name LIKE 'small %' UNION ALL SELECT id FROM customer_n WHERE segment = 'FURNITURE'"


def condemned(spark, folder) -> tuple:
    """Parts and customers in one node table with an adapter id, all edges of the graph, and the ids to delete."""
    graph = table_graph(spark, folder)
    parts = graph.nodes("Part").select("id", "name", F.col("name").startswith("small ").alias("gone"))
    customers = graph.nodes("Customer").select("id", "name", (F.col("segment") == "FURNITURE").alias("gone"))
    nodes = parts.unionByName(customers).withColumn("key", F.concat(F.lit("n"), F.col("id").cast("string")))
    return nodes.select("id", "key", "name"), graph.links(), nodes.filter("gone").select("key")


@query(
    "d1_delete_by_id_all_types",
    with_ctes("part_n customer_n all_links", f"SELECT src, type, dst FROM all_links WHERE src NOT IN ({ALL_GONE}) AND dst NOT IN ({ALL_GONE})"),
)
def d1_by_id(spark, folder):
    """Nodes of two labels deleted by adapter id, with every edge of any type at one of them."""
    nodes, links, keys = condemned(spark, folder)
    return delete.delete(nodes, links, ids=keys)[1]


@query(
    "d1_delete_nodes_by_id",
    with_ctes(
        "part_n customer_n",
        f"""SELECT id, 'n' || id AS key, name FROM (SELECT id, name FROM part_n UNION ALL SELECT id, name FROM customer_n)
        WHERE id NOT IN ({ALL_GONE})""",
    ),
)
def d1_nodes_by_id(spark, folder):
    nodes, links, keys = condemned(spark, folder)
    return delete.delete(nodes, links, ids=keys)[0]


@query(
    "d2_blocked_all_types",
    with_ctes(
        "part_n customer_n all_links",
        f"""SELECT id, count(*) AS edges FROM (SELECT src AS id FROM all_links UNION ALL SELECT dst FROM all_links)
        WHERE id IN ({ALL_GONE}) GROUP BY id""",
    ),
)
def d2_all(spark, folder):
    nodes, links, keys = condemned(spark, folder)
    return delete.blocked_deletes(links, nodes.join(keys, "key", "left_semi"))


@query(
    "d3_purge_all_types",
    with_ctes(
        "customer_n all_links",
        """SELECT src, type, dst FROM all_links WHERE src NOT IN (SELECT id FROM customer_n WHERE segment = 'BUILDING')
        AND dst NOT IN (SELECT id FROM customer_n WHERE segment = 'BUILDING')""",
    ),
)
def d3_all(spark, folder):
    graph = table_graph(spark, folder)
    return delete.purge(graph.nodes("Customer"), graph.links(), {"segment": "BUILDING"})[1]


def documents_with_body(spark, folder) -> DataFrame:
    """Documents whose text and size sit in one nested property; empty ones have none."""
    docs = table_graph(spark, folder).nodes("Document")
    body = F.when(F.col("lang") != "de", F.struct("text", "n_chars"))
    return docs.select("id", "lang", body.alias("body"))


BODY = """owned AS (SELECT d.id AS src, (SELECT max(id) FROM document_n) + row_number() OVER (ORDER BY d.id) AS id, text, n_chars
    FROM document_n d WHERE lang <> 'de')"""


def detached(spark, folder):
    nodes = documents_with_body(spark, folder)
    start = nodes.agg(F.max("id") + 1).scalar()
    return restructure.detach_document(nodes, "body", start)


@query("r1_detach_nodes", with_ctes("document_n", f"SELECT id, text, n_chars FROM (WITH {BODY} SELECT * FROM owned)"))
def r1_nodes(spark, folder):
    return detached(spark, folder)[1]


@query("r1_detach_edges", with_ctes("document_n", f"SELECT src, 'HAS_BODY' AS type, id AS dst FROM (WITH {BODY} SELECT * FROM owned)"))
def r1_edges(spark, folder):
    return detached(spark, folder)[2]


@query(
    "r2_attach_document",
    with_ctes("document_n", "SELECT id, lang, CASE WHEN lang <> 'de' THEN text END AS text, CASE WHEN lang <> 'de' THEN n_chars END AS n_chars FROM document_n"),
)
def r2(spark, folder):
    """Detach and attach again: every document has its body back."""
    nodes, bodies, edges = detached(spark, folder)
    whole, _, _ = restructure.attach_document(nodes, bodies, edges, "body")
    return whole.select("id", "lang", "body.text", "body.n_chars")


# -- schema ------------------------------------------------------------------------------


def document_table(spark, folder) -> DataFrame:
    """Documents with their embedding where they have one."""
    vectors = read_table(spark, folder, "embeddings").select(node_id("Document", "vec_id").alias("id"), "embedding")
    return table_graph(spark, folder).nodes("Document").join(vectors, "id", "left")


def node_tables(spark, folder) -> dict[str, DataFrame]:
    graph = table_graph(spark, folder)
    tables = {name: graph.nodes(name) for name in graph.labels}
    tables["Document"] = document_table(spark, folder)
    # A label nobody uses must not show up.
    tables["Ghost"] = graph.nodes("Region").filter(F.col("name") == "NOWHERE")
    return tables


def edge_tables(spark, folder) -> dict[str, DataFrame]:
    graph = table_graph(spark, folder)
    return {name: graph.edges(name) for name in graph.edge_types}


def label_properties(spark, folder) -> DataFrame:
    return schema.table_properties(node_tables(spark, folder))


def edge_properties(spark, folder) -> DataFrame:
    return schema.table_properties(edge_tables(spark, folder))


def schema_sql(tables: dict[str, tuple[str, dict[str, tuple[str, str]]]]) -> str:
    """``name, property, type, present, total`` from ``name -> (source, property -> (column, type))``."""
    parts = []
    for name, (source, columns) in tables.items():
        for prop, (column, kind) in (columns or {None: (None, None)}).items():
            shown = f"'{prop}', '{kind}', count({column})" if prop else "NULL, NULL, 0"
            parts.append(f"SELECT '{name}' AS name, {shown}, count(*) FROM {source}")
    return f"SELECT name, property, type, present, total FROM ({' UNION ALL '.join(parts)}) t(name, property, type, present, total)"


NODE_SCHEMA = schema_sql(
    {
        "Region": ("region", {"name": ("r_name", "STRING")}),
        "Nation": ("nation", {"name": ("n_name", "STRING")}),
        "Customer": (
            "customer", {"name": ("c_name", "STRING"), "segment": ("c_mktsegment", "STRING"), "acctbal": ("c_acctbal", "FLOAT64")},
        ),
        "Order": (
            "orders",
            {"status": ("o_orderstatus", "STRING"), "totalprice": ("o_totalprice", "FLOAT64"),
             "priority": ("o_orderpriority", "STRING"), "placed": ("o_orderdate", "TIMESTAMP")},
        ),
        "Part": (
            "part",
            {"name": ("p_name", "STRING"), "brand": ("p_brand", "STRING"), "type": ("p_type", "STRING"),
             "size": ("p_size", "INT64"), "retailprice": ("p_retailprice", "FLOAT64")},
        ),
        "Supplier": ("supplier", {"name": ("s_name", "STRING"), "acctbal": ("s_acctbal", "FLOAT64")}),
        "User": ("(SELECT DISTINCT user_id FROM events)", {"name": ("*", "STRING")}),
        "EventType": ("(SELECT DISTINCT event_type FROM events)", {"name": ("event_type", "STRING")}),
        "Document": (
            "documents LEFT JOIN embeddings ON vec_id = doc_id",
            {"text": ("text", "STRING"), "lang": ("lang", "STRING"), "source": ("source", "STRING"),
             "n_chars": ("n_chars", "INT64"), "embedding": ("embedding", "VECTOR")},
        ),
        "Turn": ("conversations", {"role": ("role", "STRING"), "text": ("text", "STRING")}),
    }
)
EDGE_SCHEMA = schema_sql(
    {
        "PLACED": ("orders", {}),
        "CONTAINS": ("lineitem", {"quantity": ("l_quantity", "FLOAT64"), "price": ("l_extendedprice", "FLOAT64")}),
        "SUPPLIED_BY": ("(SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)", {}),
        "IN_NATION": ("(SELECT c_custkey FROM customer UNION ALL SELECT s_suppkey FROM supplier)", {}),
        "IN_REGION": ("nation", {}),
        "BOUGHT_WITH": (
            "(SELECT DISTINCT a, l_partkey FROM (SELECT l_orderkey AS o, min(l_partkey) AS a FROM lineitem GROUP BY 1) "
            "JOIN lineitem ON l_orderkey = o WHERE l_partkey > a)", {},
        ),
        "DID": ("events", {"ts": ("ts", "TIMESTAMP"), "value": ("value", "FLOAT64")}),
        "NEXT": ("conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1", {}),
    }
)


@query("s1_infer_labels", NODE_SCHEMA)
def s1(spark, folder):
    return label_properties(spark, folder)


@query("s1_infer_edge_types", EDGE_SCHEMA)
def s1_edges(spark, folder):
    return edge_properties(spark, folder)


@query("s1_infer_schema_free", "SELECT event_type AS name, 'k' AS property, 'INT64' AS type, count(*) AS present FROM events GROUP BY event_type")
def s1_free(spark, folder):
    return schema.map_properties(event_rows(spark, folder))


@query(
    "s2_schema_text",
    f"""WITH n AS ({NODE_SCHEMA}), e AS ({EDGE_SCHEMA}), lines AS (
        SELECT part, name, '  - ' || name || coalesce(' (properties: ' || string_agg(property || ': ' || type, ', ' ORDER BY property) || ')', '') AS line
        FROM (SELECT 'n' AS part, * FROM n UNION ALL SELECT 'e', * FROM e) GROUP BY part, name)
    SELECT 'Node labels:' || chr(10) || (SELECT string_agg(line, chr(10) ORDER BY name) FROM lines WHERE part = 'n')
        || chr(10) || chr(10) || 'Edge types:' || chr(10) || (SELECT string_agg(line, chr(10) ORDER BY name) FROM lines WHERE part = 'e') AS schema""",
)
def s2(spark, folder):
    return schema.schema_text(label_properties(spark, folder), edge_properties(spark, folder))


@query(
    "s3_structured_schema",
    with_ctes(
        "all_links all_nodes",
        f"""SELECT 'node_props' AS section, name, property AS detail, type AS kind FROM ({NODE_SCHEMA})
        UNION ALL SELECT 'rel_props', name, property, type FROM ({EDGE_SCHEMA})
        UNION ALL SELECT DISTINCT 'relationships', a.label, e.type, b.label FROM all_links e
        JOIN all_nodes a ON a.id = e.src JOIN all_nodes b ON b.id = e.dst""",
    ),
)
def s3(spark, folder):
    graph = table_graph(spark, folder)
    triples = match.relationship_triples(graph.links(), graph.all_nodes().select("id", "labels"))
    return schema.structured_schema(label_properties(spark, folder), edge_properties(spark, folder), triples)


def event_rows(spark, folder) -> DataFrame:
    """Events as schema-free rows: label is the event type, properties the parsed JSON."""
    parsed = F.parse_json("props").cast("map<string,variant>")
    return read_table(spark, folder, "events").select(
        F.col("event_type").alias("label"), F.col("event_id").alias("id"), parsed.alias("props")
    )


MODES = {"view": "strict", "click": "strict", "purchase": "validated", "error": "flexible", "signup": 2}


def declared_events(spark) -> DataFrame:
    """``k`` is declared as int on clicks, as string on purchases, and not at all on views."""
    rows = schema.declare(spark, "click", [{"name": "k", "type": "int64"}])
    for label in ("purchase", "error", "signup"):
        rows = rows.unionByName(schema.declare(spark, label, [{"name": "k"}]))
    return rows


@query("s4_mode_check", "SELECT 'view' AS label, event_id AS id, 'k' AS property FROM events WHERE event_type = 'view'")
def s4(spark, folder):
    found = schema.mode_violations(event_rows(spark, folder), declared_events(spark), MODES)
    return found.select("label", "id", "property")


def shop_registry(spark) -> DataFrame:
    """Declared schema of two labels and an edge type, with versions, modes and flags."""
    documents = [{"name": "text", "required": True}, {"name": "embedding", "type": "vector", "required": True}, {"name": "license"}]
    parts = [{"name": "name", "unique": True}, {"name": "p_partkey", "type": "int64", "unique": True}]
    rows = schema.register(spark, "Document", documents, "validated", 2)
    rows = rows.unionByName(schema.register(spark, "Part", parts))
    return rows.unionByName(schema.register(spark, "Ghost", None, "flexible"))


@query(
    "s1_declared_labels",
    f"""WITH declared AS (SELECT * FROM (VALUES ('Document', 'text', 'STRING', true, false), ('Document', 'embedding', 'VECTOR', true, false),
        ('Document', 'license', 'STRING', false, false), ('Part', 'name', 'STRING', false, true), ('Part', 'p_partkey', 'INT64', false, true))
        t(name, property, declared, required, "unique")),
    heads AS (SELECT * FROM (VALUES ('Document', 2, 2), ('Part', 1, 1), ('Ghost', 1, 3)) t(name, version, mode)),
    n AS (SELECT * FROM ({NODE_SCHEMA}) WHERE property IS NOT NULL)
    SELECT coalesce(n.name, d.name) AS name, h.version, coalesce(h.mode, 0) AS mode, coalesce(n.property, d.property) AS property,
        n.type, d.declared, coalesce(d.required, false) AS required, coalesce(d."unique", false) AS "unique", coalesce(n.present, 0) AS present
    FROM n FULL JOIN declared d ON d.name = n.name AND d.property = n.property LEFT JOIN heads h ON h.name = coalesce(n.name, d.name)""",
)
def s1_declared(spark, folder):
    """What is in the tables next to what was declared, with version and mode of each label."""
    return schema.with_registry(label_properties(spark, folder), shop_registry(spark))


@query(
    "s5_required",
    with_ctes("document_n", "SELECT id, 'embedding' AS property FROM document_n LEFT JOIN embeddings ON vec_id = doc_id WHERE embedding IS NULL"),
)
def s5_required(spark, folder):
    required = schema.flagged(shop_registry(spark), "Document", "required")
    return schema.required_violations(document_table(spark, folder), required)


@query(
    "s5_unique",
    """SELECT 'name' AS property, p_name AS value, count(*) AS count FROM part GROUP BY p_name HAVING count(*) > 1
    UNION ALL SELECT 'p_partkey', CAST(p_partkey AS VARCHAR), count(*) FROM part GROUP BY p_partkey HAVING count(*) > 1""",
)
def s5_unique(spark, folder):
    parts = read_table(spark, folder, "part").select(F.col("p_name").alias("name"), "p_partkey")
    return schema.unique_violations(parts, schema.flagged(shop_registry(spark), "Part", "unique"))


@query(
    "s6_type_check",
    "SELECT event_type AS label, event_id AS id, 'k' AS property, 'INT64' AS found, 'STRING' AS type FROM events WHERE event_type IN ('purchase', 'signup')",
)
def s6(spark, folder):
    found = schema.type_violations(event_rows(spark, folder), declared_events(spark), MODES)
    return found.select("label", "id", "property", "found", "type")


@query("s6_dimension_check", "SELECT vec_id AS id, CAST(len(embedding) AS INTEGER) + 1 AS found FROM embeddings WHERE label = 3")
def s6_dimension(spark, folder):
    """One label is given an extra number, so its vectors no longer have 64."""
    vectors = read_table(spark, folder, "embeddings")
    longer = F.when(F.col("label") == 3, F.array_append("embedding", F.lit(0.0).cast("float"))).otherwise(F.col("embedding"))
    return schema.dimension_violations(vectors.select(F.col("vec_id").alias("id"), longer.alias("embedding")), 64)
