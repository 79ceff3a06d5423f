"""Scans, filters, pattern matching, traversal, aggregation and look-ups on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.catalog.registry import nid, query, with_ctes
from weftgraph.catalog.stored import written
from weftgraph.operators import aggregate, filters, lookup, match, scan
from weftgraph.sources.tables import bought_together, node_id, read_table, table_graph

NAMED = ("Region", "Nation", "Customer", "Part", "Supplier")
NAMES_SQL = " UNION ALL ".join(f"SELECT id, '{n}' AS label, name FROM {n.lower()}_n" for n in NAMED)
NAMED_CTES = "region_n nation_n customer_n part_n supplier_n"


def every_node(spark, folder) -> DataFrame:
    """All labels; labels without a name give NULL."""
    return table_graph(spark, folder).all_nodes().select("id", "labels", "name")


# -- scans, sources, sinks ---------------------------------------------------------------


@query("g1_node_scan", with_ctes("part_n", "SELECT id, name, brand, size FROM part_n"))
def g1(spark, folder):
    return table_graph(spark, folder).nodes("Part").select("id", "name", "brand", "size")


@query("g2_label_free_scan", with_ctes("all_nodes", "SELECT id, label, name FROM all_nodes"))
def g2(spark, folder):
    nodes = every_node(spark, folder)
    return nodes.select("id", filters.stable_label("labels").alias("label"), "name")


@query(
    "g3_edge_scan_alternation",
    with_ctes(
        "placed in_nation",
        "SELECT 'PLACED' AS type, src, dst FROM placed UNION ALL SELECT 'IN_NATION', src, dst FROM in_nation",
    ),
)
def g3(spark, folder):
    return table_graph(spark, folder).edges("PLACED", "IN_NATION").select("type", "src", "dst")


@query(
    "g3_edge_scan_wildcard",
    with_ctes("all_links", "SELECT type, count(*) AS n, max(dst) AS last_dst FROM all_links GROUP BY type"),
)
def g3_wildcard(spark, folder):
    edges = table_graph(spark, folder).links()
    return edges.groupBy("type").agg(F.count("*").alias("n"), F.max("dst").alias("last_dst"))


@query(
    "g4_graph_from_tables",
    with_ctes(
        f"{NAMED_CTES} user_n event_type_n turn_n did next_turn",
        f"""SELECT 'node' AS part, label AS name, count(*) AS n, min(id) AS first_id FROM (
            {NAMES_SQL} UNION ALL SELECT id, 'User', name FROM user_n UNION ALL SELECT id, 'EventType', name FROM event_type_n
            UNION ALL SELECT id, 'Turn', role FROM turn_n) GROUP BY label
        UNION ALL SELECT 'edge', 'DID', count(*), min(src) FROM did
        UNION ALL SELECT 'edge', 'NEXT', count(*), min(src) FROM next_turn""",
    ),
)
def g4(spark, folder):
    graph = table_graph(spark, folder)
    nodes = graph.all_nodes(*NAMED, "User", "EventType", "Turn").select(F.explode("labels").alias("name"), "id")
    edges = graph.links("DID", "NEXT").select(F.col("type").alias("name"), F.col("src").alias("id"))
    both = nodes.withColumn("part", F.lit("node")).unionByName(edges.withColumn("part", F.lit("edge")))
    return both.groupBy("part", "name").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


@query(
    "g5_create_nodes",
    with_ctes(
        "part_n",
        """SELECT (SELECT max(id) FROM part_n) + row_number() OVER (ORDER BY event_id) AS id, event_id, event_type, value
        FROM events""",
    ),
)
def g5(spark, folder):
    existing = table_graph(spark, folder).nodes("Part")
    new = read_table(spark, folder, "events").select("event_id", "event_type", "value")
    return scan.create_nodes(existing, new, ["event_id"])


@query(
    "g6_create_edges",
    with_ctes(
        "document_n",
        f"""SELECT row_number() OVER (ORDER BY event_id) AS edge_id, src, dst, event_id FROM (
            SELECT {nid('Customer', 'user_id')} AS src, {nid('Document', 'event_id')} AS dst, event_id
            FROM events WHERE event_type = 'view')
        WHERE dst IN (SELECT id FROM document_n)
          AND src IN (SELECT {nid('Customer', 'c_custkey')} FROM customer)""",
    ),
)
def g6(spark, folder):
    graph = table_graph(spark, folder)
    wanted = (
        read_table(spark, folder, "events")
        .filter(F.col("event_type") == "view")
        .select(node_id("Customer", "user_id").alias("src"), node_id("Document", "event_id").alias("dst"), "event_id")
    )
    made = scan.create_edges(graph.nodes("Customer"), graph.nodes("Document"), wanted, ["event_id"])
    return made.select("edge_id", "src", "dst", "event_id")


@query(
    "g7_lookup_by_id",
    with_ctes(
        "customer_n placed",
        """SELECT id, name, segment FROM customer_n WHERE id IN (SELECT src FROM placed JOIN orders
        ON dst = """ + nid("Order", "o_orderkey") + " WHERE o_orderpriority = '1-URGENT')",
    ),
)
def g7(spark, folder):
    urgent = read_table(spark, folder, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    ids = urgent.select(node_id("Customer", "o_custkey").alias("id"))
    return scan.lookup_nodes(table_graph(spark, folder).nodes("Customer"), ids).select("id", "name", "segment")


@query(
    "g8_list_facts",
    with_ctes(
        "all_links all_nodes",
        """SELECT a.name AS subject, e.type AS relation, b.name AS object FROM all_links e
        JOIN all_nodes a ON a.id = e.src JOIN all_nodes b ON b.id = e.dst""",
    ),
)
def g8(spark, folder):
    return scan.facts(table_graph(spark, folder).links(), every_node(spark, folder))


# -- filters, projections, expressions ---------------------------------------------------


@query(
    "f1_inline_properties",
    with_ctes("part_n", "SELECT id, name FROM part_n WHERE brand = 'Brand#12' AND type = 'PROMO'"),
)
def f1(spark, folder):
    parts = table_graph(spark, folder).nodes("Part")
    return filters.where_equal(parts, {"brand": "Brand#12", "type": "PROMO"}).select("id", "name")


@query("f2_property_list", with_ctes("customer_n", "SELECT id, name, acctbal FROM customer_n WHERE segment = 'MACHINERY'"))
def f2(spark, folder):
    customers = table_graph(spark, folder).nodes("Customer")
    return lookup.get_nodes(customers, properties={"segment": "MACHINERY"}).select("id", "name", "acctbal")


@query(
    "f3_membership",
    with_ctes(
        "part_n bought_with",
        """SELECT id, name, brand FROM part_n WHERE brand IN ('Brand#3', 'Brand#7', 'Brand#21')
        AND type NOT IN ('PROMO', 'SMALL') AND id NOT IN (SELECT dst FROM bought_with)""",
    ),
)
def f3(spark, folder):
    graph = table_graph(spark, folder)
    parts = filters.where_in(graph.nodes("Part"), "brand", ["Brand#3", "Brand#7", "Brand#21"])
    parts = filters.where_in(parts, "type", ["PROMO", "SMALL"], negate=True)
    followers = graph.edges("BOUGHT_WITH").select("dst")
    return filters.where_in(parts, "id", followers, negate=True).select("id", "name", "brand")


@query(
    "f4_prefix_suffix",
    with_ctes("part_n", "SELECT id, name FROM part_n WHERE starts_with(name, 'small') OR ends_with(name, 'bolt')"),
)
def f4(spark, folder):
    name = F.col("name")
    parts = table_graph(spark, folder).nodes("Part")
    return parts.filter(name.startswith("small") | name.endswith("bolt")).select("id", "name")


@query(
    "f5_null_and_boolean",
    with_ctes(
        "document_n",
        """SELECT id, lang, embedding IS NOT NULL AS embedded FROM document_n LEFT JOIN embeddings ON vec_id = doc_id
        WHERE (embedding IS NOT NULL AND lang = 'en') OR (embedding IS NULL AND n_chars > 5000)""",
    ),
)
def f5(spark, folder):
    vectors = read_table(spark, folder, "embeddings").select(node_id("Document", "vec_id").alias("id"), "embedding")
    docs = table_graph(spark, folder).nodes("Document").join(vectors, "id", "left")
    has = F.col("embedding").isNotNull()
    kept = docs.filter((has & (F.col("lang") == "en")) | (~has & (F.col("n_chars") > 5000)))
    return kept.select("id", "lang", has.alias("embedded"))


@query(
    "f6_projection",
    with_ctes(
        "customer_n", "SELECT acctbal AS balance, 'checked' AS s, 42 AS n, name AS \"n.name\" FROM customer_n"
    ),
)
def f6(spark, folder):
    customers = table_graph(spark, folder).nodes("Customer")
    return customers.select(
        F.col("acctbal").alias("balance"), F.lit("checked").alias("s"), F.lit(42).alias("n"), F.col("name").alias("n.name")
    )


@query(
    "f7_labels",
    with_ctes("all_nodes", "SELECT id, label AS labels FROM all_nodes"),
)
def f7(spark, folder):
    return every_node(spark, folder).select("id", F.array_join("labels", ",").alias("labels"))


@query(
    "f8_edge_type",
    with_ctes(
        "supplied_by in_region",
        "SELECT 'SUPPLIED_BY' AS rel, src FROM supplied_by UNION ALL SELECT 'IN_REGION', src FROM in_region",
    ),
)
def f8(spark, folder):
    return table_graph(spark, folder).edges("SUPPLIED_BY", "IN_REGION").select(F.col("type").alias("rel"), "src")


def multi_label_parts(spark, folder) -> DataFrame:
    """Parts that also carry a label taken from their type."""
    parts = table_graph(spark, folder).nodes("Part")
    return parts.select("id", F.array(F.lit("Part"), F.initcap("type")).alias("labels"))


INITCAP = "upper(type[1]) || lower(substr(type, 2))"


@query(
    "f9_stable_label",
    with_ctes("part_n", f"SELECT id, least('Part', {INITCAP}) AS label FROM part_n"),
)
def f9(spark, folder):
    return multi_label_parts(spark, folder).select("id", filters.stable_label("labels").alias("label"))


@query(
    "f10_unwind_labels",
    with_ctes(
        "part_n", f"SELECT id, 'Part' AS label FROM part_n UNION ALL SELECT id, {INITCAP} FROM part_n"
    ),
)
def f10(spark, folder):
    return filters.unwind_labels(multi_label_parts(spark, folder)).select("id", "label")


@query(
    "f11_timestamp",
    with_ctes("order_n", "SELECT id, true AS stamped, 1 AS distinct_times FROM order_n"),
)
def f11(spark, folder):
    stamped = filters.created_now(table_graph(spark, folder).nodes("Order").select("id"), "created")
    stamped = filters.created_now(stamped, "again")
    same = F.when(F.col("created") == F.col("again"), 1).otherwise(2)
    return stamped.select("id", F.col("created").isNotNull().alias("stamped"), same.alias("distinct_times"))


@query(
    "f12_scope",
    """SELECT a.conv_id, a.turn AS question, b.turn AS answer FROM conversations a JOIN conversations b
    ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user' AND b.role = 'assistant'""",
)
def f12(spark, folder):
    turns = read_table(spark, folder, "conversations").select("conv_id", "turn", "role")
    asked = filters.scope(turns, "role", "user").select("conv_id", F.col("turn").alias("question"))
    answered = filters.scope(turns, "role", "assistant").select("conv_id", F.col("turn").alias("answer"))
    next_up = asked.withColumn("answer", F.col("question") + 1)
    return next_up.join(answered, ["conv_id", "answer"]).select("conv_id", "question", "answer")


# -- joins and patterns ------------------------------------------------------------------


@query(
    "j1_one_hop",
    with_ctes(
        "customer_n order_n placed",
        """SELECT c.name AS customer, o.id AS order_id, o.totalprice FROM customer_n c JOIN placed e ON e.src = c.id
        JOIN order_n o ON o.id = e.dst WHERE c.segment = 'MACHINERY' AND o.status = 'F'""",
    ),
)
def j1(spark, folder):
    graph = table_graph(spark, folder)
    customers = filters.where_equal(graph.nodes("Customer"), {"segment": "MACHINERY"}).select("id", "name")
    orders = filters.where_equal(graph.nodes("Order"), {"status": "F"}).select("id", "totalprice")
    hit = match.one_hop(customers, graph.edges("PLACED"), orders, "c", "o")
    return hit.select(F.col("c_name").alias("customer"), F.col("o_id").alias("order_id"), F.col("o_totalprice").alias("totalprice"))


FLAGSHIP_SQL = with_ctes(
    "customer_n placed contains part_n",
    """SELECT p.id AS part_id, p.name, count(*) AS n FROM customer_n c JOIN placed e1 ON e1.src = c.id
    JOIN contains e2 ON e2.src = e1.dst JOIN part_n p ON p.id = e2.dst WHERE c.segment = 'MACHINERY'
    GROUP BY p.id, p.name ORDER BY n DESC, part_id LIMIT 10""",
)


@query("flagship_top_parts_of_segment", FLAGSHIP_SQL)
def flagship(spark, folder):
    """``(c:Customer {segment})-[:PLACED]->()-[:CONTAINS]->(p:Part)``: most ordered parts.

    Lines are counted per part before the part names are joined, so the last join is small.
    """
    graph = table_graph(spark, folder)
    customers = filters.where_equal(graph.nodes("Customer"), {"segment": "MACHINERY"}).select(F.col("id").alias("a"))
    hops = match.two_hops(graph.edges("PLACED"), graph.edges("CONTAINS")).join(customers, "a", "left_semi")
    counted = aggregate.count_by(hops, ["c"], "n").withColumnRenamed("c", "part_id")
    best = counted.orderBy(F.desc("n"), "part_id").limit(10)
    parts = graph.nodes("Part").select(F.col("id").alias("part_id"), "name")
    return best.join(parts, "part_id").select("part_id", "name", "n").orderBy(F.desc("n"), "part_id")


@query(
    "j2_two_hops_same_type",
    with_ctes("bought_with", "SELECT x.src AS a, x.dst AS b, y.dst AS c FROM bought_with x JOIN bought_with y ON y.src = x.dst"),
)
def j2(spark, folder):
    edges = match.edges_by_ends(table_graph(spark, folder).edges("BOUGHT_WITH"))
    return match.two_hops(edges, edges, same_type=True)


@query(
    "j2_parallel_edges",
    """SELECT x.l_partkey AS part, count(*) AS pairs FROM lineitem x JOIN lineitem y ON x.l_partkey = y.l_partkey
    AND (x.l_orderkey <> y.l_orderkey OR x.l_linenumber <> y.l_linenumber) GROUP BY x.l_partkey""",
)
def j2_parallel(spark, folder):
    """``(o1)-[:CONTAINS]->(p)<-[:CONTAINS]-(o2)``: two lines of an order are two edges, none is used twice."""
    edges = table_graph(spark, folder).edges("CONTAINS")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "edge_id")
    key = F.col("b") - node_id("Part", F.lit(0))
    return match.pair_counts(edges, back, same_type=True, name="pairs").select(key.alias("part"), "pairs")


@query(
    "j2_chain_to_region",
    with_ctes(
        "region_n customer_n placed in_nation in_region",
        """SELECT r.name AS region, c.segment, count(*) AS orders FROM placed p JOIN customer_n c ON c.id = p.src
        JOIN in_nation n ON n.src = c.id JOIN in_region g ON g.src = n.dst JOIN region_n r ON r.id = g.dst
        GROUP BY r.name, c.segment""",
    ),
)
def j2_chain(spark, folder):
    """Order counts are reduced to one row per customer before the hops to nation and region."""
    graph = table_graph(spark, folder)
    per_customer = graph.edges("PLACED").groupBy("src").agg(F.count("*").alias("n"))
    located = match.two_hops(graph.edges("IN_NATION"), graph.edges("IN_REGION"))
    segments = graph.nodes("Customer").select(F.col("id").alias("a"), "segment")
    regions = graph.nodes("Region").select(F.col("id").alias("c"), F.col("name").alias("region"))
    rows = per_customer.withColumnRenamed("src", "a").join(segments, "a").join(located, "a").join(regions, "c")
    return rows.groupBy("region", "segment").agg(F.sum("n").alias("orders"))


PROMO = with_ctes(
    "part_n bought_with",
    """SELECT start, "end", hops, path FROM w WHERE hops >= 1""",
    {
        "w": """SELECT src AS start, dst AS "end", 1 AS hops, src || '>' || dst AS path FROM bought_with
        WHERE src IN (SELECT id FROM part_n WHERE type = 'PROMO')
        UNION ALL SELECT w.start, e.dst, hops + 1, path || '>' || e.dst FROM w JOIN bought_with e ON e.src = w."end"
        WHERE hops < 3"""
    },
)


def promo_parts(spark, folder) -> DataFrame:
    return filters.where_equal(table_graph(spark, folder).nodes("Part"), {"type": "PROMO"}).select("id")


@query("j3_variable_length_paths", PROMO)
def j3(spark, folder):
    edges = match.edges_by_ends(table_graph(spark, folder).edges("BOUGHT_WITH"))
    rows = match.paths(edges, promo_parts(spark, folder), 1, 3)
    text = F.array_join(F.col("path").cast("array<string>"), ">")
    return rows.select("start", "end", "hops", text.alias("path"))


REACH_SQL = """SELECT id AS start, id, 0 AS depth FROM {starts}
    UNION SELECT w.start, e.dst, depth + 1 FROM w JOIN {edges} e ON e.src = w.id WHERE depth < {depth}"""


@query(
    "j4_reachable_any_type",
    with_ctes(
        "customer_n all_links",
        "SELECT DISTINCT start, id FROM w WHERE id <> start",
        {
            "seed": "SELECT id FROM customer_n WHERE segment = 'FURNITURE'",
            "w": REACH_SQL.format(starts="seed", edges="all_links", depth=2),
        },
    ),
)
def j4(spark, folder):
    graph = table_graph(spark, folder)
    starts = filters.where_equal(graph.nodes("Customer"), {"segment": "FURNITURE"}).select("id")
    return match.reachable(graph.links(), starts, depth=2)


@query(
    "j5_traverse_outbound",
    with_ctes(
        "part_n bought_with",
        "SELECT start, id, min(depth) AS depth FROM w WHERE id <> start GROUP BY start, id",
        {
            "seed": "SELECT id FROM part_n WHERE type = 'PROMO'",
            "w": REACH_SQL.format(starts="seed", edges="bought_with", depth=4),
        },
    ),
)
def j5(spark, folder):
    edges = table_graph(spark, folder).edges("BOUGHT_WITH")
    return match.traverse(edges, promo_parts(spark, folder), "outbound", 4)[0]


@query(
    "j5_traverse_full_nodes",
    with_ctes(
        "part_n bought_with",
        """SELECT start, depth, p.id, name, brand, p.type, size, retailprice FROM
        (SELECT start, id, min(depth) AS depth FROM w WHERE id <> start GROUP BY start, id) r JOIN part_n p ON p.id = r.id""",
        {
            "seed": "SELECT id FROM part_n WHERE type = 'PROMO'",
            "w": REACH_SQL.format(starts="seed", edges="bought_with", depth=2),
        },
    ),
)
def j5_full(spark, folder):
    """Reached nodes with all their properties."""
    graph = table_graph(spark, folder)
    reached, _ = match.traverse(graph.edges("BOUGHT_WITH"), promo_parts(spark, folder), "outbound", 2)
    return match.with_nodes(reached, graph.nodes("Part"))


def stored_edges(spark, folder) -> match.StoredEdges:
    """The derived part to part edges by either end, stored for the session."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = read_table(spark, folder, "lineitem")
    return written("bought-with", lines, lambda path: match.StoredEdges(table_graph(spark, folder).edges("BOUGHT_WITH"), path, buckets))


@query(
    "j5_traverse_stored",
    with_ctes(
        "part_n bought_with",
        "SELECT start, id, min(depth) AS depth FROM w WHERE id <> start GROUP BY start, id",
        {
            "two_way": "SELECT src, dst FROM bought_with UNION ALL SELECT dst, src FROM bought_with",
            "seed": "SELECT id FROM part_n WHERE type = 'PROMO'",
            "w": REACH_SQL.format(starts="seed", edges="two_way", depth=2),
        },
    ),
)
def j5_stored(spark, folder):
    """Both directions over edges that are kept by either end and never moved again."""
    return match.traverse(stored_edges(spark, folder), promo_parts(spark, folder), "both", 2)[0]


@query(
    "j4_reachable_in_scope",
    with_ctes(
        "part_n bought_with",
        "SELECT DISTINCT start, id FROM w WHERE id <> start",
        {
            "seed": "SELECT id FROM part_n WHERE type = 'PROMO'",
            "inner_edges": "SELECT b.src, b.dst FROM bought_with b JOIN seed x ON x.id = b.src JOIN seed y ON y.id = b.dst",
            "w": REACH_SQL.format(starts="seed", edges="inner_edges", depth=3),
        },
    ),
)
def j4_scope(spark, folder):
    """Within one tag: starts, ends and all nodes between carry it. The depth asked is clamped to 1..3."""
    graph = table_graph(spark, folder)
    inside = promo_parts(spark, folder)
    return match.reachable(graph.links("BOUGHT_WITH"), inside, depth=9, least=1, most=3, scope=inside)


BOTH = {
    "two_way": "SELECT src, dst FROM bought_with UNION ALL SELECT dst, src FROM bought_with",
    "one_way_back": "SELECT dst AS src, src AS dst FROM bought_with",
    "seed": "SELECT id FROM part_n WHERE type = 'PROMO'",
}


@query(
    "j5_traverse_inbound",
    with_ctes(
        "part_n bought_with",
        "SELECT start, id, min(depth) AS depth FROM w WHERE id <> start GROUP BY start, id",
        {**BOTH, "w": REACH_SQL.format(starts="seed", edges="one_way_back", depth=3)},
    ),
)
def j5_inbound(spark, folder):
    edges = table_graph(spark, folder).edges("BOUGHT_WITH")
    return match.traverse(edges, promo_parts(spark, folder), "inbound", 3)[0]


#: Every pair of parts of one order, where ``bought_with`` has those of its smallest part only.
TOGETHER = {
    "order_parts": "SELECT DISTINCT l_orderkey AS o, l_partkey AS p FROM lineitem",
    "bought_together": f"SELECT DISTINCT {nid('Part', 'x.p')} AS src, {nid('Part', 'y.p')} AS dst "
    "FROM order_parts x JOIN order_parts y ON x.o = y.o WHERE y.p > x.p",
    "two_way": "SELECT src, dst FROM bought_together UNION ALL SELECT dst, src FROM bought_together",
    "seed": BOTH["seed"],
}


@query(
    "j5_traverse_both_edges",
    with_ctes(
        "part_n",
        """SELECT DISTINCT w.start, e.src, e.dst FROM w JOIN bought_together e ON e.src = w.id OR e.dst = w.id WHERE w.depth < 2""",
        {**TOGETHER, "w": REACH_SQL.format(starts="seed", edges="two_way", depth=1)},
    ),
)
def j5_both(spark, folder):
    """Over every pair of parts of an order."""
    edges = bought_together(read_table(spark, folder, "lineitem"))
    return match.traverse(edges, promo_parts(spark, folder), "Both", 2)[1]


@query(
    "j6_undirected",
    with_ctes(
        "all_links",
        """SELECT src AS node, dst AS other, type FROM all_links
        UNION ALL SELECT dst, src, type FROM all_links WHERE src <> dst""",
    ),
)
def j6(spark, folder):
    return match.undirected(table_graph(spark, folder).links())


@query(
    "j7_two_patterns",
    with_ctes(
        "customer_n nation_n",
        """SELECT c.id AS src, n.id AS dst, 'NATION_' || c_nationkey AS nation_name FROM customer JOIN customer_n c ON c.name = c_name
        JOIN nation_n n ON n.name = 'NATION_' || c_nationkey""",
    ),
)
def j7(spark, folder):
    graph = table_graph(spark, folder)
    pairs = read_table(spark, folder, "customer").select(
        F.col("c_name").alias("customer_name"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("nation_name"),
    )
    rows = match.match_pairs(graph.nodes("Customer"), graph.nodes("Nation"), pairs, "customer_name", "nation_name")
    return rows.select("src", "dst", "nation_name")


TRIPLETS = """SELECT e.src, a.name AS src_name, e.type AS rel, e.dst, b.name AS dst_name FROM all_links e
    JOIN all_nodes a ON a.id = e.src JOIN all_nodes b ON b.id = e.dst"""
TRIPLET_CTES = "all_links all_nodes"
ENTITIES = ["NATION_3", "Supplier#000000007", "small bolt"]
ENTITY_TEST = "src_name IN ('NATION_3', 'Supplier#000000007', 'small bolt') OR dst_name IN ('NATION_3', 'Supplier#000000007', 'small bolt')"


@query("j8_triplets_all", with_ctes(TRIPLET_CTES, TRIPLETS))
def j8_all(spark, folder):
    return match.triplets(table_graph(spark, folder).links(), every_node(spark, folder))


@query(
    "j8_triplets_of_entities",
    with_ctes(
        TRIPLET_CTES,
        f"SELECT * FROM ({TRIPLETS}) WHERE rel IN ('SUPPLIED_BY', 'IN_NATION') AND ({ENTITY_TEST})",
    ),
)
def j8(spark, folder):
    edges = table_graph(spark, folder).links()
    return match.triplets(edges, every_node(spark, folder), entity_names=ENTITIES, relation_names=["SUPPLIED_BY", "IN_NATION"])


@query(
    "j8_triplets_limited",
    with_ctes(TRIPLET_CTES, f"SELECT DISTINCT * FROM ({TRIPLETS}) WHERE {ENTITY_TEST} ORDER BY src, rel, dst LIMIT 1000"),
)
def j8_limited(spark, folder):
    """The caller's own limit over any relation."""
    edges = table_graph(spark, folder).links().distinct()
    return match.triplets(edges, every_node(spark, folder), entity_names=ENTITIES, limit=1000)


@query(
    "j9_relation_map_per_node",
    with_ctes(
        "customer_n all_links",
        """SELECT src, rel, dst FROM (SELECT src, type AS rel, dst, row_number() OVER (PARTITION BY src ORDER BY type, dst) AS r
        FROM all_links WHERE type NOT IN ('IN_NATION') AND src IN (SELECT id FROM customer_n WHERE segment = 'FURNITURE'))
        WHERE r <= 30""",
    ),
)
def j9(spark, folder):
    graph = table_graph(spark, folder)
    asked = filters.where_equal(graph.nodes("Customer"), {"segment": "FURNITURE"})
    return match.relation_map(graph.links(), asked, limit=30, ignore_rels=["IN_NATION"], per_node=True)


@query(
    "j9_relation_map",
    with_ctes(
        "part_n all_links",
        """SELECT src, type AS rel, dst FROM all_links WHERE type NOT IN ('BOUGHT_WITH')
        AND src IN (SELECT id FROM part_n WHERE type = 'PROMO')""",
    ),
)
def j9_total(spark, folder):
    edges = table_graph(spark, folder).links()
    return match.relation_map(edges, promo_parts(spark, folder), ignore_rels=["BOUGHT_WITH"])


@query(
    "j10_relationship_triples",
    with_ctes(
        "all_links all_nodes",
        """SELECT DISTINCT a.label AS start, e.type, b.label AS "end" FROM all_links e
        JOIN all_nodes a ON a.id = e.src JOIN all_nodes b ON b.id = e.dst""",
    ),
)
def j10(spark, folder):
    graph = table_graph(spark, folder)
    return match.relationship_triples(graph.links(), graph.all_nodes().select("id", "labels"))


@query(
    "j11_semi_and_anti",
    with_ctes(
        "customer_n placed",
        """SELECT id, name, id IN (SELECT src FROM placed) AS buyer FROM customer_n""",
    ),
)
def j11(spark, folder):
    graph = table_graph(spark, folder)
    customers = graph.nodes("Customer").select("id", "name")
    buyers = graph.edges("PLACED").select(F.col("src").alias("id"))
    with_orders = filters.where_in(customers, "id", buyers).withColumn("buyer", F.lit(True))
    without = filters.where_in(customers, "id", buyers, negate=True).withColumn("buyer", F.lit(False))
    return with_orders.unionByName(without)


# -- aggregation, ordering, limits -------------------------------------------------------


@query("a1_count", with_ctes("contains", "SELECT count(*) AS n, count(price) AS priced FROM contains"))
def a1(spark, folder):
    edges = table_graph(spark, folder).edges("CONTAINS")
    return edges.agg(F.count("*").alias("n"), F.count("price").alias("priced"))


@query(
    "a2_count_by_type",
    with_ctes("all_links", "SELECT type, count(*) AS count FROM all_links GROUP BY type ORDER BY count DESC, type"),
)
def a2(spark, folder):
    return aggregate.count_by_type(table_graph(spark, folder).links())


@query("a3_implicit_grouping", with_ctes("part_n", "SELECT brand, type, count(*) AS n FROM part_n GROUP BY brand, type"))
def a3(spark, folder):
    return aggregate.count_by(table_graph(spark, folder).nodes("Part"), ["brand", "type"], "n")


@query("a4_distinct", with_ctes("contains", "SELECT DISTINCT dst, quantity FROM contains"))
def a4(spark, folder):
    return table_graph(spark, folder).edges("CONTAINS").select("dst", "quantity").distinct()


@query("a5_order_by", with_ctes("supplier_n", "SELECT name, acctbal FROM supplier_n ORDER BY acctbal DESC, name ASC"))
def a5(spark, folder):
    suppliers = table_graph(spark, folder).nodes("Supplier").select("name", "acctbal")
    return suppliers.orderBy(F.desc("acctbal"), F.asc("name"))


@query(
    "a6_top_k",
    with_ctes("order_n", "SELECT id, totalprice FROM order_n ORDER BY totalprice DESC, id LIMIT 10"),
)
def a6(spark, folder):
    orders = table_graph(spark, folder).nodes("Order").select("id", "totalprice")
    return orders.orderBy(F.desc("totalprice"), "id").limit(10)


@query(
    "a6_top_k_per_group",
    with_ctes(
        "order_n",
        """SELECT priority, id, totalprice, rank FROM (SELECT priority, id, totalprice, CAST(row_number() OVER (PARTITION BY priority
        ORDER BY totalprice DESC, id) AS INTEGER) AS rank FROM order_n) WHERE rank <= 5""",
    ),
)
def a6_group(spark, folder):
    orders = table_graph(spark, folder).nodes("Order").select("priority", "id", "totalprice")
    return aggregate.top_k_per_group(orders, ["priority"], [F.desc("totalprice"), F.col("id")], 5)


@query(
    "a7_rank_in_list",
    """SELECT *, rank() OVER (PARTITION BY event_type ORDER BY value DESC NULLS LAST) AS rank FROM (SELECT event_id,
    nullif(event_type, 'error') AS event_type, CASE WHEN floor(value) <> 3 THEN value END AS value FROM events)""",
)
def a7(spark, folder):
    """Errors form the NULL group, values from 3 to 4 are NULL and rank last."""
    rows = read_table(spark, folder, "events").select(
        "event_id",
        F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
        F.when(F.floor("value") != 3, F.col("value")).alias("value"),
    )
    return aggregate.global_rank(rows, ["event_type"], "value").select("event_id", "event_type", "value", "rank")


# -- look-ups ----------------------------------------------------------------------------


@query(
    "n1_get_by_adapter_id",
    """SELECT c_name AS name, c_mktsegment AS segment FROM customer WHERE c_name IN (
    SELECT 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') FROM events WHERE event_type = 'purchase')""",
)
def n1(spark, folder):
    buyers = read_table(spark, folder, "events").filter(F.col("event_type") == "purchase")
    ids = buyers.select(F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0")))
    rows = lookup.get_nodes(table_graph(spark, folder).nodes("Customer"), ids=ids, id_column="name", limit=None)
    return rows.select("name", "segment")


@query(
    "n2_entity_view",
    """SELECT 'doc' || doc_id AS node_id, 'chunk' AS kind, NULL AS entity_name, 'Chunk' AS label, text FROM documents
    UNION ALL SELECT 'part' || p_partkey, 'entity', p_name, 'Entity', NULL FROM part
    UNION ALL SELECT 'order' || o_orderkey, 'entity', 'order' || o_orderkey, 'Entity', NULL FROM orders""",
)
def n2(spark, folder):
    docs = read_table(spark, folder, "documents").select(F.concat(F.lit("doc"), "doc_id").alias("key"), "text")
    parts = read_table(spark, folder, "part").select(
        F.concat(F.lit("part"), "p_partkey").alias("key"), F.col("p_name").alias("name")
    )
    orders = read_table(spark, folder, "orders").select(F.concat(F.lit("order"), "o_orderkey").alias("key"))
    nodes = docs.unionByName(parts, allowMissingColumns=True).unionByName(orders, allowMissingColumns=True)
    return lookup.entity_view(nodes)
