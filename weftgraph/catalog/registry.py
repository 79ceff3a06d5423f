"""Registry of runnable queries: name, Spark callable and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weftgraph.sources.tables import KIND_BASE, KINDS, TURN_BASE

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under ``name``; without ``sql`` it is checked by the tests only."""

    def add(run: Run) -> Run:
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return add


def nid(label: str, key: str) -> str:
    """SQL text of a node id."""
    return f"({KINDS[label] * KIND_BASE + 1} + CAST({key} AS BIGINT))"


# Common table expressions the SQL checks are put together from.
CTES = {
    "region_n": f"SELECT {nid('Region', 'r_regionkey')} AS id, r_name AS name FROM region",
    "nation_n": f"SELECT {nid('Nation', 'n_nationkey')} AS id, n_name AS name FROM nation",
    "customer_n": f"SELECT {nid('Customer', 'c_custkey')} AS id, c_name AS name, c_mktsegment AS segment, "
    "c_acctbal AS acctbal FROM customer",
    "order_n": f"SELECT {nid('Order', 'o_orderkey')} AS id, o_orderstatus AS status, o_totalprice AS totalprice, "
    "o_orderpriority AS priority FROM orders",
    "part_n": f"SELECT {nid('Part', 'p_partkey')} AS id, p_name AS name, p_brand AS brand, p_type AS type, "
    "p_size AS size, p_retailprice AS retailprice FROM part",
    "supplier_n": f"SELECT {nid('Supplier', 's_suppkey')} AS id, s_name AS name, s_acctbal AS acctbal FROM supplier",
    "user_n": f"SELECT DISTINCT {nid('User', 'user_id')} AS id, 'user' || user_id AS name FROM events",
    "event_type_n": f"SELECT {KINDS['EventType'] * KIND_BASE} + row_number() OVER (ORDER BY name) AS id, name "
    "FROM (SELECT DISTINCT event_type AS name FROM events)",
    "document_n": f"SELECT {nid('Document', 'doc_id')} AS id, doc_id, text, lang, source, n_chars FROM documents",
    "turn_n": f"SELECT {nid('Turn', f'conv_id * {TURN_BASE} + turn')} AS id, role, text FROM conversations",
    "placed": f"SELECT {nid('Customer', 'o_custkey')} AS src, {nid('Order', 'o_orderkey')} AS dst FROM orders",
    "contains": f"SELECT {nid('Order', 'l_orderkey')} AS src, {nid('Part', 'l_partkey')} AS dst, "
    "l_quantity AS quantity, l_extendedprice AS price FROM lineitem",
    "supplied_by": f"SELECT DISTINCT {nid('Part', 'l_partkey')} AS src, {nid('Supplier', 'l_suppkey')} AS dst "
    "FROM lineitem",
    "in_nation": f"SELECT {nid('Customer', 'c_custkey')} AS src, {nid('Nation', 'c_nationkey')} AS dst FROM customer "
    f"UNION ALL SELECT {nid('Supplier', 's_suppkey')}, {nid('Nation', 's_nationkey')} FROM supplier",
    "in_region": f"SELECT {nid('Nation', 'n_nationkey')} AS src, {nid('Region', 'n_regionkey')} AS dst FROM nation",
    "did": f"SELECT event_id AS edge_id, {nid('User', 'user_id')} AS src, t.id AS dst, value "
    "FROM events JOIN event_type_n t ON t.name = event_type",
    "next_turn": f"SELECT {nid('Turn', f'a.conv_id * {TURN_BASE} + a.turn')} AS src, "
    f"{nid('Turn', f'b.conv_id * {TURN_BASE} + b.turn')} AS dst "
    "FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1",
    "bought_anchor": "SELECT l_orderkey AS o, min(l_partkey) AS a FROM lineitem GROUP BY l_orderkey",
    "bought_with": f"SELECT DISTINCT {nid('Part', 'a')} AS src, {nid('Part', 'l_partkey')} AS dst "
    "FROM bought_anchor JOIN lineitem ON l_orderkey = o WHERE l_partkey > a",
    # Every edge with its type, and every node with its label and name where it has one.
    "all_links": "SELECT src, 'PLACED' AS type, dst FROM placed UNION ALL SELECT src, 'CONTAINS', dst FROM contains "
    "UNION ALL SELECT src, 'SUPPLIED_BY', dst FROM supplied_by UNION ALL SELECT src, 'IN_NATION', dst FROM in_nation "
    "UNION ALL SELECT src, 'IN_REGION', dst FROM in_region UNION ALL SELECT src, 'BOUGHT_WITH', dst FROM bought_with "
    "UNION ALL SELECT src, 'DID', dst FROM did UNION ALL SELECT src, 'NEXT', dst FROM next_turn",
    "all_nodes": " UNION ALL ".join(
        f"SELECT id, '{label}' AS label, {name} AS name FROM {table}"
        for label, name, table in (
            ("Region", "name", "region_n"), ("Nation", "name", "nation_n"), ("Customer", "name", "customer_n"),
            ("Order", "CAST(NULL AS VARCHAR)", "order_n"), ("Part", "name", "part_n"), ("Supplier", "name", "supplier_n"),
            ("User", "name", "user_n"), ("EventType", "name", "event_type_n"),
            ("Document", "CAST(NULL AS VARCHAR)", "document_n"), ("Turn", "CAST(NULL AS VARCHAR)", "turn_n"),
        )
    ),
}

NEEDS = {
    "did": ["event_type_n"],
    "bought_with": ["bought_anchor"],
    "all_links": [
        "placed", "contains", "supplied_by", "in_nation", "in_region", "bought_anchor", "bought_with", "event_type_n", "did",
        "next_turn",
    ],
    "all_nodes": [
        "region_n", "nation_n", "customer_n", "order_n", "part_n", "supplier_n", "user_n", "event_type_n", "document_n", "turn_n",
    ],
}


def with_ctes(names: str, body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` preceded by the named common table expressions and what they need."""
    ordered: list[str] = []
    for name in names.split():
        for part in [*NEEDS.get(name, []), name]:
            if part not in ordered:
                ordered.append(part)
    parts = [f"{name} AS ({CTES[name]})" for name in ordered]
    parts += [f"{name} AS ({text})" for name, text in (extra or {}).items()]
    return f"WITH RECURSIVE {', '.join(parts)} {body}"
