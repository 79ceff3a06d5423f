"""A property graph over relational Parquet tables.

Ids are a bijective code of kind and key, so building the graph needs no shuffle and no
lookup: ``kind * 2**56 + key + 1``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.plans.ordering import with_dense_ids
from weftgraph.plans.sizing import broadcast_if_small
from weftgraph.sources.graph import PropertyGraph

KIND_BASE = 2**56
TURN_BASE = 2**20

# The kind code of each label.
KINDS = {
    "Region": 1,
    "Nation": 2,
    "Customer": 3,
    "Order": 4,
    "Part": 5,
    "Supplier": 6,
    "User": 7,
    "EventType": 8,
    "Document": 9,
    "Turn": 10,
    "Body": 11,
}

#: Room for the lines of one order in an edge id; order keys may go up to 2**43.
LINE_BASE = 2**20


def node_id(label: str, key: Column | str) -> Column:
    """Internal id of a node with a natural integer key; a key beyond its kind's room is an error."""
    column = (F.col(key) if isinstance(key, str) else key).cast("long")
    outside = (column < 0) | (column >= KIND_BASE - 1)
    failed = F.raise_error(F.concat(F.lit(f"{label} key outside the id range: "), column.cast("string"))).cast("long")
    return F.lit(KINDS[label] * KIND_BASE + 1) + F.when(outside, failed).otherwise(column)


def packed(major: Column, minor: Column, base: int) -> Column:
    """``major * base + minor``; a minor number that needs more room is an error, never another id."""
    failed = F.raise_error(F.concat(F.lit(f"number outside 0..{base - 1}: "), minor.cast("string"))).cast("long")
    return major.cast("long") * base + F.when((minor < 0) | (minor >= base), failed).otherwise(minor.cast("long"))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bought_with(lineitem: DataFrame) -> DataFrame:
    """Part pairs of one order: the smallest part key linked to each larger one.

    The number of pairs grows with the lines, not with their square, so an order that holds a
    third of all lines costs no more than any other. The anchor is found by a map-side minimum.
    """
    lines = lineitem.select("l_orderkey", "l_partkey")
    anchors = lines.groupBy("l_orderkey").agg(F.min("l_partkey").alias("anchor"))
    return (
        lines.join(anchors, "l_orderkey")
        .filter(F.col("l_partkey") > F.col("anchor"))
        .select(node_id("Part", "anchor").alias("src"), node_id("Part", "l_partkey").alias("dst"))
        .distinct()
    )


def bought_together(lineitem: DataFrame) -> DataFrame:
    """Every pair of parts of one order, once, the smaller part key linked to the larger one.

    The pairs of an order grow with the square of its parts; ``bought_with`` has those of its smallest part only.
    """
    lines = lineitem.select("l_orderkey", "l_partkey").distinct()
    others = lines.withColumnRenamed("l_partkey", "other")
    return (
        lines.join(others, "l_orderkey")
        .filter(F.col("other") > F.col("l_partkey"))
        .select(node_id("Part", "l_partkey").alias("src"), node_id("Part", "other").alias("dst"))
        .distinct()
    )


def table_graph(spark: SparkSession, folder: str) -> PropertyGraph:
    """Nodes and edges derived from the tables under ``folder``."""

    def table(name: str) -> DataFrame:
        return read_table(spark, folder, name)

    def keyed(label: str, name: str, key: str, /, **props: str):
        return lambda: table(name).select(
            node_id(label, key).alias("id"), *[F.col(source).alias(prop) for prop, source in props.items()]
        )

    def event_types() -> DataFrame:
        names = table("events").select(F.col("event_type").alias("name")).distinct()
        return with_dense_ids(names, ["name"], start=KINDS["EventType"] * KIND_BASE + 1).select("id", "name")

    def users() -> DataFrame:
        return table("events").select("user_id").distinct().select(
            node_id("User", "user_id").alias("id"),
            F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("name"),
        )

    def turn_id(turn: Column) -> Column:
        return node_id("Turn", packed(F.col("conv_id"), turn, TURN_BASE))

    def did() -> DataFrame:
        kinds = event_types().select(F.col("id").alias("dst"), F.col("name").alias("event_type"))
        return table("events").join(broadcast_if_small(kinds), "event_type").select(
            F.col("event_id").alias("edge_id"), node_id("User", "user_id").alias("src"), "dst", "ts", "value"
        )

    def next_turn() -> DataFrame:
        here = table("conversations").select("conv_id", "turn")
        there = here.select("conv_id", (F.col("turn") - 1).alias("turn"))
        return here.join(there, ["conv_id", "turn"]).select(
            turn_id(F.col("turn")).alias("edge_id"),
            turn_id(F.col("turn")).alias("src"),
            turn_id(F.col("turn") + 1).alias("dst"),
        )

    def in_nation() -> DataFrame:
        customers = table("customer").select(node_id("Customer", "c_custkey").alias("src"), "c_nationkey")
        suppliers = table("supplier").select(node_id("Supplier", "s_suppkey").alias("src"), "s_nationkey")
        both = customers.union(suppliers).toDF("src", "key")
        return both.select(F.col("src").alias("edge_id"), "src", node_id("Nation", "key").alias("dst"))

    nodes = {
        "Region": keyed("Region", "region", "r_regionkey", name="r_name"),
        "Nation": keyed("Nation", "nation", "n_nationkey", name="n_name"),
        "Customer": keyed(
            "Customer", "customer", "c_custkey", name="c_name", segment="c_mktsegment", acctbal="c_acctbal"
        ),
        "Order": keyed(
            "Order", "orders", "o_orderkey",
            status="o_orderstatus", totalprice="o_totalprice", priority="o_orderpriority", placed="o_orderdate",
        ),
        "Part": keyed(
            "Part", "part", "p_partkey",
            name="p_name", brand="p_brand", type="p_type", size="p_size", retailprice="p_retailprice",
        ),
        "Supplier": keyed("Supplier", "supplier", "s_suppkey", name="s_name", acctbal="s_acctbal"),
        "User": users,
        "EventType": event_types,
        "Document": keyed(
            "Document", "documents", "doc_id", text="text", lang="lang", source="source", n_chars="n_chars"
        ),
        "Turn": lambda: table("conversations").select(turn_id(F.col("turn")).alias("id"), "role", "text"),
    }
    edges = {
        "PLACED": lambda: table("orders").select(
            F.col("o_orderkey").alias("edge_id"),
            node_id("Customer", "o_custkey").alias("src"),
            node_id("Order", "o_orderkey").alias("dst"),
        ),
        "CONTAINS": lambda: table("lineitem").select(
            packed(F.col("l_orderkey"), F.col("l_linenumber"), LINE_BASE).alias("edge_id"),
            node_id("Order", "l_orderkey").alias("src"),
            node_id("Part", "l_partkey").alias("dst"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("price"),
        ),
        "SUPPLIED_BY": lambda: table("lineitem")
        .select(node_id("Part", "l_partkey").alias("src"), node_id("Supplier", "l_suppkey").alias("dst"))
        .distinct(),
        "IN_NATION": in_nation,
        "IN_REGION": lambda: table("nation").select(
            F.col("n_nationkey").cast("long").alias("edge_id"),
            node_id("Nation", "n_nationkey").alias("src"),
            node_id("Region", "n_regionkey").alias("dst"),
        ),
        "DID": did,
        "NEXT": next_turn,
        "BOUGHT_WITH": lambda: bought_with(table("lineitem")),
    }
    return PropertyGraph(nodes, edges)
