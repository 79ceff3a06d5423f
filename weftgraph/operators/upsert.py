"""Upserts of nodes, edges and graph documents, many at once.

Nodes are rows ``(label, key, props)``, edges ``(src_label, src_key, type, dst_label, dst_key,
props)`` with ``props`` a map. A batch row also has ``seq``, a unique value that orders the writes;
the outcome is that of writing the rows one by one in that order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.functions.props import document_hash, merge_props

NODE_KEY = ["label", "key"]
EDGE_KEY = ["src_label", "src_key", "type", "dst_label", "dst_key"]
DEFAULT_LABEL = "Entity"
DOCUMENT_LABEL = "__Document__"
MENTIONS = "MENTIONS"


def _latest(batch: DataFrame, key: list[str]) -> DataFrame:
    """One property map per key: for each property the value with the highest ``seq``.

    The last value is picked map-side per (key, property); a key written by a third of the batch
    reaches the shuffle as one row per task and property.
    """
    split = batch.select(*key, "seq", F.explode_outer("props").alias("__prop", "__value"))
    last = split.groupBy(*key, "__prop").agg(F.max_by("__value", "seq").alias("__value"))
    entries = F.collect_list(F.struct("__prop", "__value"))
    named = F.filter(entries, lambda e: e["__prop"].isNotNull())
    return last.groupBy(*key).agg(F.map_from_entries(named).alias("__patch"))


def upsert_nodes(stored: DataFrame, batch: DataFrame, key_property: str = "name") -> DataFrame:
    """Create or update nodes by ``(label, key)``; properties not mentioned survive.

    The key also becomes property ``key_property`` and wins over a value given for it. A row
    without a label gets ``Entity``.
    """
    clean = batch.withColumn("label", F.coalesce("label", F.lit(DEFAULT_LABEL)))
    value_type = batch.schema["props"].dataType.valueType
    own = F.create_map(F.lit(key_property), F.col("key").cast(value_type))
    empty = F.create_map().cast(batch.schema["props"].dataType)
    clean = clean.withColumn("props", merge_keep_null(F.coalesce("props", empty), own))
    patch = _latest(clean, NODE_KEY)
    return stored.join(patch, NODE_KEY, "full_outer").select(
        *NODE_KEY, merge_props("props", "__patch").alias("props")
    )


def merge_keep_null(old: Column, new: Column) -> Column:
    """Right-biased merge that keeps NULL values, which still have to remove stored ones."""
    return F.map_zip_with(old, new, lambda k, a, b: F.when(F.map_contains_key(new, k), b).otherwise(a))


def labelled_batch(batch: DataFrame) -> DataFrame:
    """Adapter nodes ``(id, label, name, text, props, seq)`` as an upsert batch keyed by string id.

    With text it is a Chunk, with a name an entity of its own label, else a plain Node.
    """
    chunk, entity = F.col("text").isNotNull(), F.col("name").isNotNull()
    label = F.when(chunk, "Chunk").when(entity, F.coalesce("label", F.lit(DEFAULT_LABEL))).otherwise("Node")
    own = F.when(chunk, F.create_map(F.lit("text"), "text")).when(entity, F.create_map(F.lit("name"), "name"))
    empty = F.create_map().cast("map<string,string>")
    props = merge_keep_null(F.coalesce("props", empty), F.coalesce(own, empty))
    return batch.select(label.alias("label"), F.col("id").alias("key"), props.alias("props"), "seq")


def upsert_edges(stored: DataFrame, nodes: DataFrame, batch: DataFrame) -> DataFrame:
    """Create or update one edge per ``(source, type, target)``; nothing happens if an end is missing.

    Without ``src_label`` / ``dst_label`` in the batch an end is matched by key alone, in every
    label that has it. Stored parallel edges stay, and each takes the new properties.
    """
    ends = nodes.select(*NODE_KEY)
    for side in ("src", "dst"):
        end = ends.select(F.col("label").alias(f"{side}_label"), F.col("key").alias(f"{side}_key"))
        on = [c for c in (f"{side}_label", f"{side}_key") if c in batch.columns]
        batch = batch.join(end, on)
    return apply_edges(stored, _latest(batch, EDGE_KEY))


def apply_edges(stored: DataFrame, patch: DataFrame) -> DataFrame:
    """Stored edges with their patch, and the patches that met no edge.

    Two one-sided joins instead of a full outer one: AQE can split the stored side of the first
    if one pair of ends has very many parallel edges.
    """
    kept = stored.join(patch, EDGE_KEY, "left").select(*EDGE_KEY, merge_props("props", "__patch").alias("props"))
    new = patch.join(stored.select(*EDGE_KEY).distinct(), EDGE_KEY, "left_anti")
    return kept.unionByName(new.select(*EDGE_KEY, merge_props(F.lit(None).cast(stored.schema["props"].dataType), "__patch").alias("props")))


def document_nodes(documents: DataFrame) -> DataFrame:
    """All nodes of graph documents in writing order: document, then phase, then position."""
    rows = documents.select("doc", F.posexplode("nodes").alias("__pos", "__node"))
    return rows.select(
        "doc",
        F.coalesce("__node.type", F.lit(DEFAULT_LABEL)).alias("label"),
        F.col("__node.id").alias("key"),
        F.col("__node.properties").alias("props"),
        F.struct("doc", F.lit(0).alias("phase"), F.col("__pos").alias("pos")).alias("seq"),
    )


def document_edges(documents: DataFrame) -> DataFrame:
    rows = documents.select("doc", F.posexplode("relationships").alias("__pos", "__rel"))
    return rows.select(
        "doc",
        F.coalesce("__rel.source_type", F.lit(DEFAULT_LABEL)).alias("src_label"),
        F.col("__rel.source_id").alias("src_key"),
        F.col("__rel.type").alias("type"),
        F.coalesce("__rel.target_type", F.lit(DEFAULT_LABEL)).alias("dst_label"),
        F.col("__rel.target_id").alias("dst_key"),
        F.col("__rel.properties").alias("props"),
        F.struct("doc", F.lit(1).alias("phase"), F.col("__pos").alias("pos")).alias("seq"),
    )


def source_key() -> Column:
    """Id of a source document: its own one, else the hash of content and metadata."""
    return F.coalesce("source.id", document_hash(F.col("source.page_content"), F.col("source.metadata")))


def source_links(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Source nodes (a node batch keyed by id) and their ``MENTIONS`` edges (an edge batch).

    A document only mentions its own nodes.
    """
    sources = documents.filter(F.col("source").isNotNull())
    nodes = sources.select(
        F.lit(DOCUMENT_LABEL).alias("label"),
        source_key().alias("key"),
        F.create_map(F.lit("page_content"), F.coalesce("source.page_content", F.lit(""))).alias("props"),
        F.struct("doc", F.lit(2).alias("phase"), F.lit(0).alias("pos")).alias("seq"),
    )
    edges = sources.select(
        F.lit(DOCUMENT_LABEL).alias("src_label"),
        source_key().alias("src_key"),
        F.lit(MENTIONS).alias("type"),
        "doc",
        F.posexplode("nodes").alias("__pos", "__node"),
    )
    none = F.create_map().cast("map<string,string>")
    return nodes, edges.select(
        "src_label",
        "src_key",
        "type",
        F.coalesce("__node.type", F.lit(DEFAULT_LABEL)).alias("dst_label"),
        F.col("__node.id").alias("dst_key"),
        none.alias("props"),
        F.struct("doc", F.lit(2).alias("phase"), F.col("__pos").alias("pos")).alias("seq"),
    )


def add_graph_documents(
    stored_nodes: DataFrame, stored_edges: DataFrame, documents: DataFrame, include_source: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Write graph documents ``(doc, nodes, relationships, source)`` in order of ``doc``.

    Equal to writing the documents one after the other, nodes before edges before the source link:
    the last value of a property wins, and an edge needs both ends to exist by its own document,
    so an end that only a later document brings drops it.
    """
    node_batch = document_nodes(documents)
    nodes = upsert_nodes(stored_nodes, node_batch.drop("doc"), "name")
    first_seen = (
        node_batch.select(*NODE_KEY, "doc")
        .unionByName(stored_nodes.select(*NODE_KEY, F.lit(None).cast("long").alias("doc")))
        .groupBy(*NODE_KEY)
        .agg(F.min(F.coalesce("doc", F.lit(-(2**62)))).alias("__first"))
    )
    edge_batch = document_edges(documents)
    for side in ("src", "dst"):
        seen = first_seen.select(
            F.col("label").alias(f"{side}_label"), F.col("key").alias(f"{side}_key"), F.col("__first")
        )
        edge_batch = edge_batch.join(seen, [f"{side}_label", f"{side}_key"])
        edge_batch = edge_batch.filter(F.col("__first") <= F.col("doc")).drop("__first")
    edge_batch = edge_batch.drop("doc")
    if include_source:
        source_batch, mentions = source_links(documents)
        nodes = upsert_nodes(nodes, source_batch, "id")
        edge_batch = edge_batch.unionByName(mentions)
    return nodes, apply_edges(stored_edges, _latest(edge_batch, EDGE_KEY))
