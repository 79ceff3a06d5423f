"""Schema: what is in the graph, what was declared, and where the two differ."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.functions.props import TYPE_NAMES, type_name, variant_type_name
from weftgraph.plans.ordering import check_limit
from weftgraph.plans.sizing import broadcast_if_small

# Schema modes and their codes.
MODES = {"strict": 1, "validated": 2, "flexible": 3}

#: Columns of the model itself, never reported as properties: of node and of edge tables.
NODE_COLUMNS = frozenset({"id", "labels"})
EDGE_COLUMNS = frozenset({"edge_id", "src", "dst", "type"})

#: Mode of a label or edge type that nobody declared.
UNDECLARED = 0

PROPERTY = "property string, type string, required boolean, unique boolean"
DECLARED = f"label string, {PROPERTY}"
REGISTERED = f"label string, version int, mode int, {PROPERTY}"


def schema_mode(mode: str | int) -> int:
    """Code of a mode given by name (any case) or by code."""
    if isinstance(mode, bool) or not isinstance(mode, (str, int)):
        raise ValueError(f"schema mode must be a name or a code, got {mode!r}")
    if isinstance(mode, int):
        code = mode if mode in MODES.values() else None
    else:
        code = MODES.get(mode.strip().lower())
    if code is None:
        raise ValueError(f"schema mode must be one of {MODES}, got {mode!r}")
    return code


def _entries(properties: Sequence[Mapping[str, Any]] | None) -> list[tuple]:
    """``property, type, required, unique`` of each declared property; the type defaults to string."""
    if properties is not None and not isinstance(properties, (list, tuple)):
        raise ValueError(f"properties must be a list or tuple, got {type(properties).__name__}")
    rows = []
    for place, entry in enumerate(properties or ()):
        if not isinstance(entry, Mapping):
            raise ValueError(f"property {place} must be a mapping, got {entry!r}")
        name, kind = entry.get("name"), entry.get("type", "string")
        flags = [entry.get("required", False), entry.get("unique", False)]
        if not isinstance(name, str) or not name:
            raise ValueError(f"property {place} needs a name, got {entry!r}")
        if not isinstance(kind, str) or kind.strip().upper() not in TYPE_NAMES:
            raise ValueError(f"property {name!r} has unknown type {kind!r}")
        if not all(isinstance(flag, bool) for flag in flags):
            raise ValueError(f"property {name!r}: required and unique must be booleans")
        rows.append((name, kind.strip().upper(), *flags))
    return rows


def declare(spark: SparkSession, label: str, properties: Sequence[Mapping[str, Any]] | None = None) -> DataFrame:
    """Declared properties of a label or edge type as rows."""
    return spark.createDataFrame([(label, *entry) for entry in _entries(properties)], DECLARED)


def register(
    spark: SparkSession,
    label: str,
    properties: Sequence[Mapping[str, Any]] | None = None,
    mode: str | int = "strict",
    version: int = 1,
) -> DataFrame:
    """Registry rows of a label or edge type: ``label, version, mode`` and its declared properties.

    Without properties it is one row with a NULL property. Registries of several labels are unions.
    """
    head = (label, check_limit(version, "version"), schema_mode(mode))
    entries = _entries(properties) or [(None, None, None, None)]
    return spark.createDataFrame([(*head, *entry) for entry in entries], REGISTERED)


def modes_of(registry: DataFrame) -> dict[str, int]:
    """Mode code of every registered label; as small as the schema."""
    return {r["label"]: r["mode"] for r in registry.select("label", "mode").distinct().collect()}


def flagged(registry: DataFrame, label: str, flag: str) -> list[str]:
    """Properties of ``label`` declared with ``flag`` (``required`` or ``unique``)."""
    rows = registry.filter((F.col("label") == label) & F.col(flag)).select("property").distinct().collect()
    return sorted(r["property"] for r in rows)


def with_registry(inferred: DataFrame, registry: DataFrame) -> DataFrame:
    """Inferred properties with what was declared for them.

    Adds ``version, mode`` of the label (NULL and 0 if nobody declared it), and ``declared, required,
    unique`` of the property. A declared property or label that no row has comes with a NULL ``type``
    and 0 present.
    """
    heads = broadcast_if_small(registry.select(F.col("label").alias("name"), "version", "mode").distinct())
    entries = registry.filter("property IS NOT NULL").select(
        F.col("label").alias("name"), "property", F.col("type").alias("declared"), "required", "unique"
    )
    # Both sides hold one row per property: a full join of two tables as small as the schema.
    known = inferred.filter("property IS NOT NULL").select("name", "property", "type", "present")
    both = known.join(entries, ["name", "property"], "full_outer").join(heads, "name", "left")
    return both.select(
        "name", "version", F.coalesce("mode", F.lit(UNDECLARED)).alias("mode"), "property", "type", "declared",
        F.coalesce("required", F.lit(False)).alias("required"), F.coalesce("unique", F.lit(False)).alias("unique"),
        F.coalesce("present", F.lit(0)).alias("present"),
    )


def table_properties(tables: Mapping[str, DataFrame], structural: Collection[str] | None = None) -> DataFrame:
    """``name, property, type, present, total`` of typed tables, one pass per table.

    The model's own columns are left out: those of edges for a table with both ends, else those of
    nodes, so a node's ``type`` or ``src`` is a property like any other. ``structural`` names others.
    Every column is counted in the same map-side aggregate. Tables without rows are left out; a
    table without properties gives one row with a NULL property.
    """
    parts = []
    for name, table in tables.items():
        own = structural
        if own is None:
            own = EDGE_COLUMNS if {"src", "dst"} <= set(table.columns) and "id" not in table.columns else NODE_COLUMNS
        columns = [f for f in table.schema.fields if f.name not in own]
        counted = table.agg(
            F.count("*").alias("total"), *[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(columns)]
        )
        entries = [
            F.struct(
                F.lit(f.name).alias("property"), F.lit(type_name(f.dataType)).alias("type"), F.col(f"c{i}").alias("present")
            )
            for i, f in enumerate(columns)
        ]
        none = F.struct(
            F.lit(None).cast("string").alias("property"), F.lit(None).cast("string").alias("type"), F.lit(0).cast("long").alias("present")
        )
        parts.append(counted.select(F.lit(name).alias("name"), "total", F.inline(F.array(*(entries or [none])))))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.filter("total > 0").select("name", "property", "type", "present", "total")


def map_properties(rows: DataFrame, name: str = "label", props: str = "props") -> DataFrame:
    """``name, property, type, present`` of schema-free rows with a ``MAP<STRING, VARIANT>``."""
    split = rows.select(F.col(name).alias("name"), F.explode(props).alias("property", "__value"))
    typed = split.withColumn("type", variant_type_name(F.col("__value"))).filter(F.col("type").isNotNull())
    return typed.groupBy("name", "property", "type").agg(F.count("*").alias("present"))


def schema_text(labels: DataFrame, edge_types: DataFrame) -> DataFrame:
    """One row ``schema``: the bullet list of labels and edge types with their properties.

    The input has one row per property, so what is gathered here is as small as the schema.
    """

    def section(rows: DataFrame, column: str) -> DataFrame:
        shown = F.when(F.col("property").isNotNull(), F.struct("property", F.concat_ws(": ", "property", "type").alias("t")))
        bullets = rows.groupBy("name").agg(F.array_sort(F.collect_list(shown)).alias("__p"))
        listed = F.array_join(F.transform("__p", lambda p: p["t"]), ", ")
        line = F.concat(F.lit("  - "), "name", F.when(F.size("__p") > 0, F.concat(F.lit(" (properties: "), listed, F.lit(")"))).otherwise(""))
        ordered = F.array_sort(F.collect_list(F.struct("name", line.alias("line"))))
        return bullets.agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias(column))

    nodes, edges = section(labels, "nodes"), section(edge_types, "edges")
    heads = labels.sparkSession.range(1).select(
        F.concat(
            F.lit("Node labels:\n"), nodes.scalar(), F.lit("\n\nEdge types:\n"), edges.scalar()
        ).alias("schema")
    )
    return heads


def structured_schema(labels: DataFrame, edge_types: DataFrame, triples: DataFrame) -> DataFrame:
    """``section, name, detail, kind``: node_props, rel_props and relationships in one table."""

    def props(rows: DataFrame, section: str) -> DataFrame:
        return rows.select(
            F.lit(section).alias("section"), "name", F.col("property").alias("detail"), F.col("type").alias("kind")
        )

    links = triples.select(
        F.lit("relationships").alias("section"), F.col("start").alias("name"), F.col("type").alias("detail"), F.col("end").alias("kind")
    )
    return props(labels, "node_props").unionByName(props(edge_types, "rel_props")).unionByName(links)


def mode_violations(rows: DataFrame, declared: DataFrame, modes: Mapping[str, str | int]) -> DataFrame:
    """Undeclared properties on labels in strict mode: ``label, id, property``.

    ``rows`` is ``(label, id, props)``; ``validated`` and ``flexible`` labels may carry extra ones.
    """
    strict = [label for label, mode in modes.items() if schema_mode(mode) == MODES["strict"]]
    names = rows.filter(F.col("label").isin(strict)).select("label", "id", F.explode(F.map_keys("props")).alias("property"))
    return names.join(broadcast_if_small(declared.select("label", "property")), ["label", "property"], "left_anti")


def type_violations(rows: DataFrame, declared: DataFrame, modes: Mapping[str, str | int]) -> DataFrame:
    """Declared properties whose VARIANT value has another type: ``label, id, property, found, type``.

    Not checked on labels in flexible mode; NULL values have no type.
    """
    checked = [label for label, mode in modes.items() if schema_mode(mode) != MODES["flexible"]]
    split = rows.filter(F.col("label").isin(checked)).select("label", "id", F.explode("props").alias("property", "__value"))
    typed = split.withColumn("found", variant_type_name(F.col("__value"))).drop("__value")
    joined = typed.join(broadcast_if_small(declared.select("label", "property", "type")), ["label", "property"])
    return joined.filter(F.col("found").isNotNull() & (F.col("found") != F.col("type")))


def required_violations(table: DataFrame, required: Sequence[str]) -> DataFrame:
    """``id, property`` of every missing required value."""
    if not required:
        return table.select("id", F.lit("").alias("property")).filter(F.lit(False))
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    return table.select("id", F.explode(missing).alias("property"))


def unique_violations(table: DataFrame, unique: Sequence[str]) -> DataFrame:
    """``property, value, count`` of every value that occurs more than once (as text)."""
    parts = [
        table.filter(F.col(c).isNotNull())
        .groupBy(F.lit(c).alias("property"), F.col(c).cast("string").alias("value"))
        .agg(F.count("*").alias("count"))
        .filter("count > 1")
        for c in unique
    ]
    if not parts:
        return table.sparkSession.createDataFrame([], "property string, value string, count long")
    return reduce(DataFrame.unionByName, parts)


def dimension_violations(vectors: DataFrame, dimension: int, column: str = "embedding") -> DataFrame:
    """``id, found`` of vectors that do not have ``dimension`` numbers."""
    rows = vectors.filter(F.col(column).isNotNull()).select("id", F.size(column).alias("found"))
    return rows.filter(F.col("found") != dimension)
