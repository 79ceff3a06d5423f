"""Upserts, deletes, restructuring, schema and the fact stream."""

from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from weftgraph.functions.props import document_hash, merge_props, type_name
from weftgraph.operators import delete, restructure, schema, upsert
from weftgraph.streaming import facts

NODE = "label string, key string, props map<string,string>"
BATCH = NODE + ", seq long"
EDGE = "src_label string, src_key string, type string, dst_label string, dst_key string, props map<string,string>"
RELATION = (
    "struct<source_id:string,source_type:string,target_id:string,target_type:string,type:string,properties:map<string,string>>"
)
DOCUMENT = (
    "doc long, nodes array<struct<id:string,type:string,properties:map<string,string>>>, "
    f"relationships array<{RELATION}>, source struct<id:string,page_content:string,metadata:map<string,string>>"
)


def nodes_of(df):
    return {(r.label, r.key): r.props for r in df.collect()}


def edges_of(df):
    return sorted((r.src_key, r.type, r.dst_key, tuple(sorted(r.props.items()))) for r in df.collect())


def test_node_upsert_rules(spark):
    stored = spark.createDataFrame([("City", "Rome", {"name": "Rome", "size": "big", "old": "yes"})], NODE)
    batch = spark.createDataFrame(
        [
            ("City", "Rome", {"size": "huge", "name": "Roma"}, 1),
            ("City", "Rome", {"size": "vast", "old": None}, 2),
            (None, "Tiber", {}, 3),
            ("River", "Po", None, 4),
        ],
        BATCH,
    )
    once = upsert.upsert_nodes(stored, batch)
    assert nodes_of(once) == {
        ("City", "Rome"): {"name": "Rome", "size": "vast"},
        ("Entity", "Tiber"): {"name": "Tiber"},
        ("River", "Po"): {"name": "Po"},
    }
    assert nodes_of(upsert.upsert_nodes(once, batch)) == nodes_of(once)


def test_hot_key_is_one_node(spark):
    batch = spark.range(5000).select(
        F.lit("L").alias("label"), F.lit("same").alias("key"), F.create_map(F.lit("n"), F.col("id").cast("string")).alias("props"), F.col("id").alias("seq")
    )
    assert nodes_of(upsert.upsert_nodes(spark.createDataFrame([], NODE), batch)) == {("L", "same"): {"n": "4999", "name": "same"}}


def test_edge_upsert_rules(spark):
    nodes = spark.createDataFrame([("A", "x", {}), ("B", "x", {}), ("A", "y", {})], NODE)
    stored = spark.createDataFrame(
        [("A", "x", "T", "A", "y", {"n": "1"}), ("A", "x", "T", "A", "y", {"n": "2"})], EDGE
    )
    batch = spark.createDataFrame(
        [("x", "T", "y", {"w": "5"}, 1), ("x", "T", "gone", {}, 2), ("y", "U", "y", {}, 3)],
        "src_key string, type string, dst_key string, props map<string,string>, seq long",
    )
    once = upsert.upsert_edges(stored, nodes, batch)
    # Both parallel edges take w; the second label with key x gets an edge too; a missing end gives none.
    assert edges_of(once) == [
        ("x", "T", "y", (("n", "1"), ("w", "5"))),
        ("x", "T", "y", (("n", "2"), ("w", "5"))),
        ("x", "T", "y", (("w", "5"),)),
        ("y", "U", "y", ()),
    ]
    assert edges_of(upsert.upsert_edges(once, nodes, batch)) == edges_of(once)


def relation(source, kind, target, **props):
    return (source, "P", target, "P", kind, props)


@pytest.fixture(scope="module")
def documents(spark):
    rows = [
        (0, [("ann", "P", {"born": "1900"}), ("ann", "P", {"born": "1901"})], [relation("ann", "KNOWS", "cid"), relation("ann", "KNOWS", "bob")],
         (None, "first text", {"b": "2", "a": "1"})),
        (1, [("cid", "P", {"name": "other"}), ("thing", None, {})], [relation("cid", "KNOWS", "ann", since="9")], ("s1", "second", {})),
        (2, [("ann", "P", {"died": "1980"})], [relation("ann", "KNOWS", "cid", since="1"), relation("ann", "KNOWS", "cid", since="2")], None),
    ]
    return spark.createDataFrame(rows, DOCUMENT)


def test_graph_documents_in_order(spark, documents):
    nodes = spark.createDataFrame([("P", "bob", {"name": "bob"})], NODE)
    edges = spark.createDataFrame([], EDGE)
    got_nodes, got_edges = upsert.add_graph_documents(nodes, edges, documents)
    assert nodes_of(got_nodes) == {
        ("P", "ann"): {"name": "ann", "born": "1901", "died": "1980"},
        ("P", "bob"): {"name": "bob"},
        ("P", "cid"): {"name": "cid"},
        ("Entity", "thing"): {"name": "thing"},
    }
    assert edges_of(got_edges) == [
        ("ann", "KNOWS", "bob", ()),
        ("ann", "KNOWS", "cid", (("since", "2"),)),
        ("cid", "KNOWS", "ann", (("since", "9"),)),
    ]


def test_late_end_drops_the_edge(spark, documents):
    """Without the third document the only ann -> cid edge came before cid existed."""
    _, edges = upsert.add_graph_documents(
        spark.createDataFrame([], NODE), spark.createDataFrame([], EDGE), documents.filter("doc < 2")
    )
    assert edges_of(edges) == [("cid", "KNOWS", "ann", (("since", "9"),))]


def test_sources_and_repeats(spark, documents):
    nodes, edges = spark.createDataFrame([], NODE), spark.createDataFrame([], EDGE)
    first = upsert.add_graph_documents(nodes, edges, documents, include_source=True)
    again = upsert.add_graph_documents(*first, documents, include_source=True)
    assert nodes_of(again[0]) == nodes_of(first[0])
    body = json.dumps({"content": "first text", "metadata": {"a": "1", "b": "2"}}, separators=(",", ":"))
    key = hashlib.sha256(body.encode()).hexdigest()[:32]
    assert nodes_of(first[0])[("__Document__", key)] == {"id": key, "page_content": "first text"}
    mentions = [(s, d) for s, t, d, _ in edges_of(first[1]) if t == "MENTIONS"]
    assert sorted(mentions) == sorted([(key, "ann"), ("s1", "cid"), ("s1", "thing")])
    # The second run meets ends that exist by now; the one-edge rule still holds.
    assert len([e for e in edges_of(again[1]) if e[1] == "KNOWS"]) == 2


def test_adapter_labels(spark):
    rows = [("1", "X", None, "words", {"id": "9"}, 1), ("2", "City", "Rome", None, None, 2), ("3", None, "Rome", None, {}, 3), ("4", "X", None, None, {"a": "b"}, 4)]
    batch = upsert.labelled_batch(spark.createDataFrame(rows, "id string, label string, name string, text string, props map<string,string>, seq long"))
    assert nodes_of(upsert.upsert_nodes(spark.createDataFrame([], NODE), batch, "id")) == {
        ("Chunk", "1"): {"id": "1", "text": "words"},
        ("City", "2"): {"id": "2", "name": "Rome"},
        ("Entity", "3"): {"id": "3", "name": "Rome"},
        ("Node", "4"): {"id": "4", "a": "b"},
    }


def test_document_hash_survives_an_explode(spark):
    """Struct aliases must not be lost next to a generator."""
    data = spark.createDataFrame([("a \"quoted\"\nline é", [1, 2])], "t string, xs array<int>")
    plain = data.select(document_hash("t").alias("h")).first().h
    assert data.select(document_hash("t").alias("h"), F.explode("xs")).first().h == plain
    body = json.dumps({"content": "a \"quoted\"\nline é", "metadata": {}}, separators=(",", ":"), ensure_ascii=False)
    assert plain == hashlib.sha256(body.encode()).hexdigest()[:32]


def test_merge_props(spark):
    data = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": None, "c": "3"}), ({"a": "1"}, None), (None, {"z": "1"})], "o map<string,string>, n map<string,string>")
    assert [r.m for r in data.select(merge_props("o", "n").alias("m")).collect()] == [{"a": "1", "c": "3"}, {"a": "1"}, {"z": "1"}]


@pytest.fixture(scope="module")
def shop(spark):
    nodes = spark.createDataFrame([(1, "a", "n1", "s"), (2, "b", "n2", "s"), (3, "c", "n2", "t")], "id long, key string, name string, session string")
    edges = spark.createDataFrame([(1, "T", 2), (2, "T", 3), (3, "T", 1), (3, "T", 3)], "src long, type string, dst long")
    return nodes, edges


def test_delete(shop):
    def left(result):
        return sorted(r.id for r in result[0].collect()), sorted((r.src, r.dst) for r in result[1].collect())

    assert left(delete.delete(*shop, ids=["a"], entity_names=["n2"])) == ([2, 3], [(2, 3), (3, 3)])
    assert left(delete.delete(*shop, entity_names=["n2"])) == ([1], [])
    assert left(delete.delete(*shop)) == ([1, 2, 3], [(1, 2), (2, 3), (3, 1), (3, 3)])
    assert left(delete.purge(*shop, {"session": "s"})) == ([3], [(3, 3)])
    with pytest.raises(NotImplementedError):
        delete.delete(*shop, relation_names=["T"])
    with pytest.raises(NotImplementedError):
        delete.delete(*shop, properties={"a": 1})


def test_blocked_delete(spark, shop):
    asked = spark.createDataFrame([(3,), (8,)], "id long")
    assert [tuple(r) for r in delete.blocked_deletes(shop[1], asked).collect()] == [(3, 4)]


def test_detach_and_attach(spark):
    nodes = spark.createDataFrame([(1, ("x", 1)), (2, None), (3, ("z", 3))], "id long, body struct<t:string,n:int>")
    rest, made, links = restructure.detach_document(nodes, "body", 10)
    assert rest.columns == ["id"]
    assert sorted(tuple(r) for r in made.collect()) == [(10, "x", 1), (11, "z", 3)]
    assert sorted(tuple(r) for r in links.collect()) == [(1, "HAS_BODY", 10), (3, "HAS_BODY", 11)]
    back, left, edges = restructure.attach_document(rest, made, links, "body")
    assert sorted(back.collect()) == sorted(nodes.collect())
    assert left.count() == 0 and edges.count() == 0


def test_property_types(spark):
    data = spark.createDataFrame([], "i int, f double, s string, b boolean, x binary, t timestamp, v array<float>, l array<string>, flags array<boolean>, m map<string,int>, g struct<lat:double,lon:double>")
    kinds = [type_name(f.dataType) for f in data.schema.fields]
    assert kinds == ["INT64", "FLOAT64", "STRING", "BOOL", "BYTES", "TIMESTAMP", "VECTOR", "LIST", "LIST", "MAP", "MAP"]


def test_variant_types(spark):
    data = spark.createDataFrame(
        [("L", '{"i": 42, "f": 1.5, "s": "hello", "b": true, "flags": [true, false], "vec": [1, 2], "m": {"x": 1}, "none": null}')],
        "label string, j string",
    ).select("label", F.parse_json("j").cast("map<string,variant>").alias("props"))
    found = {r.property: r.type for r in schema.map_properties(data).collect()}
    assert found == {"i": "INT64", "f": "FLOAT64", "s": "STRING", "b": "BOOL", "flags": "LIST", "vec": "VECTOR", "m": "MAP"}


@pytest.mark.parametrize(
    "properties",
    ["name", [3], [{}], [{"name": ""}], [{"name": "a", "type": 5}], [{"name": "a", "type": "number"}], [{"name": "a", "required": "yes"}], [{"name": "a", "unique": 1}]],
)
def test_bad_declarations(spark, properties):
    with pytest.raises(ValueError):
        schema.declare(spark, "L", properties)


def test_declarations_and_modes(spark):
    rows = schema.declare(spark, "L", ({"name": "a"}, {"name": "b", "type": " Int64 ", "required": True})).collect()
    assert [tuple(r) for r in rows] == [("L", "a", "STRING", False, False), ("L", "b", "INT64", True, False)]
    assert schema.declare(spark, "L").count() == 0
    assert [schema.schema_mode(m) for m in (" Strict ", "validated", 3)] == [1, 2, 3]
    for bad in (True, 9, "loose", None):
        with pytest.raises(ValueError):
            schema.schema_mode(bad)


def test_schema_text_lists_only_what_exists(spark):
    used = spark.createDataFrame([(1, "x", 3)], "id long, name string, age int")
    bare = spark.createDataFrame([(1, 2)], "src long, dst long")
    labels = schema.table_properties({"Person": used, "Ghost": used.filter("false"), "Tag": used.select("id")})
    edges = schema.table_properties({"KNOWS": bare})
    assert schema.schema_text(labels, edges).first().schema == (
        "Node labels:\n  - Person (properties: age: INT64, name: STRING)\n  - Tag\n\nEdge types:\n  - KNOWS"
    )


FACTS = [("s", "Ann", "works at", "Acme"), ("s", "Ann", "WORKS_AT", "Acme"), ("s", "Ann", "9th", "Acme"), ("t", "Ann", "knows-of", "Bob"), ("t", "Ann", None, "Bob")]


def test_facts_batch(spark):
    batch = spark.createDataFrame(FACTS, facts.FACT_SCHEMA)
    empty = spark.createDataFrame([], facts.FACT_SCHEMA)
    new = facts.save_facts(empty, batch)
    assert [tuple(r) for r in new.collect()] == [("s", "Ann", "WORKS_AT", "Acme")]
    assert facts.save_facts(new, batch).count() == 0
    assert facts.split_facts(batch)[1].count() == 3
    assert sorted(r.name for r in facts.fact_nodes(new).collect()) == ["Acme", "Ann"]


def test_fact_stream_over_several_batches(spark, tmp_path):
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    for part in (FACTS, FACTS[:2] + [("s", "Bob", "likes", "Ann")]):
        spark.createDataFrame(part, facts.FACT_SCHEMA).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(facts.FACT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    for _ in range(2):
        facts.ingest_facts(stream, store, str(tmp_path / "progress")).awaitTermination()
    found = sorted(tuple(r) for r in facts.read_facts(spark, store).collect())
    assert found == [("s", "Ann", "WORKS_AT", "Acme"), ("s", "Bob", "LIKES", "Ann")]
    nodes = sorted((r.session, r.name) for r in facts.read_fact_nodes(spark, store).collect())
    assert nodes == [("s", "Acme"), ("s", "Ann"), ("s", "Bob")]
    assert spark.read.parquet(f"{store}/rejects").count() == 3


def test_fact_stream_goes_on_from_its_state(spark, tmp_path):
    """A second start with more input adds only what is new, and no batch reads what was stored."""
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    first = [("s", "Ann", "knows", "Bob"), ("s", "Ann", "knows", None), (None, "x", "is", "y")]
    spark.createDataFrame(first, facts.FACT_SCHEMA).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(facts.FACT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    facts.ingest_facts(stream, store, str(tmp_path / "progress")).awaitTermination()
    earlier = {r[0] for r in spark.read.parquet(f"{store}/rows").selectExpr("input_file_name()").collect()}
    spark.createDataFrame([*first, ("s", "Bob", "knows", "Ann"), ("t", "Ann", "knows", "Bob")], facts.FACT_SCHEMA).coalesce(1).write.mode("append").parquet(source)
    query = facts.ingest_facts(stream, store, str(tmp_path / "progress"))
    query.awaitTermination()
    found = facts.read_facts(spark, store).collect()
    assert len(found) == len(set(found)) == 5
    assert facts.read_fact_nodes(spark, store).count() == 7  # s: Ann, Bob, null; null: x, y; t: Ann, Bob
    plan = query._jsq.explainInternal(False)
    assert "StreamingDeduplicate" in plan and f"{store}/rows" not in plan
    assert earlier <= {r[0] for r in spark.read.parquet(f"{store}/rows").selectExpr("input_file_name()").collect()}


def test_registry_flags_modes_and_declared_properties(spark):
    registry = schema.register(spark, "A", [{"name": "x", "required": True}, {"name": "y", "unique": True}], "validated", 3)
    registry = registry.unionByName(schema.register(spark, "B", mode="flexible"))
    assert schema.modes_of(registry) == {"A": 2, "B": 3}
    assert schema.flagged(registry, "A", "required") == ["x"] and schema.flagged(registry, "A", "unique") == ["y"]
    assert schema.flagged(registry, "B", "required") == []
    inferred = spark.createDataFrame([("A", "x", "STRING", 4, 5), ("C", "z", "INT64", 1, 1)], "name string, property string, type string, present long, total long")
    rows = {(r.name, r.property): (r.version, r.mode, r.type, r.declared, r.present) for r in schema.with_registry(inferred, registry).collect()}
    assert rows == {
        ("A", "x"): (3, 2, "STRING", "STRING", 4), ("A", "y"): (3, 2, None, "STRING", 0), ("C", "z"): (None, 0, "INT64", None, 1),
    }
    table = spark.createDataFrame([(1, None)], "id long, x string")
    assert schema.required_violations(table, []).count() == 0 and schema.unique_violations(table, []).count() == 0
    with pytest.raises(ValueError):
        schema.register(spark, "A", version=0)
