"""Facts ``(session, subject, relation, object)``: batch and stream ingest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weftgraph.plans.sizing import absent_from

#: What a relation name must look like once it is upper-cased.
RELATION = r"^[A-Z_][A-Z0-9_]*$"
FACT_KEY = ["session", "subject", "relation", "object"]
FACT_SCHEMA = "session string, subject string, relation string, object string"
ENTITY = "Entity"
NODE_KEY = ["session", "name"]


def relation_name(relation: Column | str) -> Column:
    """Upper case, spaces to underscores."""
    relation = F.col(relation) if isinstance(relation, str) else relation
    return F.replace(F.upper(relation), F.lit(" "), F.lit("_"))


def split_facts(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid facts with their relation name, rejected rows as they came)."""
    named = batch.withColumn("__name", relation_name("relation"))
    valid = F.coalesce(F.col("__name").rlike(RELATION), F.lit(False))
    good = named.filter(valid).withColumn("relation", F.col("__name")).select(*FACT_KEY)
    return good, named.filter(~valid).drop("__name")


def save_facts(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """New facts only: each ``(subject, relation, object)`` is kept once per session."""
    return absent_from(split_facts(batch)[0].distinct(), stored, FACT_KEY)


def fact_nodes(facts: DataFrame) -> DataFrame:
    """The entities of the facts, one per session and name."""
    ends = facts.select("session", F.col("subject").alias("name")).unionByName(
        facts.select("session", F.col("object").alias("name"))
    )
    return ends.distinct().withColumn("label", F.lit(ENTITY))


def save_fact_nodes(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Entities of the valid facts that ``stored`` does not have yet, one per session and name."""
    return absent_from(fact_nodes(split_facts(batch)[0]), stored, NODE_KEY)


#: Rows of a store: facts, entities (``a`` is the name) and rejected rows, told apart by ``kind``.
ROW_SCHEMA = "session string, a string, b string, c string"
FACT, NODE, REJECT = "fact", "node", "reject"


def _rows(spark: SparkSession, store: str, kind: str) -> DataFrame:
    """Rows of one kind; only its folders are read."""
    return spark.read.schema(f"{ROW_SCHEMA}, batch long, kind string").parquet(f"{store}/rows").filter(F.col("kind") == kind)


def read_facts(spark: SparkSession, store: str) -> DataFrame:
    """All facts of a store written by :func:`ingest_facts`."""
    return _rows(spark, store, FACT).select("session", *[F.col(c).alias(k) for c, k in zip("abc", FACT_KEY[1:])])


def read_fact_nodes(spark: SparkSession, store: str) -> DataFrame:
    """All entities of a store written by :func:`ingest_facts`."""
    return _rows(spark, store, NODE).select("session", F.col("a").alias("name"), F.lit(ENTITY).alias("label"))


def new_rows(stream: DataFrame) -> DataFrame:
    """Facts and entities of a stream that it has not given before, and its rejected rows: ``kind, session, a, b, c``.

    What was given is keyed state of the query, one key per fact and entity, partitioned like a shuffle and kept with
    the query's progress. A null in a key is a value like any other.
    """
    good, bad = split_facts(stream)
    none = F.lit(None).cast("string")

    def row(kind: str, a: Column | str, b: Column | str = none, c: Column | str = none) -> Column:
        parts = {"kind": F.lit(kind), "session": F.col("session"), "a": a, "b": b, "c": c}
        return F.struct(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in parts.items()])

    made = F.array(row(FACT, "subject", "relation", "object"), row(NODE, "subject"), row(NODE, "object"))
    fresh = good.select(F.explode(made).alias("r")).select("r.*").dropDuplicates(["kind", "session", "a", "b", "c"])
    return fresh.unionByName(bad.select(row(REJECT, "subject", "relation", "object").alias("r")).select("r.*"))


def ingest_facts(stream: DataFrame, store: str, checkpoint: str) -> StreamingQuery:
    """Put the new facts of a stream and their entities into ``store`` and stop when the input is used up.

    A micro-batch writes its own folders and reads nothing of what was stored before. One that is run again after a
    failure starts from the state before it and writes the same rows; a stream that is started again with
    its ``checkpoint`` goes on from its state. Rows with a bad relation go to ``rejects``.
    """

    def write(batch: DataFrame, number: int) -> None:
        folder = f"{store}/rows/batch={number}"
        batch.write.mode("overwrite").partitionBy("kind").parquet(folder)
        written = batch.sparkSession.read.schema(f"{ROW_SCHEMA}, kind string").parquet(folder)
        bad = written.filter(F.col("kind") == REJECT).select("session", *[F.col(c).alias(k) for c, k in zip("abc", FACT_KEY[1:])])
        bad.write.mode("overwrite").parquet(f"{store}/rejects/batch={number}")

    return (
        new_rows(stream).writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
