"""A corpus from raw documents: quality rules, exact and near duplicates, mixing, tokens.

Each stage reads what the one before wrote, works on all of it, and hands on every column of
``documents``; the last adds the token ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weftgraph.llm.bpe import encode
from weftgraph.llm.compression import keep_good
from weftgraph.llm.exact import drop_exact_copies
from weftgraph.llm.minhash import drop_near_copies
from weftgraph.llm.mixing import mix_documents
from weftgraph.llm.queries import tokenizer_file
from weftgraph.llm.store import store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the word rules or the compression bands reject go."""
    return keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that five-word shingles link at 75% or more, the smallest id stays."""
    return drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources reach their target weights; a document taken twice comes twice."""
    return mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ``ids``, the byte-level BPE tokens of each text as packed 32-bit integers."""
    return encode(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("tokens", tokens),
]

#: Compression ratios and merges are not SQL; tests/llm holds the pipeline against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
