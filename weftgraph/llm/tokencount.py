"""Token counts through a digest cache.

The cache is a table of counts by the digest of a text and the digest of what counted it. Texts are
digested where they lie, the distinct digests meet the stored ones, and only one row of each
digest that is not stored is read again, encoded, and appended to the cache. The counts of all rows are then
looked up there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.llm.store import numbered, store
from weftgraph.llm.words import buffers, cuts

CACHE = "digest binary, n_tokens long, version string"
#: Rows of missed texts that are looked up by a broadcast if they are also under this part of all rows. With an
#: empty cache most rows are missed at every size, so they are joined by a sort at every size.
FEW, FEW_SHARE = 200_000, 0.02


def tokenizer_version(vocabulary: str) -> str:
    """Digest of what determines a count: library, its version, options, and the vocabulary's bytes."""
    if vocabulary.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    found = hashlib.sha256(f"{library.__name__} {library.__version__} no added tokens\n".encode())
    with open(vocabulary, "rb") as file:
        found.update(file.read())
    return found.hexdigest()


def counter(vocabulary: str):
    """Function from texts to their numbers of tokens, without begin, end or other added tokens."""
    if vocabulary.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(vocabulary)
    model.no_padding()
    model.no_truncation()
    return lambda texts: [len(e.ids) for e in model.encode_batch(texts, add_special_tokens=False)]


def stored_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """``digest, n_tokens`` of one version, each digest once; nothing where no cache is yet.

    Only the folder of the version is read. Two jobs that ran at once may both have appended a text.
    """
    try:
        kept = spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "digest binary, n_tokens long")
    return kept.filter(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _encode(vocabulary: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary)
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for at, to in cuts(offsets):
                raw = data[offsets[at] : offsets[to]].tobytes()
                inner = offsets[at : to + 1] - offsets[at]
                counts = count([raw[b:e].decode() for b, e in zip(inner[:-1], inner[1:])])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, to - at), pa.array(counts, pa.int64())], names=["digest", "n_tokens"]
                )

    return task


def count_tokens(
    docs: DataFrame, vocabulary: str, cache: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: ``row, doc_id, n_bytes, n_tokens``, counted as the vocabulary's library does.

    ``cache`` is a folder that all executors reach; what is missing there is appended to it, under the
    version of the tokenizer. Two texts share a count if they are equal after the one normalisation, a null text is
    the empty text: white space, case and code points all matter to a tokenizer. Ids may be null or repeat; other
    columns are left behind; a table without rows gives none and appends nothing. Texts are read whole.

    A text that many rows hold is digested in each of their tasks and encoded once. Texts move only if they
    are missed, each once; digests move as 32 bytes.
    """
    spark = docs.sparkSession
    version = tokenizer_version(vocabulary)
    docs, row = numbered(docs)
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.sha2(text.cast("binary"), 256))
    seen = store(
        docs.select(
            F.col(row).alias("row"), F.col(id_col).cast("long").alias("doc_id"), digest.alias("digest"),
            F.octet_length(text).cast("long").alias("n_bytes"),
        ),
        "digests",
    )
    first = seen.groupBy("digest").agg(F.min("row").alias("row"))
    missed = store(first.join(stored_counts(spark, cache, version), "digest", "left_anti"), "missed")
    n = missed.count()
    if n:
        few = n <= min(FEW, FEW_SHARE * seen.count())
        wanted = F.broadcast(missed) if few else missed.hint("merge")
        texts = docs.select(F.col(row).alias("row"), text.alias("text")).join(wanted, "row").select("digest", "text")
        counted = texts.mapInArrow(_encode(vocabulary), "digest binary, n_tokens long")
        counted.withColumn("version", F.lit(version)).write.mode("append").partitionBy("version").parquet(cache)
    # One row per distinct text, so a text that many rows hold is one key of a plain join, which can be split.
    known = store(first.select("digest").join(stored_counts(spark, cache, version), "digest"), "known-counts")
    return seen.join(known, "digest").select("row", "doc_id", "n_bytes", "n_tokens")
