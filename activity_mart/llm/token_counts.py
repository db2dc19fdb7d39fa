"""Operator 9: token counts from a cache of content digests.

A count is stored under the digest of the normalised content and the digest of the tokenizer
(its file and the library's version). Documents are joined to the stored counts; only distinct
contents that are absent are encoded, and their counts are appended.
"""

from __future__ import annotations

import functools
import hashlib
import importlib.metadata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_mart.llm.common import new_path, table, text_chunks, text_of
from activity_mart.llm.units import tokenizer_path, unit_encoder

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
CACHE_SCHEMA = "content string, version string, n_tokens long"


@functools.lru_cache(maxsize=2)
def _pieces(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def tokenizer_version(name: str) -> str:
    """Digest of the tokenizer's file and its library's version."""
    path = tokenizer_path(name)
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + f"{library} {importlib.metadata.version(library)}".encode()).hexdigest()


def _counts(texts: list[str], path: str) -> list[int]:
    if path.endswith(".model"):
        return [len(ids) for ids in _pieces(path).encode(texts, num_threads=1)]
    return [len(ids) // 4 for ids in unit_encoder(path).encode(texts)]


def stored_counts(spark: SparkSession, cache: str) -> DataFrame:
    """The cache's counts, one for each content and version; empty if there is no cache yet."""
    try:
        rows = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)
    # Two runs may have appended the same content; their counts are equal.
    return rows.groupBy("content", "version").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame, cache: str, tokenizer: str = TOKENIZER, limit: int = TOKEN_LIMIT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every document; appends to ``cache``.

    Normalising is making a null text empty: any other change could change the count. An empty
    text has no bytes and no tokens. Repeated rows stay; other columns are not carried. A run
    that dies before its append has finished leaves the cache as it was.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer)
    content = F.sha2(F.col("text"), 256).alias("content")
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    here = F.col("version") == F.lit(version)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer_path(tokenizer)
        for batch in text_chunks(batches, "text"):
            counts = pa.array(_counts(batch["text"].to_pylist(), path), pa.int64())
            yield pa.RecordBatch.from_arrays([batch["content"], pa.array([version] * batch.num_rows), counts], ["content", "version", "n_tokens"])

    # The exchange by content serves both the distinct contents and the join with the cache.
    distinct = source.select(content, "text").dropDuplicates(["content"])
    misses = distinct.join(stored_counts(spark, cache).filter(here), "content", "left_anti")
    misses.select("content", "text").mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(cache)

    counts = stored_counts(spark, cache).filter(here).select("content", "n_tokens")
    return (
        source.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), content)
        .join(counts, "content")
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache, so that its time is that of encoding every distinct text."""
    return count_tokens(table(spark, sf_dir, "documents"), new_path(spark, "token-counts"))
