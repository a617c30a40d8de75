"""Token counts through a cache keyed by content digest and tokenizer version.

A text's count is looked up by the SHA-256 digest of its normalised content (null
becomes empty; nothing else may change, or the count could) and of the tokenizer
file. Only distinct texts the cache doesn't know are encoded, and their counts are
appended to it, so a later run over the same or overlapping rows encodes only what is
new. Copies, however many, are merged before the shuffle and encoded once.

Null and empty texts have 0 bytes and 0 tokens. Null or repeated ids keep one row per
input row. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from feedlake.llm.store import settle
from feedlake.llm.tokens import TokenCounter, file_digest, tokenizer_path

#: Texts turned into Python strings at a time.
SLICE = 256


def stored_counts(spark, cache: str, version: str) -> DataFrame:
    """``digest, n_tokens`` of the cache for one tokenizer version; no rows where there is no cache yet."""
    try:
        rows = spark.read.schema("digest binary, n_tokens bigint, version string").parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "digest binary, n_tokens bigint")
    # Two runs that started together may both have appended a text; their counts are equal.
    return rows.where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def encode(texts: DataFrame, path: str) -> DataFrame:
    """``digest, n_tokens`` of ``digest, text``."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(path)
        for batch in batches:
            digests, column = batch.columns
            for i in range(0, len(column), SLICE):
                n = [counter.encode(t) for t in column.slice(i, SLICE).to_pylist()]
                yield pa.record_batch([digests.slice(i, SLICE), pa.array(n, pa.int64())], ["digest", "n_tokens"])

    return texts.mapInArrow(counts, "digest binary, n_tokens bigint")


def count_tokens(
    docs: DataFrame,
    cache: str,
    tokenizer: str = "byte_bpe_50k.json",
    limit: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row; the folder ``cache`` gains the counts it lacked."""
    spark = docs.sparkSession
    path = tokenizer_path(tokenizer)
    version = file_digest(path)
    content = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(
        F.col(id_col).alias("doc_id"),
        F.octet_length(content).cast("bigint").alias("n_bytes"),
        F.unhex(F.sha2(content, 256)).alias("digest"),
        content.alias("text"),
    )
    keys = settle(texts.select("doc_id", "n_bytes", "digest"), "content-digests")
    stored = stored_counts(spark, cache, version)
    if not stored.isEmpty():
        # Only the digests are compared first, so that known texts don't move.
        unknown = keys.select("digest").distinct().join(stored, "digest", "left_anti")
        texts = texts.join(settle(unknown, "unknown-digests"), "digest", "left_semi")
    misses = texts.groupBy("digest").agg(F.first("text").alias("text"))
    encoded = encode(misses, path).withColumn("version", F.lit(version))
    encoded.write.mode("append").partitionBy("version").parquet(cache)
    counted = keys.join(stored_counts(spark, cache, version), "digest")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
