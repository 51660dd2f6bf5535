"""Token counts through a digest cache.

The cache is a Parquet table of (content digest, tokenizer digest, count).
Counting a set of documents joins their digests to it, encodes one text per
digest that is missing, and appends those counts. A text met before, in this
call or an earlier one, is never encoded again; a changed tokenizer file has
another digest and so its own counts.

Defined cases: a null text counts as empty (0 tokens); a null ``doc_id`` is
kept as it is; repeated rows each get their row; an empty table gives an empty
result; other columns are ignored. The content is normalised in nothing but
null to empty, as any other change could change the count.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import loaded
from .common import content, file_digest

CACHE_SCHEMA = "content_digest binary, tokenizer_digest string, n_tokens long"


def open_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache at ``path``, made empty if there is none. Should two calls
    have stored the same digest, one of the (equal) counts is taken."""
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(path)
    return spark.read.schema(CACHE_SCHEMA).parquet(path)


def with_digest(docs: DataFrame) -> DataFrame:
    text = content()
    return docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"),
                       F.unhex(F.sha2(text, 256)).alias("content_digest"))


def misses(docs: DataFrame, cached: DataFrame) -> DataFrame:
    """One text (content_digest, text) per digest that ``cached`` lacks. Copies go
    before the shuffle, and what is left moves once, by digest."""
    distinct = with_digest(docs).groupBy("content_digest").agg(F.first("text").alias("text"))
    return distinct.join(cached, "content_digest", "left_anti")


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, content_digest) for every row of ``docs``."""
    spark = docs.sparkSession
    version = file_digest(tokenizer_path)
    cached = (open_cache(spark, cache_path).where(F.col("tokenizer_digest") == version)
              .select("content_digest", "n_tokens"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = loaded(tokenizer_path)
        for b in batches:
            counts = [len(words.ids(text.as_py())) // 4 for text in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array([version] * len(counts), pa.string()),
                                   pa.array(counts, pa.int64())], ["content_digest", "tokenizer_digest", "n_tokens"])

    (misses(docs, cached).mapInArrow(encode, CACHE_SCHEMA)
     .write.mode("append").parquet(cache_path))
    counts = (spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("tokenizer_digest") == version)
              .groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens")))
    return (with_digest(docs).drop("text").join(counts, "content_digest")
            .select("doc_id", "n_bytes", "n_tokens", "content_digest"))
