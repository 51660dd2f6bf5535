"""A corpus pipeline of five stages, each one operator of ``quarry.llm``:
quality rules, exact dedup, near-duplicates, repeated substrings, packing.

Every stage works on all rows its predecessor kept. All but the last return the
columns of ``documents``; the last returns the packed pieces. SQL can't express
the stages (minimum-covariance-determinant steps, signatures, tokenizers), so
``ORACLE_SQL`` is None and the stages are tested against brute force.

Defined cases: a null or empty text fails the quality rules (no words), so it
goes in the first stage; a stage that is given one keeps it. A null ``doc_id``
is kept and comes before all others where ids decide; nulls in other columns
and columns of any other name are carried along. Rows that are equal in all
columns are copies like any others: one stays. An empty table gives an empty
result in every stage.

A stage's result is to be written before the next stage is called: that one
deletes the scratch tables of the one before it (in the same thread).
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bagminhash, exact_dedup, packing, quality_rules, suffix_dedup
from quarry.llm.common import scope, stored, table
from quarry.llm.queries import tokenizer

#: Of each thread, the scope of the stage that ran last in it.
_LAST = threading.local()


def _stage(spark: SparkSession, work: Callable[[DataFrame], DataFrame], docs: DataFrame) -> DataFrame:
    """``work(docs)``; what the stage before it kept aside can go, as ``docs`` is written."""
    if (last := getattr(_LAST, "scope", None)) is not None:
        last.release(spark)
    with scope() as _LAST.scope:
        return work(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _stage(spark, quality_rules.kept_rows, docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _stage(spark, exact_dedup.kept_rows, docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _stage(spark, bagminhash.kept_rows, docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated strings; n_chars is counted anew."""
    cleaned = _stage(spark, suffix_dedup.deduplicated, docs)
    out = cleaned.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(docs.columns)])
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encode = packing.bpe_with_end(tokenizer("word_bpe_49k.json"), 2)
    pieces = _stage(spark, lambda rows: packing.pack(rows, encode), docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "loss_tokens")


STAGES = [("quality rules", quality), ("exact dedup", exact), ("near duplicates", near),
          ("repeated substrings", substrings), ("packing", packed)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written and read again. Of what was
    written, the rows that the last stage reads are left, until the driver ends."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        with scope() as own:
            docs = stored(spark, out, name.replace(" ", "-"))
        if before is not None:
            before.release(spark)
        before = own
    return STAGES[-1][1](spark, docs, sf_dir)
