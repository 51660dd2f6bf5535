"""Distribution after the scan: read cap (X3), repartition (D1-D4),
persist (D6) and output statistics (D7).

Each is one DataFrame call; Catalyst keeps the partitioning an operator
asks for, so a later join or aggregate on the same keys reuses it instead
of shuffling again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import col

STORAGE_LEVELS = {
    name: getattr(StorageLevel, name)
    for name in ("DISK_ONLY", "DISK_ONLY_2", "DISK_ONLY_3", "MEMORY_AND_DISK", "MEMORY_AND_DISK_2",
                 "MEMORY_AND_DISK_DESER", "MEMORY_ONLY", "MEMORY_ONLY_2", "OFF_HEAP")
    if hasattr(StorageLevel, name)
}


def cap_parallelism(df: DataFrame, max_parallelism: int | None) -> DataFrame:
    """At most ``max_parallelism`` partitions, without a shuffle.

    ``coalesce`` merges scan splits, so the scan itself runs with at most
    that many tasks -- the meaning of a read-parallelism cap. It never
    raises the count.
    """
    return df if max_parallelism is None else df.coalesce(max_parallelism)


def repartition(df: DataFrame, num_partitions: int | None, partition_by: Sequence[str]) -> DataFrame:
    """The reference's four cases.

    * neither: as scanned (no shuffle),
    * count only: round-robin into exactly ``num_partitions``,
    * keys only: hash on the keys into ``spark.sql.shuffle.partitions``,
      which adaptive execution may coalesce (each key still in one partition),
    * both: hash on the keys into exactly ``num_partitions``.
    """
    cols = [df[c] for c in partition_by]
    if not cols:
        return df if num_partitions is None else df.repartition(num_partitions)
    if num_partitions is None:
        return df.repartition(*cols)
    return df.repartition(num_partitions, *cols)


def persist(df: DataFrame, level: str | StorageLevel | None) -> tuple[DataFrame, int]:
    """Cache and fill the cache with one count; returns (df, records).

    The default level spills to disk rather than dropping blocks; a lost
    executor's blocks are recomputed from lineage.
    """
    if isinstance(level, str):
        level = STORAGE_LEVELS[level]
    df = df.persist(level or StorageLevel.MEMORY_AND_DISK)
    return df, df.count()


@dataclass
class Observed:
    """Counts that come with the first action on a frame."""

    observation: Observation
    columns: list[str]

    def get(self) -> dict[str, Any]:
        found = self.observation.get
        return {"records": found["records"], "nulls": {c: found[f"nulls_{i}"] for i, c in enumerate(self.columns)}}


def observe(df: DataFrame, null_columns: Sequence[str] = ()) -> tuple[DataFrame, Observed]:
    """The frame with a count of its rows, and of the nulls of some columns, taken
    as they pass: partial counts per task, merged on the driver, no shuffle and no
    job. Filters of later steps are not pushed below the count, and the columns
    are read."""
    by_name = {f.name.lower(): f.name for f in df.schema.fields}
    missing = [c for c in null_columns if c.lower() not in by_name]
    if missing:
        raise ValueError(f"observe_nulls: {missing} not in {df.columns}")
    columns = [by_name[c.lower()] for c in null_columns]
    observation = Observation(f"quarry-{uuid.uuid4().hex}")
    counts = [F.count(F.when(col(c).isNull(), 1)).alias(f"nulls_{i}") for i, c in enumerate(columns)]
    return df.observe(observation, F.count(F.lit(1)).alias("records"), *counts), Observed(observation, columns)


def persist_observed(df: DataFrame, level: str | StorageLevel | None, null_columns: Sequence[str]) \
        -> tuple[DataFrame, Observed]:
    """Cache, and fill the cache with the action that is observed."""
    df = df.persist((STORAGE_LEVELS[level] if isinstance(level, str) else level) or StorageLevel.MEMORY_AND_DISK)
    seen, observed = observe(df, null_columns)
    seen.write.format("noop").mode("overwrite").save()
    return df, observed


def partition_count(df: DataFrame) -> int:
    """Number of partitions of the frame's RDD.

    Cheap for a plain scan; after a shuffle under adaptive execution it has
    to run the shuffle to know, so callers ask for it explicitly.
    """
    return df.rdd.getNumPartitions()
