"""Physical layout of a write: day partitions (L8) and clustering (L10).

Plans, by case:

* unpartitioned, not clustered: written as the input is partitioned,
  no shuffle added.
* unpartitioned, clustered: range-partition on the clustered fields, then
  sort within partitions. Files hold disjoint key ranges, so parquet
  row-group min/max statistics skip whole files for a range filter. A
  tie-breaker is the last range key, so one hot key value -- even a third
  of all rows -- is split over several tasks instead of landing in one.
  The tie-breaker is a hash of the row and its input partition number:
  it does not depend on row order, so a retried task sends every row to
  the same range again, and exact copies of a row spread with their input
  partitions. (Range partitioning samples its input first: one extra pass.)
* day-partitioned (clustered or not): ``REBALANCE`` on the day column.
  Each task then holds whole days, so a day is one file, not one file per
  input task; adaptive execution splits an oversized (skewed) day into
  advisory-size pieces and merges small ones. With clustering, rows are
  sorted by day and the clustered fields inside each task, so every file
  is sorted and its row groups skip well. No sampling pass is needed.
  Splitting a skewed day is adaptive execution's work; with it switched
  off, the day is range-partitioned with the tie-breaker instead.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType

from ..functions.columns import col
from ..sources.catalog import DERIVED_DAY

MAX_CLUSTERED_FIELDS = 4
NARROW = (NumericType, DateType, TimestampType, TimestampNTZType, BooleanType)
#: An estimate of a join can be far above its size: no more ranges than this (100 TB at 1 GB).
_MAX_RANGES = 100_000
#: An exabyte: what Spark says of rows whose size it doesn't know, and of joins with them.
_NO_ESTIMATE = 1 << 60
_TIEBREAK = "__quarry_row"
_DAY_MICROS = 86_400_000_000


def day_column(df: DataFrame, partition_field: str, name: str | None = None) -> tuple[DataFrame, str]:
    """The partition column for ``partition_field``: the field itself if it
    is a DATE, else a derived column: the date of a timestamp, for zoned
    timestamps its date in UTC whatever the session's zone, so that one
    instant has one day. It is called ``name``, or by the first of ``__day``,
    ``__day_1``, ... that no column has."""
    field = _field(df, partition_field)
    if isinstance(field.dataType, DateType):
        return df, field.name
    if isinstance(field.dataType, (TimestampType, TimestampNTZType)):
        taken = {c.lower() for c in df.columns}
        free = (DERIVED_DAY + (f"_{i}" if i else "") for i in itertools.count())
        name = name or next(c for c in free if c not in taken)
        at = col(field.name)
        day = F.to_date(at) if isinstance(field.dataType, TimestampNTZType) else \
            F.date_from_unix_date(F.floor(F.unix_micros(at) / F.lit(_DAY_MICROS)).cast("int"))
        return df.withColumn(name, day), name
    raise TypeError(f"partition_field {partition_field!r} must be a DATE or TIMESTAMP column, "
                    f"not {field.dataType.simpleString()}")


def can_partition(df: DataFrame, name: str) -> bool:
    """Whether ``df`` has a column of that name that ``day_column`` takes."""
    return any(f.name.lower() == name.lower() and isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType))
               for f in df.schema.fields)


def check_clustered(df: DataFrame, fields: Sequence[str]) -> list[str]:
    if len(fields) > MAX_CLUSTERED_FIELDS:
        raise ValueError(f"at most {MAX_CLUSTERED_FIELDS} clustered fields, got {len(fields)}")
    return [_field(df, f).name for f in fields]


def lay_out(df: DataFrame, day_col: str | None, clustered: Sequence[str], ranges: int | None = None) -> DataFrame:
    clustered = list(clustered)
    if day_col:
        if _adaptive(df):
            df = df.hint("rebalance", col(day_col))
        else:
            df = _ranged(df, [day_col, *clustered])
        return df.sortWithinPartitions(*[col(c) for c in (day_col, *clustered)]) if clustered else df
    if clustered:
        return _ranged(df, clustered, ranges).sortWithinPartitions(*[col(c) for c in clustered])
    return df


def _ranged(df: DataFrame, keys: list[str], ranges: int | None = None) -> DataFrame:
    # The narrow columns tell rows apart well enough; hashing long texts and
    # arrays of every row would cost more than an uneven split of their copies.
    narrow = [col(f.name) for f in df.schema.fields if isinstance(f.dataType, NARROW)]
    tiebreak = F.xxhash64(F.spark_partition_id(), *(narrow or [col(k) for k in keys]))
    by = [*[col(k) for k in keys], col(_TIEBREAK)]
    ranges = ranges or range_count(df)
    df = df.withColumn(_TIEBREAK, tiebreak)
    return (df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)).drop(_TIEBREAK)


def range_count(df: DataFrame) -> int | None:
    """Ranges for a clustered write: the plan's size estimate over the advisory
    partition size, if that is more than the session's shuffle partitions. Else
    None: the session's count, whose small neighbours adaptive execution merges
    (it never splits a range, so many bytes need many ranges from the start)."""
    conf = df.sparkSession.conf
    initial = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    count = int(initial or conf.get("spark.sql.shuffle.partitions"))
    estimate = estimated_bytes(df)
    wanted = math.ceil(estimate / advisory_bytes(df))
    return min(wanted, _MAX_RANGES) if wanted > count and estimate < _NO_ESTIMATE else None


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate for the plan's output; nothing is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def advisory_bytes(df: DataFrame) -> int:
    text = df.sparkSession.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes").lower().rstrip("b")
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}.get(text[-1:], 1)
    return int(text.rstrip("kmgt")) * unit


def _adaptive(df: DataFrame) -> bool:
    conf = df.sparkSession.conf
    return (conf.get("spark.sql.adaptive.enabled", "true") == "true"
            and conf.get("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true") == "true")


def _field(df: DataFrame, name: str):
    for f in df.schema.fields:
        if f.name.lower() == name.lower():
            return f
    if "." in name:
        raise ValueError(f"{name!r}: only top-level columns can partition or cluster a table")
    raise ValueError(f"column {name!r} not in {df.columns}")
