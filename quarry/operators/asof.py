"""As-of join: to each row on the left the last row on the right that is no later.

Both sides are united, with equal columns, and range-partitioned on (keys,
time, side, ties), so a key that holds a third of all rows is spread over many
parts. Within a part, a running ``last`` finds the match of each left row. What
a part's first rows need from earlier parts is carried: each part gives one
row, its last right row, and the last of those before a part (one row per part
in all) matches its left rows of the same key that found none. No row meets
another; nothing is expanded.

In order of (keys, time), right rows of one time stand before left ones if
``exact`` (a match may be at the same time), else behind them. Right rows equal
in keys and time stand in order of ``ties``, and the last one matches.
``direction="forward"`` goes the other way: the first row that is no earlier
(of equal ones the first).

A null key or a null time matches nothing. All rows on the left come out once
(``how="left"``, nulls if unmatched), or those with a match (``how="inner"``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.columns import col
from ..session import scratch_root
from . import layout


def asof_join(left: DataFrame, right: DataFrame, *, left_on: str, right_on: str,
              by: Sequence[str | tuple[str, str]] = (), ties: Sequence[str] = (), exact: bool = True,
              direction: str = "backward", how: str = "left", suffix: str = "_right") -> DataFrame:
    """The columns of ``left``, then those of ``right`` but its keys; a name that
    ``left`` has too gets ``suffix``. ``by``: columns that must be equal, by name or as
    (left, right) names. ``ties``: columns of ``right`` that order its rows of equal
    keys and time; without them any of these rows may match.

    Runs a job at once: the united rows go to the checkpoint folder, where Spark
    deletes them with the frame if
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set."""
    if direction not in ("backward", "forward"):
        raise ValueError(f"direction must be 'backward' or 'forward', got {direction!r}")
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', got {how!r}")
    pairs = [(k, k) if isinstance(k, str) else tuple(k) for k in by]
    keys, tied = [f"k{i}" for i in range(len(pairs))], [f"o{i}" for i in range(len(ties))]
    of_right = [c for c in right.columns if c not in {k for _, k in pairs}]
    forward = direction == "forward"

    held = col(right_on).isNotNull()
    for _, k in pairs:
        held = held & col(k).isNotNull()
    rights = right.where(held).select(
        *[col(k).alias(n) for (_, k), n in zip(pairs, keys, strict=True)], col(right_on).alias("t"),
        F.lit(0 if exact else 1).alias("s"), *[col(c).alias(n) for c, n in zip(ties, tied, strict=True)],
        F.lit(0).cast("long").alias("spread"), _packed(right, of_right).alias("r"),
        F.lit(None).cast(_type(left, left.columns)).alias("l"))
    # the last range key tells left rows of equal keys and time apart; it depends on
    # what a row holds, so a task that runs again sends every row to the same part
    narrow = [col(f.name) for f in left.schema.fields if isinstance(f.dataType, layout.NARROW)]
    lefts = left.select(
        *[col(k).alias(n) for (k, _), n in zip(pairs, keys, strict=True)], col(left_on).alias("t"),
        F.lit(1 if exact else 0).alias("s"),
        *[F.lit(None).cast(right.schema[c].dataType).alias(n) for c, n in zip(ties, tied, strict=True)],
        F.xxhash64(F.spark_partition_id(), *narrow).alias("spread"),
        F.lit(None).cast(_type(right, of_right)).alias("r"), _packed(left, left.columns).alias("l"))
    united = rights.unionByName(lefts)

    def ordered(name: str) -> Column:
        return F.col(name).desc_nulls_last() if forward else F.col(name).asc_nulls_first()

    along = [ordered("t"), F.col("s").asc(), *map(ordered, tied)]
    scratch_root(left.sparkSession)  # where checkpoints go
    ranges = layout.range_count(united)
    by_range = [*map(ordered, keys), *along, "spread"]
    parted = (united.repartitionByRange(ranges, *by_range) if ranges else united.repartitionByRange(*by_range)) \
        .drop("spread").withColumn("part", F.spark_partition_id()).checkpoint()
    so_far = Window.partitionBy("part", *keys).orderBy(*along).rowsBetween(Window.unboundedPreceding, 0)
    found = (parted.withColumn("own", F.last("r", ignorenulls=True).over(so_far)).where(F.col("l").isNotNull())
             .join(_carried(parted, keys, tied, forward), "part"))
    matched, same = F.col("t").isNotNull(), F.lit(True)
    for k in keys:
        matched, same = matched & F.col(k).isNotNull(), same & (F.col(k) == F.col(f"carry.{k}"))
    match = F.when(matched, F.coalesce("own", F.when(same, F.col("carry.r"))))
    out = found.select("l", match.alias("m"))
    if how == "inner":
        out = out.where(F.col("m").isNotNull())
    taken = set(left.columns)
    return out.select(*[F.col(f"l.c{i}").alias(c) for i, c in enumerate(left.columns)],
                      *[F.col(f"m.c{i}").alias(c + suffix if c in taken else c) for i, c in enumerate(of_right)])


def _carried(parted: DataFrame, keys: list[str], tied: list[str], forward: bool) -> DataFrame:
    """(part, carry) for every part: the last right row of all parts before it. If
    that is of another key, there is none of the wanted key: it would be later."""
    place = F.when(F.col("r").isNotNull(), F.struct(*keys, "t", *tied))
    ends = parted.groupBy("part").agg(
        (F.min_by if forward else F.max_by)(F.struct(*keys, "r"), place).alias("end"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    return ends.select("part", F.last("end", ignorenulls=True).over(before).alias("carry"))


def _packed(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.struct(*[col(c).alias(f"c{i}") for i, c in enumerate(columns)], F.lit(1).alias("is"))


def _type(df: DataFrame, columns: Sequence[str]) -> StructType:
    fields = df.select(_packed(df, columns).alias("x")).schema["x"].dataType.fields
    return StructType([StructField(f.name, f.dataType) for f in fields])
