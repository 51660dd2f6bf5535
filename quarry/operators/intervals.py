"""Interval join: pairs of rows whose intervals overlap, without a nested loop.

Each interval has a level: the first width, of 1, 2, 4, 8, ..., that is no less
than its length. Cut at that width, or any greater one, it touches two bins at
most. A pair meets at the greater of its two levels: there both sides are cut,
joined on (keys, level, bin), tested by the exact predicate, and taken at the
first bin they have in common, so once. An interval is cut at its own level and
at those greater ones that intervals of the other side have; their number is
that of different lengths, on a scale of powers of two, whatever the rows.

A bin of a level holds intervals more than half as long as it is wide on one
side, so what meets in a bin is no more than a few times what overlaps. A hot
bin is a skewed join key, which adaptive execution splits.

Ends are inclusive (``closed=True``), or the end is exclusive. Ends can be
dates, timestamps, whole numbers, decimals or doubles. A row with a null or NaN
end or key, or whose end is before its start, overlaps nothing; with an
exclusive end neither does one whose end is its start.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DoubleType, FloatType, TimestampNTZType, TimestampType

from ..functions.columns import col

#: Whole numbers that ends are mapped to stay within this, so that lengths fit a long.
_FAR = 1 << 61


def interval_join(left: DataFrame, right: DataFrame, *, left_interval: tuple[str, str], right_interval: tuple[str, str],
                  by: Sequence[str | tuple[str, str]] = (), closed: bool = True, suffix: str = "_right") -> DataFrame:
    """The columns of ``left`` and then of ``right`` for every overlapping pair; a
    name that ``left`` has too gets ``suffix``. ``left_interval`` and
    ``right_interval`` name the start and end columns (a point has one column
    twice), ``by`` columns that must be equal, by name or as (left, right) names.

    Which levels either side has is found by an aggregate over it that runs at once."""
    pairs = [(k, k) if isinstance(k, str) else tuple(k) for k in by]
    keys = [f"k{i}" for i in range(len(pairs))]
    a = _measured(left, left_interval, [k for k, _ in pairs], keys, closed)
    b = _measured(right, right_interval, [k for _, k in pairs], keys, closed)
    cut_a, cut_b = _cut(a, _levels(b), "a"), _cut(b, _levels(a), "b")
    overlap = (F.col("a_start") <= F.col("b_end")) & (F.col("b_start") <= F.col("a_end")) if closed else \
        (F.col("a_start") < F.col("b_end")) & (F.col("b_start") < F.col("a_end"))
    met = cut_a.join(cut_b, [*keys, "at", "bin"]).where(
        (F.col("at") == F.greatest("a_level", "b_level")) & (F.col("bin") == F.greatest("a_first", "b_first")) & overlap)
    taken = set(left.columns)
    return met.select(*[F.col(f"a_row.c{i}").alias(c) for i, c in enumerate(left.columns)],
                      *[F.col(f"b_row.c{i}").alias(c + suffix if c in taken else c) for i, c in enumerate(right.columns)])


def _whole(name: str, kind: DataType) -> Column:
    """A whole number that grows with the value (equal values may share one with others)."""
    if isinstance(kind, DateType):
        return F.unix_date(col(name)).cast("long")
    if isinstance(kind, TimestampType):
        return F.unix_micros(col(name))
    if isinstance(kind, TimestampNTZType):
        # days and the time of day: no zone comes into it
        day = F.unix_date(F.to_date(col(name))).cast("long")
        within = F.hour(col(name)) * 3600 + F.minute(col(name)) * 60
        return day * F.lit(86_400) + within.cast("long") + F.floor(F.extract(F.lit("SECOND"), col(name))).cast("long")
    far = F.lit(float(_FAR)) if isinstance(kind, (FloatType, DoubleType)) else F.lit(_FAR)
    return F.floor(F.greatest(-far, F.least(far, col(name)))).cast("long")


def _measured(df: DataFrame, interval: tuple[str, str], by: list[str], keys: list[str], closed: bool) -> DataFrame:
    """(keys, start, end, from, to, level, row) of the rows that can overlap something."""
    low, high = interval
    kinds = [df.schema[c].dataType for c in interval]
    valid = (col(low) <= col(high)) if closed else (col(low) < col(high))
    for c, kind in zip(interval, kinds, strict=True):
        if isinstance(kind, (FloatType, DoubleType)):
            valid = valid & ~F.isnan(col(c))
    for k in by:
        valid = valid & col(k).isNotNull()
    length = F.col("to") - F.col("from")
    return (df.where(valid)
            .select(*[col(k).alias(n) for k, n in zip(by, keys, strict=True)], col(low).alias("start"), col(high).alias("end"),
                    _whole(low, kinds[0]).alias("from"), _whole(high, kinds[1]).alias("to"),
                    F.struct(*[col(c).alias(f"c{i}") for i, c in enumerate(df.columns)]).alias("row"))
            .withColumn("level", F.when(length == 0, 0).otherwise(F.length(F.bin(length)))))


def _levels(df: DataFrame) -> list[int]:
    """The levels that occur: at most one for each power of two."""
    return sorted(r[0] for r in df.select("level").distinct().collect())


def _cut(df: DataFrame, other_levels: list[int], side: str) -> DataFrame:
    """A row for each bin at the levels where a pair can meet: its own, if the other
    side has one no greater, and the greater ones of the other side."""
    arrays = F.array([F.lit(x) for x in other_levels]).cast("array<int>")
    greater = F.filter(arrays, lambda x: x > F.col("level"))
    least = min(other_levels, default=1 << 10)
    at = F.concat(greater, F.when(F.col("level") >= least, F.array("level")).otherwise(F.array().cast("array<int>")))
    first = F.call_function("shiftright", F.col("from"), F.col("at"))
    last = F.call_function("shiftright", F.col("to"), F.col("at"))
    return (df.withColumn("at", F.explode(at)).withColumn("first", first)
            .withColumn("bin", F.explode(F.sequence(F.col("first"), last))).drop("from", "to")
            .withColumnsRenamed({c: f"{side}_{c}" for c in ("start", "end", "first", "row", "level")}))
