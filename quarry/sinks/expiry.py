"""Partition expiry (L9): drop day partitions older than the table's setting.

A day partition expires when ``day (00:00 UTC) + partition_expiration_ms`` is
at or before ``as_of``; days are UTC days (see ``layout.day_column``), so the
session's time zone plays no part. The partition list is catalog metadata (one entry
per day), never table rows. All expired days go in one
``ALTER TABLE ... DROP PARTITION`` and, for directories the engine owns,
their files are deleted too -- otherwise a later ``MSCK REPAIR`` would
bring the rows back. NULL days (``__HIVE_DEFAULT_PARTITION__``) never expire.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import col
from ..functions.names import quote
from ..sources import catalog, files

_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def expired_days(days: list[str], expiration_ms: int, as_of: dt.datetime) -> list[str]:
    last = last_expired(expiration_ms, as_of)
    return [d for d in days if d != _NULL_PARTITION and last is not None and dt.date.fromisoformat(d) <= last]


def last_expired(expiration_ms: int, as_of: dt.datetime) -> dt.date | None:
    """The last day that has expired; None if the calendar does not go back that far."""
    try:
        return (as_of - dt.timedelta(milliseconds=expiration_ms)).date()
    except OverflowError:
        return None


def unexpired(df: DataFrame, day_col: str, expiration_ms: int | None, as_of: dt.datetime) -> DataFrame:
    """``df`` without rows that the table's expiry would drop right after the
    write, so that they are neither shuffled nor written."""
    last = None if expiration_ms is None else last_expired(expiration_ms, as_of)
    return df if last is None else df.filter(col(day_col).isNull() | (col(day_col) > F.lit(last)))


def expire_partitions(spark: SparkSession, target: str, as_of: dt.datetime | None = None,
                      props: dict[str, str] | None = None) -> list[str]:
    """Apply the table's recorded expiry; ``props`` saves reading them again."""
    if props is None:
        props = catalog.properties(spark, target)
    day_col = props.get(catalog.PROP_DAY_COLUMN)
    ms = props.get(catalog.PROP_EXPIRATION_MS)
    if not day_col or ms is None:
        return []
    as_of = as_utc(as_of)
    prefix = f"{day_col}="
    days = []
    for r in spark.sql(f"SHOW PARTITIONS {target}").collect():
        for piece in r[0].split("/"):
            if piece.startswith(prefix):
                days.append(piece[len(prefix):])
    gone = expired_days(sorted(set(days)), int(ms), as_of)
    if not gone:
        return []
    specs = ", ".join(f"PARTITION ({quote(day_col)} = DATE'{d}')" for d in gone)
    spark.sql(f"ALTER TABLE {target} DROP IF EXISTS {specs}")
    if props.get(catalog.PROP_OWNED) == "true":
        root = (catalog.location(spark, target) or "").rstrip("/")
        # Directory deletes are metadata calls; on an object store each one
        # lists and deletes many keys, so run them side by side.
        with ThreadPoolExecutor(max_workers=min(16, len(gone))) as pool:
            list(pool.map(lambda d: files.delete_tree(spark, f"{root}/{day_col}={d}"), gone))
    spark.catalog.refreshTable(target)
    return gone


def as_utc(as_of: dt.datetime | dt.date | str | None) -> dt.datetime:
    """``as_of`` as a naive UTC datetime (now if None)."""
    if as_of is None:
        return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(as_of, str):
        as_of = dt.datetime.fromisoformat(as_of)
    if isinstance(as_of, dt.date) and not isinstance(as_of, dt.datetime):
        as_of = dt.datetime.combine(as_of, dt.time())
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return as_of
