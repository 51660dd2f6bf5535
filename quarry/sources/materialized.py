"""View results written as tables, and read again while they are current (X5).

A materialisation has in its name what it holds: a digest of the view's
canonical plan and of the versions of the tables under it, which are their
files (names are never used twice, so another set of names is another version).
A view that is read again before the table expires and before any source has
changed finds that table and runs nothing. A view whose result does
not follow from its files (random numbers, the current time, rows that are not
in files) gets a table of its own each time.

Tables expire; expired ones of a dataset are dropped when the next one is made.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import hashlib
import re
import uuid
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..functions.names import qualify
from ..sinks import staging
from . import catalog

PREFIX = "_quarry_view_"
#: Expressions that a plan holds as if they were constants, but that another run gives anew.
_OF_THE_MOMENT = re.compile(r"\b(current_\w+|now|localtimestamp|uuid|rand\w*|shuffle|input_file_\w+|"
                            r"monotonically_increasing_id|spark_partition_id|session_user|user)\(", re.I)
_EVERY_FIELD = (1 << 31) - 1


def materialize(spark: SparkSession, view: str, project: str | None, dataset: str, expiration_minutes: int,
                detail: dict) -> DataFrame:
    """The rows of ``view`` from a table in ``dataset``."""
    now = dt.datetime.now(dt.timezone.utc)
    drop_expired(spark, project, dataset, now)
    spark.catalog.refreshTable(view)  # files that other sessions wrote
    df = spark.table(view)
    key = state_key(df)
    if key is None:
        return _make(df, qualify(PREFIX + uuid.uuid4().hex[:24], dataset, project), now, expiration_minutes, detail)
    with staging.claim(spark, qualify(PREFIX + key, dataset, project)):  # of several readers one makes it
        if (found := _current(spark, key, project, dataset)) is None:
            name = f"{PREFIX}{key}_{uuid.uuid4().hex[:8]}"  # a place of its own: a lost writer may have left files
            return _make(df, qualify(name, dataset, project), now, expiration_minutes, detail)
        detail["materializedAs"], detail["materializationExpiresAt"] = found
        detail["materializationReused"] = True
        return spark.table(found[0])


def _make(df: DataFrame, target: str, now: dt.datetime, expiration_minutes: int, detail: dict) -> DataFrame:
    expires = now + dt.timedelta(minutes=expiration_minutes)
    # the expiry is part of the table's creation: a driver lost right after leaves no table without one
    df.writeTo(target).using("parquet").tableProperty(catalog.PROP_EXPIRES_AT, expires.isoformat()).create()
    detail["materializedAs"], detail["materializationExpiresAt"] = target, expires.isoformat()
    return df.sparkSession.table(target)


def _current(spark: SparkSession, key: str, project: str | None, dataset: str) -> tuple[str, str] | None:
    """The table that holds the state ``key`` and when it expires."""
    found = [(props[catalog.PROP_EXPIRES_AT], name) for name, props in _tables(spark, project, dataset, f"{key}_")
             if catalog.PROP_EXPIRES_AT in props]
    return max(found)[::-1] if found else None


def state_key(df: DataFrame) -> str | None:
    """A digest of the plan and of the state of everything it reads; None if its
    result may differ from run to run. Lists files, reads none."""
    plan = df._jdf.queryExecution().analyzed().canonicalized()
    text = plan.treeString(True, False, _EVERY_FIELD, False, False)
    leaves = plan.collectLeaves()
    kinds = [leaves.apply(k).getClass().getSimpleName() for k in range(leaves.size())]
    if not plan.deterministic() or _OF_THE_MOMENT.search(text) or set(kinds) - {"LogicalRelation", "OneRowRelation", "Range"}:
        return None
    sources = [leaves.apply(k).relation() for k, kind in enumerate(kinds) if kind == "LogicalRelation"]
    if any(s.getClass().getSimpleName() != "HadoopFsRelation" for s in sources):
        return None
    digest = hashlib.sha256(text.encode())
    digest.update(df.schema.json().encode())
    for source in sources:
        digest.update(str(source.location().sizeInBytes()).encode())
    for name in sorted(df.inputFiles()):
        digest.update(name.encode() + b"\n")
    return digest.hexdigest()[:24]


def drop_expired(spark: SparkSession, project: str | None, dataset: str, now: dt.datetime) -> None:
    for name, props in _tables(spark, project, dataset, ""):
        expires = props.get(catalog.PROP_EXPIRES_AT)
        if expires and dt.datetime.fromisoformat(expires) <= now:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _tables(spark: SparkSession, project: str | None, dataset: str, start: str) -> Iterator[tuple[str, dict[str, str]]]:
    """Materialisations in the dataset and their properties: names by pattern, from the catalog alone."""
    ns = qualify("x", dataset, project).rsplit(".", 1)[0]
    for row in spark.sql(f"SHOW TABLES IN {ns} LIKE '{PREFIX}{start}*'").collect():
        if not row["isTemporary"]:
            name = f"{ns}.`{row['tableName']}`"
            with contextlib.suppress(AnalysisException):  # another sweep dropped it
                yield name, catalog.properties(spark, name)
