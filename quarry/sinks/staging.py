"""Staged write and publish (L13): overwrite that never destroys its source.

1. A side table ``<table>__quarry_<id>`` is registered over a fresh directory
   under the staging root *before* any row is written, with its full target
   name, the time and the application as properties. Then the rows are
   inserted. A failed job leaves the live table untouched; the side table and
   its directory are removed.
2. Publish is metadata only. The written files become the table where they
   are -- no copy, no per-file rename, which on object stores would be a copy
   of every byte. When the engine's own unpartitioned table keeps its columns
   (column metadata included), one ``ALTER TABLE ... SET LOCATION`` repoints
   it. Otherwise the side table is marked as being published, ``DROP TABLE``
   removes the old one and ``ALTER TABLE ... RENAME`` gives the side table its
   name: two commands, not one transaction. A driver lost between them leaves
   a marked side table as the only copy: the next load of the target (or
   :func:`finish_interrupted`) renames it into place.
3. The replaced version stays: its directory is noted in the table's
   properties, and only an overwrite that comes more than ``KEEP_HOURS`` later
   deletes it. Frames and views held over it go on working until then.
4. One publisher at a time: a publish holds the target's lease
   (:mod:`quarry.sinks.lease`), and so does an append while it writes, so neither
   changes the table under the other. Versions are written without it.
5. Nothing is ever deleted by its name or age alone. What a lost driver left
   unpublished is removed by :func:`sweep_leftovers`, which a user calls: it
   looks only at side tables registered for that very target by another
   application, and at none while the target itself is missing.

The location of a table is the catalog's alone; it is not recorded twice.

Because the source is read fully before the old table is replaced, a table
may be overwritten from itself ("UPDATE/DELETE as SELECT").
"""

from __future__ import annotations

import hashlib
import re
import time
import uuid
from contextlib import AbstractContextManager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..functions.names import parts_of, qualify, quote, sibling
from ..sources import catalog, files
from .lease import Lease, held

WRITING, PUBLISHING = "writing", "publishing"
#: A replaced version is kept for this long at least.
KEEP_HOURS = 24.0
_VERSION = re.compile(r".+-[0-9a-f]{16}")


def default_staging_root(spark: SparkSession, target: str) -> str:
    """The target database's location: shared storage the catalog already uses."""
    parts = parts_of(target)
    db = ".".join(quote(p) for p in parts[:-1]) if len(parts) > 1 else spark.catalog.currentDatabase()
    return spark.catalog.getDatabase(db).locationUri.rstrip("/")


def identity(spark: SparkSession, target: str) -> str:
    """Catalog, database and table of ``target``, whatever parts were left out."""
    parts = parts_of(target)
    current = [spark.catalog.currentCatalog(), spark.catalog.currentDatabase()]
    return ".".join(quote(p.lower()) for p in [*current[:3 - len(parts)], *parts])


def schema_digest(df: DataFrame) -> str:
    """A digest of names, types and column metadata, in order."""
    return hashlib.sha256(df.schema.json().encode()).hexdigest()


def _side_tables(spark: SparkSession, target: str) -> list[tuple[str, dict[str, str]]]:
    """Side tables registered for exactly this target, with their properties."""
    table = parts_of(target)[-1]
    db = ".".join(quote(p) for p in parts_of(target)[:-1]) or quote(spark.catalog.currentDatabase())
    own = identity(spark, target)
    found = []
    for row in spark.sql(f"SHOW TABLES IN {db} LIKE '{table.replace(chr(39), '')}__quarry_*'").collect():
        if not row["isTemporary"]:
            side = sibling(target, row["tableName"])
            try:
                props = catalog.properties(spark, side)
            except AnalysisException:  # published or dropped since it was listed
                continue
            if props.get(catalog.PROP_SIDE_OF) == own:
                found.append((side, props))
    return found


def finish_interrupted(spark: SparkSession, target: str) -> str | None:
    """If ``target`` is missing because a publish broke off after the old table
    was dropped, put the new version in place. Returns its former name."""
    if not _marked(spark, target):
        return None
    # a publisher holds the lease as long as a side table is marked: while we
    # hold it, what is marked was left by a writer that is gone
    with claim(spark, target):
        marked = _marked(spark, target)
        if not marked or catalog.object_type(spark, target) is not None:
            return None
        side = max(marked)[1]
        _rename(spark, side, target)
        catalog.unset_properties(spark, target, catalog.SIDE_PROPS)
        return side


def _marked(spark: SparkSession, target: str) -> list[tuple[str, str]]:
    """(start, side table) of the side tables that were being published."""
    return [(props.get(catalog.PROP_STARTED, "0"), side) for side, props in _side_tables(spark, target)
            if props.get(catalog.PROP_STATE) == PUBLISHING]


def being_published(spark: SparkSession, target: str) -> bool:
    return bool(_marked(spark, target))


def claim(spark: SparkSession, target: str) -> AbstractContextManager[Lease]:
    """The lease of ``target``; see :mod:`quarry.sinks.lease`."""
    return held(spark, default_staging_root(spark, target), identity(spark, target))


def sweep_leftovers(spark: SparkSession, table: str, dataset: str | None = None, project: str | None = None, *,
                    older_than_hours: float) -> list[str]:
    """Remove what lost drivers left unpublished of ``table``, and return it.

    Only side tables that were registered for this target, more than
    ``older_than_hours`` ago (choose more than the longest load takes), by
    another application than this one; with the directory the catalog names
    for them. None at all if the target does not exist, as one of them may be
    its only copy."""
    target = qualify(table, dataset, project, current=spark.catalog.currentDatabase())
    if catalog.object_type(spark, target) is None:
        return []
    live = catalog.location(spark, target) or ""
    before = (time.time() - older_than_hours * 3600) * 1000
    swept = []
    for side, props in _side_tables(spark, target):
        started = props.get(catalog.PROP_STARTED)
        if started is None or float(started) > before \
                or props.get(catalog.PROP_WRITER) == spark.sparkContext.applicationId:
            continue
        directory = catalog.location(spark, side)
        spark.sql(f"DROP TABLE IF EXISTS {side}")
        if directory and not files.same_path(spark, directory, live):
            files.delete_tree(spark, directory)
        swept.append(side)
    return swept


def _rename(spark: SparkSession, side: str, target: str) -> None:
    """The new name stands without a catalog: it stays in the side table's."""
    name = ".".join(quote(p) for p in parts_of(target)[-2:])
    spark.sql(f"ALTER TABLE {side} RENAME TO {name}")


def write_version(spark: SparkSession, df: DataFrame, target: str, *, staging_root: str,
                  partition_cols: list[str]) -> tuple[str, str]:
    """Write ``df`` as a new table version; returns (side table, its directory)."""
    token = uuid.uuid4().hex[:16]
    table = parts_of(target)[-1]
    directory = files.qualified(spark, f"{staging_root.rstrip('/')}/{table}-{token}")
    side = sibling(target, f"{table}__quarry_{token}")
    last = {c.lower() for c in partition_cols}
    ordered = df.select(*[quote(c) for c in df.columns if c.lower() not in last], *[quote(c) for c in partition_cols])
    try:
        if partition_cols:
            (ordered.limit(0).write.format("parquet").option("path", directory).partitionBy(*partition_cols)
             .mode("errorifexists").saveAsTable(side))
        else:  # no job, only the catalog
            spark.catalog.createTable(side, path=directory, source="parquet", schema=ordered.schema)
        catalog.set_properties(spark, side, {
            catalog.PROP_SIDE_OF: identity(spark, target), catalog.PROP_STARTED: str(int(time.time() * 1000)),
            catalog.PROP_WRITER: spark.sparkContext.applicationId, catalog.PROP_STATE: WRITING})
        # Spark's default commit protocol: a task attempt lost mid-commit
        # never leaves its files behind, so a retried task cannot duplicate rows.
        ordered.write.insertInto(side, overwrite=True)
    except BaseException:
        discard(spark, side, directory)
        raise
    return side, directory


def _retired(props: dict[str, str]) -> list[tuple[int, str]]:
    """(time in ms, directory) of replaced versions that are still there."""
    lines = [x.split("|", 1) for x in props.get(catalog.PROP_RETIRED, "").split("\n") if "|" in x]
    return [(int(ms), path) for ms, path in lines]


def discard(spark: SparkSession, side: str, directory: str) -> None:
    """Removes a version that is not to be published."""
    spark.sql(f"DROP TABLE IF EXISTS {side}")
    files.delete_tree(spark, directory)


def publish(spark: SparkSession, side: str, target: str, old_props: dict[str, str] | None,
            props: dict[str, str], directory: str, keep_hours: float = KEEP_HOURS, lease: Lease | None = None) -> str:
    """Put the side table's version in place under the target's name. Returns
    how: ``"set_location"`` or ``"rename"``. ``lease``: the target's, under which
    ``old_props`` were read; it is looked at once more before the catalog changes.

    ``old_props`` are the replaced table's properties (None if there was no
    table). Its directory, if the engine made it, is noted as replaced; those
    noted more than ``keep_hours`` ago are deleted."""
    now = int(time.time() * 1000)
    owned = old_props is not None and old_props.get(catalog.PROP_OWNED) == "true"
    retired = _retired(old_props or {}) if owned else []
    if owned:
        live = catalog.location(spark, target)
        # a driver lost before it moved the location has noted the live directory: it is replaced only now
        retired = [(ms, path) for ms, path in retired if not files.same_path(spark, path, live)] + [(now, live)]
    due = [path for ms, path in retired if now - ms >= keep_hours * 3_600_000]
    left = [(ms, path) for ms, path in retired if path not in due]
    new = {**props, catalog.PROP_OWNED: "true"}
    if left:
        new[catalog.PROP_RETIRED] = "\n".join(f"{ms}|{path}" for ms, path in left)
    if owned and props.get(catalog.PROP_SCHEMA) == old_props.get(catalog.PROP_SCHEMA) is not None:
        shape = catalog.column_shape(spark, target)
        if catalog.is_plain(shape) and shape == catalog.column_shape(spark, side):
            if lease is not None:
                lease.check()
            # notes first: if the driver is lost in between, the live directory is
            # merely noted as replaced, and never deleted while it is the location
            catalog.set_properties(spark, target, new)
            spark.sql(f"ALTER TABLE {target} SET LOCATION {catalog.quote_path(directory)}")
            catalog.unset_properties(spark, target, [k for k in old_props if k.startswith("quarry.") and k not in new])
            spark.sql(f"DROP TABLE {side}")  # external: its files are now the target's
            spark.catalog.refreshTable(target)
            _delete(spark, due, directory)
            return "set_location"
    catalog.set_properties(spark, side, {**new, catalog.PROP_STATE: PUBLISHING})
    if lease is not None:
        lease.check()
    if old_props is not None:
        spark.sql(f"DROP TABLE {target}")
    try:
        _rename(spark, side, target)
    except Exception as exc:
        raise RuntimeError(f"{target} was dropped but the new version could not be renamed into place; its rows "
                           f"are in table {side}, and the next load of {target} puts it in place: {exc}") from exc
    catalog.unset_properties(spark, target, catalog.SIDE_PROPS)
    _delete(spark, due, directory)
    return "rename"


def _delete(spark: SparkSession, due: list[str], live: str) -> None:
    for path in due:
        if _VERSION.fullmatch(path.rstrip("/").rsplit("/", 1)[-1]) and not files.same_path(spark, path, live):
            files.delete_tree(spark, path)
