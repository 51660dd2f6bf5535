"""``load_table``: write the rows of a temp view to a catalog table.

Save modes (L2-L5) as in Spark, plus a create disposition (L6). Every
write that replaces or creates a table goes through the staged write of
:mod:`quarry.sinks.staging`; appends go straight into the table (a failed
append job commits nothing). Day partitions, expiry, clustering and the
required-column guard are applied on both paths.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import time
import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..errors import Checks, StageError, wrap
from ..functions.names import qualify, quote
from ..logs import timed
from ..operators import evolution, layout
from ..sources import catalog, files
from ..streaming.guards import refuse_streaming
from . import expiry, ledger, staging, upkeep

STAGE = "load_table"
SAVE_MODES = ("Append", "ErrorIfExists", "Ignore", "Overwrite")
DISPOSITIONS = ("CREATE_IF_NEEDED", "CREATE_NEVER")
#: A thousand years; beyond it dates run out.
MAX_EXPIRATION_MS = 31_557_600_000_000


class TableExists(RuntimeError):
    pass


class TableMissing(RuntimeError):
    pass


def _mode(save_mode: Any) -> str | None:
    if not isinstance(save_mode, str):
        return None
    for m in SAVE_MODES:
        if save_mode.lower() in (m.lower(), "error" if m == "ErrorIfExists" else m.lower()):
            return m
    return None


def _fields(value: str | Sequence[str] | None) -> list[str]:
    if value is None:
        return []
    if isinstance(value, str):
        return [x.strip() for x in value.split(",") if x.strip()]
    return [str(x).strip() for x in value]


def load_table(
    spark: SparkSession,
    input_view: str,
    table: str,
    *,
    dataset: str | None = None,
    project: str | None = None,
    save_mode: str = "Overwrite",
    create_disposition: str = "CREATE_IF_NEEDED",
    partition_field: str | None = None,
    partition_expiration_ms: int | str | None = None,  # "" drops a recorded one
    as_of: dt.datetime | str | None = None,
    clustered_fields: str | Sequence[str] | None = None,
    allow_field_addition: bool = False,
    allow_field_relaxation: bool = False,
    clustered_ranges: int | None = None,
    required_columns: Sequence[str] | None = None,
    staging_dir: str | None = None,
    load_id: str | None = None,
    id: str | None = None,  # noqa: A002 -- the stage key is called id
    name: str | None = None,
    description: str | None = None,
    params: dict[str, str] | None = None,
) -> DataFrame:
    """Write view ``input_view`` to ``[project.][dataset.]table``.

    ``save_mode``: ``Overwrite`` (default; replaces rows and schema),
    ``Append``, ``Ignore`` (no-op if the table exists) or
    ``ErrorIfExists``. ``create_disposition="CREATE_NEVER"`` refuses to
    create a missing table.

    An overwrite keeps the settings the replaced table records (partition
    field, expiry, clustering, required columns) unless the call gives new
    ones; an empty one (``""`` or ``[]``) drops it, and so does a new schema
    without its columns (the detail's ``droppedSettings`` names those).

    ``load_id`` makes an append happen once: a call with an id that was loaded
    before does nothing (``repeated`` in the detail), also if the driver was lost
    at any point of the call before (:mod:`quarry.sinks.ledger`).

    Any number of threads and drivers may load one table: appends run one after
    the other, versions of an overwrite are written side by side, and one is
    published at a time (:mod:`quarry.sinks.lease`).

    ``partition_field``: a top-level DATE or TIMESTAMP column; the table is
    partitioned by its day (in UTC). ``partition_expiration_ms``: days with
    ``day + ms <= as_of`` (default now, UTC) are left out of the write, and
    dropped after each load. ``clustered_fields``: up to four columns
    (comma-separated or a list); files are range-clustered and sorted on
    them, in as many ranges as the size of the input asks for, or
    ``clustered_ranges``.

    ``required_columns`` are recorded and enforced (a NULL fails the
    write). ``allow_field_addition`` / ``allow_field_relaxation`` let an
    append add nullable columns / make required columns nullable.

    ``staging_dir`` is where new table versions are written (default: the
    database's location); the published table lives there. A replacing
    write is published by one ``SET LOCATION`` (own unpartitioned table,
    same columns) or by drop + rename; the table's own properties and
    comment are kept, and the replaced version's files for a day (see
    :mod:`quarry.sinks.staging`). Appends that add columns to the engine's
    own table write the rows before widening the schema, so a failure
    changes nothing. If something fails after the rows were committed, the
    error's detail has ``committed: True``: do not load them again.

    Returns the input rows: for ``Append``/``Ignore`` the input frame; for
    a write that replaced or created the table, a frame over the written
    table (same rows; safe even when the input was the table itself).
    """
    mode = _mode(save_mode)
    clustered = None if clustered_fields is None else _fields(clustered_fields)
    required = None if required_columns is None else _fields(required_columns)
    chk = Checks(STAGE)
    chk.text("input_view", input_view, required=True)
    chk.text("table", table, required=True)
    chk.text("dataset", dataset)
    chk.text("project", project)
    if partition_field != "":
        chk.text("partition_field", partition_field)
    chk.positive_int("clustered_ranges", clustered_ranges)
    chk.text("staging_dir", staging_dir)
    chk.text("load_id", load_id)
    chk.require(load_id is None or mode == "Append", "load_id needs save_mode Append")
    chk.require(mode is not None, f"save_mode must be one of {list(SAVE_MODES)}, got {save_mode!r}")
    chk.require(create_disposition in DISPOSITIONS,
                f"create_disposition must be one of {list(DISPOSITIONS)}, got {create_disposition!r}")
    chk.boolean("allow_field_addition", allow_field_addition)
    chk.boolean("allow_field_relaxation", allow_field_relaxation)
    expiration = partition_expiration_ms
    if expiration not in (None, ""):
        try:
            expiration = int(partition_expiration_ms)
            chk.require(0 <= expiration <= MAX_EXPIRATION_MS,
                        f"partition_expiration_ms must be from 0 to {MAX_EXPIRATION_MS}, got {expiration}")
        except (TypeError, ValueError):
            chk.require(False, f"partition_expiration_ms must be an integer, got {partition_expiration_ms!r}")
    try:
        expiry.as_utc(as_of)
    except (TypeError, ValueError, AttributeError):
        chk.require(False, f"as_of must be a datetime, date or ISO-8601 text, got {as_of!r}")
    chk.require(len(clustered or []) <= layout.MAX_CLUSTERED_FIELDS,
                f"at most {layout.MAX_CLUSTERED_FIELDS} clustered_fields, got {clustered}")
    chk.raise_if_any()

    detail: dict[str, Any] = {
        "type": "load", "id": id, "name": name or table, "description": description,
        "inputView": input_view, "table": table, "dataset": dataset, "project": project,
        "saveMode": (mode or "").lower(), "createDisposition": create_disposition,
        "partitionField": partition_field, "partitionExpirationMs": expiration,
        "clusteredFields": clustered or [], "allowFieldAddition": allow_field_addition,
        "allowFieldRelaxation": allow_field_relaxation, "intermediateFormat": "parquet", "loadId": load_id,
        "params": dict(params or {}),
    }
    try:
        with timed(detail):
            df = spark.table(input_view)
            refuse_streaming(df, STAGE, input_view)
            target = qualify(table, dataset, project, current=spark.catalog.currentDatabase())
            detail["resolved"] = target
            detail["committed"] = False
            info, found_props = _found(spark, target, detail)
            kind = info.tableType if info else None
            exists = kind is not None
            detail["tableExisted"] = exists

            if not exists and create_disposition == "CREATE_NEVER":
                raise TableMissing(f"{target} does not exist and create_disposition is CREATE_NEVER")
            if exists and mode == "ErrorIfExists":
                raise TableExists(f"{target} already exists (save_mode ErrorIfExists)")
            if exists and mode == "Ignore":
                detail["written"] = False
                return df
            if kind in ("VIEW", "TEMPORARY"):
                raise TypeError(f"{target} is a view; load writes tables only")

            def append() -> dict[str, str]:
                return _append(spark, df, target, catalog.properties(spark, target), partition_field, expiration,
                               clustered, required or [], allow_field_addition, allow_field_relaxation, detail,
                               expiry.as_utc(as_of), clustered_ranges, load_id)

            props, out = None, df
            if exists and mode == "Append":
                with staging.claim(spark, target):
                    if catalog.object_type(spark, target) is not None:
                        props = append()
            if props is None:
                old_props = found_props if mode != "Append" else {}
                staging_root = staging_dir or staging.default_staging_root(spark, target)
                kept = catalog.user_properties(old_props)
                if info is not None and info.description:
                    kept["comment"] = info.description
                side, directory, new = _write_version(
                    spark, df, target, old_props, partition_field, expiration, clustered, required, staging_root,
                    detail, kept, expiry.as_utc(as_of), clustered_ranges, load_id)
                with staging.claim(spark, target) as lease:
                    there = catalog.object_type(spark, target) is not None
                    if there and mode != "Overwrite":  # made by another writer meanwhile
                        staging.discard(spark, side, directory)
                        if mode == "ErrorIfExists":
                            raise TableExists(f"{target} already exists (save_mode ErrorIfExists)")
                        if mode == "Ignore":
                            detail["written"] = False
                            return df
                        props = append()
                    else:
                        now = catalog.properties(spark, target) if there else None
                        for key in (catalog.PROP_UID, catalog.PROP_FIRST_LOAD):
                            if now and key in now:
                                new[key] = now[key]
                        detail["publish"] = staging.publish(spark, side, target, now, new, directory, lease=lease)
                        props, out = new, spark.table(target)
                        if catalog.is_derived(props):
                            out = out.drop(props[catalog.PROP_DAY_COLUMN])
            detail["committed"] = True
            detail["written"] = not detail.get("repeated", False)
            expires = props.get(catalog.PROP_EXPIRATION_MS)
            with staging.claim(spark, target) if expires else contextlib.nullcontext():
                detail["expiredPartitions"] = expiry.expire_partitions(spark, target, as_of, props)
            return out
    except StageError:
        raise
    except Exception as exc:
        raise wrap(STAGE, detail, exc) from exc


def _found(spark: SparkSession, target: str, detail: dict) -> tuple[Any, dict[str, str]]:
    """The target's catalog entry and properties, (None, {}) if there is no such
    table. One that is missing for a moment only, or because a publish broke
    off, is waited for or put in place."""
    while True:
        try:
            info = catalog.table_info(spark, target)
            if info is None:
                if finished := staging.finish_interrupted(spark, target):
                    detail["finishedInterrupted"] = finished
                info = catalog.table_info(spark, target)
                if info is None and not staging.being_published(spark, target):
                    return None, {}
            if info is not None:
                return info, catalog.properties(spark, target) if info.tableType not in ("VIEW", "TEMPORARY") else {}
        except AnalysisException as exc:  # replaced between two look-ups
            if "TABLE_OR_VIEW_NOT_FOUND" not in str(exc):
                raise
        time.sleep(0.05)


def _write_version(spark: SparkSession, df: DataFrame, target: str, old: dict[str, str],
                   partition_field: str | None, expiration: int | str | None, clustered: list[str] | None,
                   required: list[str] | None, staging_root: str, detail: dict, kept: dict[str, str],
                   as_of: dt.datetime, ranges: int | None, load_id: str | None) -> tuple[str, str, dict[str, str]]:
    """Writes a new table version; returns its side table, its directory and the
    properties it is to record.

    ``kept`` are the replaced table's own properties and comment: the rows
    and schema are replaced, the table's description is not. Nor are its
    recorded settings (in ``old``), where the call gives none (None) and the
    new schema has their columns; others go, and the detail names them."""
    props: dict[str, str] = {**kept, catalog.PROP_OWNED: "true",
                             catalog.PROP_UID: old.get(catalog.PROP_UID) or uuid.uuid4().hex}
    if load_id is not None:
        props[catalog.PROP_FIRST_LOAD] = ledger.digest(load_id)
    elif catalog.PROP_FIRST_LOAD in old:
        props[catalog.PROP_FIRST_LOAD] = old[catalog.PROP_FIRST_LOAD]
    if catalog.is_derived(old):  # a frame over the table itself brings the derived column along
        day = next((f for f in df.schema.fields if f.name.lower() == old[catalog.PROP_DAY_COLUMN].lower()), None)
        df = df.drop(day.name) if day is not None and day.dataType.simpleString() == "date" else df
    gone = []
    if partition_field is None and (recorded := old.get(catalog.PROP_PARTITION_FIELD)):
        if layout.can_partition(df, recorded):
            partition_field = recorded
            if expiration is None and old.get(catalog.PROP_EXPIRATION_MS):
                expiration = int(old[catalog.PROP_EXPIRATION_MS])
        else:
            gone.append(f"partition_field {recorded}")
    has = {c.lower() for c in df.columns}
    if clustered is None:
        clustered = catalog.csv(old.get(catalog.PROP_CLUSTERED))
        if not {c.lower() for c in clustered} <= has:
            gone.append(f"clustered_fields {','.join(clustered)}")
            clustered = []
    if required is None:
        recorded = catalog.csv(old.get(catalog.PROP_REQUIRED))
        required = [c for c in recorded if c.lower() in has]
        gone += [f"required column {c}" for c in recorded if c.lower() not in has]
    if gone:
        detail["droppedSettings"] = gone
    day_col = None
    if partition_field:
        df, day_col = layout.day_column(df, partition_field)
        props[catalog.PROP_PARTITION_FIELD] = partition_field
        props[catalog.PROP_DAY_COLUMN] = day_col
    if expiration not in (None, ""):
        if not day_col:
            raise ValueError("partition_expiration_ms needs partition_field")
        props[catalog.PROP_EXPIRATION_MS] = str(expiration)
        df = expiry.unexpired(df, day_col, expiration, as_of)
    clustered = layout.check_clustered(df, clustered)
    if clustered:
        props[catalog.PROP_CLUSTERED] = ",".join(clustered)
    missing = [c for c in required if c.lower() not in {x.lower() for x in df.columns}]
    if missing:
        raise ValueError(f"required_columns not in the input: {missing}")
    if required:
        props[catalog.PROP_REQUIRED] = ",".join(required)
    df = evolution.guard_required(df, required, target)
    df = layout.lay_out(df, day_col, clustered, ranges)
    props[catalog.PROP_SCHEMA] = staging.schema_digest(df)
    side, directory = staging.write_version(spark, df, target, staging_root=staging_root,
                                            partition_cols=[day_col] if day_col else [])
    detail["stagedAt"] = directory
    return side, directory, props


def _append(spark: SparkSession, df: DataFrame, target: str, props: dict[str, str],
            partition_field: str | None, expiration: int | str | None, clustered: list[str] | None,
            required: list[str], allow_add: bool, allow_relax: bool, detail: dict,
            as_of: dt.datetime, ranges: int | None, load_id: str | None) -> dict[str, str]:
    """Insert into the existing table, under its lease, evolving its schema as
    allowed; returns the table's properties after the append."""
    owned = props.get(catalog.PROP_OWNED) == "true"
    entry = None
    if owned and catalog.PROP_UID in props:
        root, at = staging.default_staging_root(spark, target), catalog.location(spark, target)
        upkeep.carry_forward(spark, at)
        for left in ledger.unfinished(spark, root, props[catalog.PROP_UID], at):
            _in_place(spark, target, left, catalog.partition_columns(spark, target))
    spark.catalog.refreshTable(target)  # another session may have moved it
    if load_id is not None:
        if not owned:
            raise ValueError(f"load_id needs a table that the engine made, {target} is not")
        if catalog.PROP_UID not in props:
            props = {**props, catalog.PROP_UID: uuid.uuid4().hex}
            catalog.set_properties(spark, target, {catalog.PROP_UID: props[catalog.PROP_UID]})
        entry = ledger.Entry(spark, staging.default_staging_root(spark, target), props[catalog.PROP_UID],
                             catalog.location(spark, target), ledger.digest(load_id))
        if entry.is_done() or props.get(catalog.PROP_FIRST_LOAD) == ledger.digest(load_id):
            detail["repeated"] = detail["committed"] = True
            return props
    recorded_field = props.get(catalog.PROP_PARTITION_FIELD)
    if partition_field and recorded_field and partition_field.lower() != recorded_field.lower():
        raise ValueError(f"{target} is partitioned by {recorded_field!r}, not {partition_field!r}")
    if partition_field and not recorded_field:
        raise ValueError(f"{target} is not day-partitioned; cannot append with partition_field")
    day_col = props.get(catalog.PROP_DAY_COLUMN)
    if expiration not in (None, "") and not day_col:
        raise ValueError("partition_expiration_ms needs a day-partitioned table")
    if recorded_field and catalog.is_derived(props):
        df, _ = layout.day_column(df, recorded_field, day_col)
    if day_col:
        recorded_ms = props.get(catalog.PROP_EXPIRATION_MS)
        keeps = expiration if expiration is not None else int(recorded_ms) if recorded_ms else None
        df = expiry.unexpired(df, day_col, None if keeps == "" else keeps, as_of)
    part_cols = catalog.partition_columns(spark, target)
    current = spark.table(target).schema
    plan = evolution.plan_append(current, part_cols, df, catalog.csv(props.get(catalog.PROP_REQUIRED)),
                                 allow_add, allow_relax, required)

    aligned = df.select(*plan.columns)
    aligned = evolution.guard_required(aligned, plan.still_required, target)
    clustered = layout.check_clustered(aligned, clustered or catalog.csv(props.get(catalog.PROP_CLUSTERED)))
    aligned = layout.lay_out(aligned, day_col, clustered, ranges)

    grown = bool(plan.added or plan.widened)
    if grown:
        detail["addedColumns"] = [f.name for f in plan.added]
        detail["widenedColumns"] = sorted(plan.widened)
        if plan.widened and not owned:
            raise evolution.SchemaMismatch(f"{sorted(plan.widened)} gain fields, which needs a table that the engine "
                                           f"made; {target} is not")
    if entry is not None:
        entry.write(aligned, part_cols)
        _grow(spark, target, plan)
        entry.commit()
        detail["committed"] = True
        _in_place(spark, target, entry, part_cols)
    elif grown and owned:
        # The engine's own parquet table: write the rows first (visible
        # only when the job commits), then widen the schema, so a failed
        # job changes neither the rows nor the schema.
        location = catalog.location(spark, target)
        w = aligned.write.mode("append").format("parquet")
        if part_cols:
            w = w.partitionBy(*part_cols)
        w.save(location)
        detail["committed"] = True
        _grow(spark, target, plan)
        _tell_catalog(spark, target, location, part_cols)
    else:
        _grow(spark, target, plan)
        aligned.write.insertInto(target, overwrite=False)
    detail["committed"] = True

    new_props = {}
    if set(plan.still_required) != set(catalog.csv(props.get(catalog.PROP_REQUIRED))) or required:
        new_props[catalog.PROP_REQUIRED] = ",".join(plan.still_required)
    if plan.relaxed:
        detail["relaxedColumns"] = plan.relaxed
    if expiration not in (None, ""):
        new_props[catalog.PROP_EXPIRATION_MS] = str(expiration)
    if grown:
        # another shape than the one recorded: the next overwrite compares anew
        catalog.unset_properties(spark, target, [catalog.PROP_SCHEMA])
    catalog.set_properties(spark, target, new_props)
    spark.catalog.refreshTable(target)
    return {**props, **new_props}


def _grow(spark: SparkSession, target: str, plan: evolution.AppendPlan) -> None:
    """Gives the table the columns, and its columns the fields, that the plan adds."""
    if plan.widened:
        catalog.widen_columns(spark, target, plan.widened)
    if plan.added:
        cols = ", ".join(f"{quote(f.name)} {evolution.ddl_type(f)}" for f in plan.added)
        spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({cols})")


def _in_place(spark: SparkSession, target: str, entry: ledger.Entry, part_cols: list[str]) -> None:
    """Carries a committed load forward to where readers see it."""
    entry.carry_forward()
    _tell_catalog(spark, target, entry.location, part_cols)
    entry.finish()


def _tell_catalog(spark: SparkSession, target: str, location: str, part_cols: list[str]) -> None:
    """The catalog doesn't know of rows written by path."""
    if part_cols:
        _register_new_days(spark, target, location, part_cols[0])
    if catalog.has_statistics(spark, target):
        # a planner that believes the old size broadcasts what is too large
        spark.sql(f"ANALYZE TABLE {target} COMPUTE STATISTICS NOSCAN")


def _register_new_days(spark: SparkSession, target: str, location: str, day_col: str) -> None:
    """Add the day folders that the catalog does not list yet: one entry per
    day is compared, the files in them are not listed."""
    listed = {r[0] for r in spark.sql(f"SHOW PARTITIONS {target}").collect()}
    new = [n for n in files.list_children(spark, location) if n.startswith(f"{day_col}=") and n not in listed]
    specs = []
    for n in new:
        day = n.split("=", 1)[1]
        specs.append(f"PARTITION ({quote(day_col)} = " + ("NULL" if day == "__HIVE_DEFAULT_PARTITION__"
                                                          else f"DATE'{day}'") + ")")
    if specs:
        spark.sql(f"ALTER TABLE {target} ADD IF NOT EXISTS {' '.join(specs)}")
