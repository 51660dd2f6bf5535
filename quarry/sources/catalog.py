"""Catalog look-ups: object type, properties, location, partition columns.

All of these read catalog metadata only; none scans table data.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql.types import DataType, StructField, StructType

from ..functions.names import parts_of, quote

# Fixed table-property keys the engine records on the tables it writes.
PROP_OWNED = "quarry.owned"                      # engine made the location, may delete it
PROP_SCHEMA = "quarry.schema_digest"             # of names, types and column metadata
PROP_RETIRED = "quarry.replaced_versions"        # time|directory of versions not yet deleted
PROP_PARTITION_FIELD = "quarry.partition_field"  # user's date/timestamp field
PROP_DAY_COLUMN = "quarry.day_column"            # physical partition column
PROP_EXPIRATION_MS = "quarry.partition_expiration_ms"
PROP_CLUSTERED = "quarry.clustered_fields"
PROP_REQUIRED = "quarry.required_columns"
PROP_EXPIRES_AT = "quarry.expires_at"             # materialised view results
PROP_SIDE_OF = "quarry.side_of"                  # of a side table: its full target
PROP_STARTED = "quarry.started"                  # when its write began, ms
PROP_WRITER = "quarry.writer"                    # the application that writes it
PROP_STATE = "quarry.state"                      # writing, or publishing (it may be the only copy)
SIDE_PROPS = [PROP_SIDE_OF, PROP_STARTED, PROP_WRITER, PROP_STATE]
PROP_UID = "quarry.table_uid"                    # stays with the table through overwrites
PROP_FIRST_LOAD = "quarry.first_load"            # digest of the load id that made the table
DERIVED_DAY = "__day"


def is_derived(props: dict[str, str]) -> bool:
    """Whether the table's day column was derived from its partition field."""
    day, field = props.get(PROP_DAY_COLUMN), props.get(PROP_PARTITION_FIELD)
    return bool(day) and day.lower() != (field or "").lower()


def table_info(spark: SparkSession, name: str):
    """The catalog's ``Table`` entry, or None if there is no such object."""
    try:
        return spark.catalog.getTable(name)
    except AnalysisException as exc:
        if "NOT_FOUND" in str(exc) or "not found" in str(exc).lower():
            return None
        raise


def object_type(spark: SparkSession, name: str) -> str | None:
    """``MANAGED``, ``EXTERNAL``, ``VIEW``, ``TEMPORARY`` or None if absent."""
    info = table_info(spark, name)
    return info.tableType if info else None


# Properties Spark reserves or manages itself.
_RESERVED = {"owner", "provider", "location", "comment", "external", "is_managed_location"}


def user_properties(props: dict[str, str]) -> dict[str, str]:
    """Properties a user set, which an overwrite must keep."""
    return {k: v for k, v in props.items()
            if not k.startswith(("quarry.", "spark.", "transient_")) and k not in _RESERVED}


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {r["key"]: r["value"] for r in rows}


def location(spark: SparkSession, name: str) -> str | None:
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect():
        if r["col_name"] == "Location":
            return r["data_type"]
    return None


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    """Partition columns, from ``DESCRIBE`` (catalog metadata only)."""
    out, section = [], None
    for r in spark.sql(f"DESCRIBE TABLE {name}").collect():
        col = str(r["col_name"])
        if col.startswith("#"):
            section = col if col != "# col_name" else section
            continue
        if section == "# Partition Information" and col:
            out.append(col)
    return out


def set_properties(spark: SparkSession, name: str, props: dict[str, str]) -> None:
    if not props:
        return
    body = ", ".join(f"'{k}' = '{_esc(v)}'" for k, v in props.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({body})")


def unset_properties(spark: SparkSession, name: str, keys: list[str]) -> None:
    if keys:
        body = ", ".join(f"'{_esc(k)}'" for k in keys)
        spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ({body})")


def widen_columns(spark: SparkSession, name: str, kinds: dict[str, DataType]) -> None:
    """Sets the types of columns to ones with more fields inside. SQL has no command
    for it on parquet tables; the session catalog has. Files written before read
    NULL for fields that they lack."""
    session = spark._jsparkSession.sessionState()
    table = session.sqlParser().parseTableIdentifier(".".join(quote(p) for p in parts_of(name)[-2:]))
    fields = [StructField(f.name, kinds.get(f.name, f.dataType), f.nullable, f.metadata)
              for f in spark.table(name).schema.fields if f.name not in set(partition_columns(spark, name))]
    schema = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(StructType(fields).json())
    session.catalog().alterTableDataSchema(table, schema)
    spark.catalog.refreshTable(name)


def column_shape(spark: SparkSession, name: str) -> list[tuple]:
    """Name, type and comment of each column, plus any partition or bucket
    section, as ``DESCRIBE`` reports them: catalog metadata only, no file
    listing (``listColumns`` resolves the table, which lists its files)."""
    return [(r["col_name"], r["data_type"], r["comment"])
            for r in spark.sql(f"DESCRIBE TABLE {name}").collect()]


def is_plain(shape: list[tuple]) -> bool:
    """No partition or bucket section in a ``DESCRIBE`` result."""
    return not any(str(c[0]).startswith("#") for c in shape)


def has_statistics(spark: SparkSession, name: str) -> bool:
    return any(r["col_name"] == "Statistics" for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect())


def quote_path(path: str) -> str:
    return "'" + _esc(path) + "'"


def _esc(v: str) -> str:
    return str(v).replace("\\", "\\\\").replace("'", "\\'")


def csv(value: str | None) -> list[str]:
    return [x for x in (value or "").split(",") if x]
