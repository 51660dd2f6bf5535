"""Column metadata from a file (X7) or a view (X8).

The input is a list of ``(name, metadata)`` pairs, one per column, e.g.
JSON lines ``{"name": "o_orderkey", "metadata": {"description": "order key"}}``.
``metadata`` may be a JSON object or its text; a top-level ``description``
is folded into it. The list only *adds* metadata: it does not cast, select
or reorder columns. Columns it does not name stay as they are; a name the
frame does not have is an error.

The list has one row per column, so it is small by construction; it is the
only thing brought to the driver.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.columns import col
from . import files


def read_metadata_file(spark: SparkSession, uri: str) -> list[tuple[str, dict]]:
    """JSON lines, or one JSON array, at any Hadoop URI (a small config file)."""
    blob = files.read_small_text(spark, uri).strip()
    if blob.startswith("["):
        entries = json.loads(blob)
    else:
        entries = [json.loads(line) for line in blob.splitlines() if line.strip()]
    rows = []
    for e in entries:
        md = e.get("metadata")
        rows.append({"name": e.get("name"),
                     "metadata": md if isinstance(md, str) or md is None else json.dumps(md),
                     "description": e.get("description")})
    return _to_pairs(rows)


def read_metadata_view(spark: SparkSession, view: str, columns: int) -> list[tuple[str, dict]]:
    """One row per column at most: a view with more than ``columns`` rows is refused, not collected."""
    df = spark.table(view)
    if "metadata" in df.columns and not isinstance(df.schema["metadata"].dataType, StringType):
        df = df.withColumn("metadata", F.to_json("metadata"))
    if "description" not in df.columns:
        df = df.withColumn("description", F.lit(None).cast("string"))
    rows = df.select("name", "metadata", "description").limit(columns + 1).collect()
    if len(rows) > columns:
        raise ValueError(f"{view} has more rows than the table has columns ({columns}): it is no column metadata")
    return _to_pairs(r.asDict() for r in rows)


def _to_pairs(rows) -> list[tuple[str, dict]]:
    out = []
    for row in rows:
        if row["name"] is None:
            raise ValueError("column metadata entry without a name")
        md = json.loads(row["metadata"]) if row["metadata"] else {}
        if not isinstance(md, dict):
            raise ValueError(f"metadata of column {row['name']!r} is not a JSON object")
        if row["description"] is not None:
            md.setdefault("description", row["description"])
        out.append((row["name"], md))
    return out


def attach_metadata(df: DataFrame, pairs: list[tuple[str, dict]]) -> DataFrame:
    """Merge each entry into its column's existing metadata (new keys win).

    Names match as Spark resolves them (case-insensitively). One projection
    for all columns, so a wide table costs one plan node, not one per column.
    """
    by_name = {f.name.lower(): f for f in df.schema.fields}
    missing = [n for n, _ in pairs if n.lower() not in by_name]
    if missing:
        raise ValueError(f"metadata names columns the table does not have: {missing}")
    extra: dict[str, dict] = {}
    for name, md in pairs:
        extra.setdefault(name.lower(), {}).update(md)
    cols = []
    for f in df.schema.fields:
        c = col(f.name)
        if f.name.lower() in extra:
            c = c.alias(f.name, metadata={**f.metadata, **extra[f.name.lower()]})
        cols.append(c)
    return df.select(*cols)


def column_descriptions(df: DataFrame) -> list[tuple[str, str]]:
    """(column, description) for each column that has one, in schema order."""
    return [(f.name, f.metadata["description"]) for f in df.schema.fields
            if "description" in f.metadata]
