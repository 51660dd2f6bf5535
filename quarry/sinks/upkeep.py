"""Upkeep of a clustered table (L10): only what overlaps is written anew.

A clustered load writes files with disjoint ranges of the clustered columns, so
that a filter on them skips whole files; appends add files over the same
ranges. :func:`recluster` finds the files whose ranges overlap, rewrites those,
and leaves all others as they are, name and all.

1. Each file's range: one aggregate by file over the clustered columns alone
   (exact for any type, where footers cut long strings off).
2. Files that overlap, directly or through others, are one component: in order
   of their starts, a file whose start is not before the greatest end so far
   begins a new one. That goes over one row per file.
3. The rows of components of two files or more are range-partitioned and sorted
   by (component, clustered columns), and each component is written to a folder
   of its own, so a new file never spans a file that stays.
4. The new files are written to a hidden folder inside the table's directory,
   with a list of the files they replace. Renaming that folder commits; from
   then on the swap is only carried forward: replaced files are moved out, new
   ones in, then the replaced ones are deleted. A driver lost in between leaves
   the folder, and the next append or :func:`recluster` carries it forward.

The whole runs under the table's lease. While files are moved, a reader that
lists the table can miss rows, and one that has listed it can miss a file: run
it when the table is not read.
"""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import StageError, wrap
from ..functions.columns import col
from ..functions.names import qualify
from ..logs import timed
from ..operators import layout
from ..sources import catalog, files
from . import staging

STAGE = "recluster"
FOLDER = "_quarry_recluster"
MANIFEST = "_replaced"
#: A list of so many file names is broadcast to the rows: some 20 MB.
BROADCAST_FILES = 100_000
_COMPONENT = "__quarry_component"


def recluster(spark: SparkSession, table: str, *, dataset: str | None = None, project: str | None = None) -> dict[str, Any]:
    """Rewrites the overlapping files of a table that ``load_table`` clustered.
    Returns ``{"files": ..., "overlapping": files rewritten, "components": ...}``."""
    detail: dict[str, Any] = {"type": "recluster", "table": table, "dataset": dataset, "project": project}
    try:
        with timed(detail):
            target = qualify(table, dataset, project, current=spark.catalog.currentDatabase())
            detail["resolved"] = target
            with staging.claim(spark, target):
                props = catalog.properties(spark, target)
                keys = catalog.csv(props.get(catalog.PROP_CLUSTERED))
                if props.get(catalog.PROP_OWNED) != "true" or not keys:
                    raise ValueError(f"{target} is not a clustered table that the engine made")
                location = catalog.location(spark, target)
                carry_forward(spark, location)
                spark.catalog.refreshTable(target)
                days = catalog.partition_columns(spark, target)
                ranges = file_ranges(spark.table(target), keys, days)
                moved = overlapping(ranges).collect()  # names of files, no rows of the table
                found = {"files": ranges.count(), "overlapping": len(moved),
                         "components": len({r["component"] for r in moved})}
                if moved:
                    _rewrite(spark, target, location, keys, days, [(r["file"], r["component"]) for r in moved])
                    spark.catalog.refreshTable(target)
            detail.update(found)
            return found
    except StageError:
        raise
    except Exception as exc:
        raise wrap(STAGE, detail, exc) from exc


def file_ranges(df: DataFrame, keys: list[str], days: list[str]) -> DataFrame:
    """(file, day, lo, hi) of every file of a table; lo and hi are structs of the
    clustered columns. Partial results are one row per file and task."""
    place = F.struct(*[col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    day = col(days[0]).cast("string") if days else F.lit(None).cast("string")
    return (df.select(F.col("_metadata.file_path").alias("file"), day.alias("day"), place.alias("place"))
            .groupBy("file", "day").agg(F.min("place").alias("lo"), F.max("place").alias("hi")))


def overlapping(ranges: DataFrame) -> DataFrame:
    """(file, component) of the files that overlap another of their day. Ranges that
    only touch, as those of a hot key split over files do, don't overlap."""
    order = Window.partitionBy("day").orderBy("lo", "hi", "file")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(F.col("lo") >= F.max("hi").over(before), F.lit(True)).cast("int")
    numbered = ranges.withColumn("begins", begins).withColumn("number", F.sum("begins").over(order))
    size = F.count("*").over(Window.partitionBy("day", "number"))
    shared = numbered.withColumn("size", size).where("size > 1")
    return shared.select("file", F.dense_rank().over(Window.orderBy("day", "number")).alias("component"))


def _rewrite(spark: SparkSession, target: str, location: str, keys: list[str], days: list[str],
             moved: list[tuple[str, int]]) -> None:
    names = spark.createDataFrame(moved, "file string, component int")
    schema = spark.table(target).schema
    old = spark.read.schema(schema).option("basePath", location).parquet(*[f for f, _ in moved])
    rows = old.withColumn("__file", F.col("_metadata.file_path"))
    names = names.select(F.col("file").alias("__file"), F.col("component").alias(_COMPONENT))
    rows = rows.join(F.broadcast(names) if len(moved) <= BROADCAST_FILES else names, "__file") \
        .select(*[col(c) for c in schema.names], _COMPONENT)
    ranges = -(-layout.estimated_bytes(old) // layout.advisory_bytes(old))
    laid = layout.lay_out(rows, None, [_COMPONENT, *keys], max(1, ranges))
    home = f"{location.rstrip('/')}/{FOLDER}"
    writing = f"{home}/{uuid.uuid4().hex}.writing"
    laid.write.partitionBy(*days, _COMPONENT).parquet(writing)
    root = files.qualified(spark, location)
    files.write_text(spark, f"{writing}/{MANIFEST}", "\n".join(_below(spark, root, f) for f, _ in moved))
    _commit(spark, writing)
    carry_forward(spark, location)


def _commit(spark: SparkSession, writing: str) -> None:
    if not files.rename(spark, writing, writing.removesuffix(".writing") + ".ready"):
        raise RuntimeError(f"{writing} could not be renamed")


def carry_forward(spark: SparkSession, location: str) -> None:
    """Ends swaps that were committed and not finished; drops what was not committed."""
    home = f"{location.rstrip('/')}/{FOLDER}"
    for name in files.list_children(spark, home):
        if name.endswith(".ready"):
            _swap(spark, location.rstrip("/"), f"{home}/{name}")
        else:
            files.delete_tree(spark, f"{home}/{name}")


def _swap(spark: SparkSession, location: str, ready: str) -> None:
    for name in files.read_if_there(spark, f"{ready}/{MANIFEST}").split("\n"):
        if files.exists(spark, f"{location}/{name}"):
            files.make_dirs(spark, f"{ready}/_old/{name}".rsplit("/", 1)[0])
            _move(spark, f"{location}/{name}", f"{ready}/_old/{name}")
    for name in files.data_files(spark, ready):
        *folders, component, file = name.split("/")
        # a task that wrote several components gave their files one name
        _move(spark, f"{ready}/{name}", "/".join([location, *folders, f"{component.split('=')[1]}-{file}"]))
    files.delete_tree(spark, ready)


def _move(spark: SparkSession, source: str, target: str) -> None:
    files.make_dirs(spark, target.rsplit("/", 1)[0])
    if not files.rename(spark, source, target):
        raise RuntimeError(f"{source} could not be moved to {target}")


def _below(spark: SparkSession, root: str, path: str) -> str:
    """A file's name below the table's directory, as ``_metadata`` spells paths."""
    full = files.qualified(spark, path)
    if not full.startswith(root + "/"):
        raise ValueError(f"{path} does not lie in {root}")
    return full[len(root) + 1:]
