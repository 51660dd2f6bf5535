"""Loads that are appended once, however often they are tried.

The rows of a load with an id are first written to a folder of their own inside
the table's directory, where readers don't look. Renaming that folder from
``.writing`` to ``.ready`` commits the load, in one step: what fails before it
leaves nothing, and from then on the load is only ever carried forward. Its
files are moved into place one by one (each has a name of its own, so that
moving can be taken up again anywhere), the id is entered in the ledger, and
the folder goes. A driver that is lost in between leaves the folder; the next
append to the table, or the retry itself, carries it forward. The ledger has an
entry per id, beside the table's directories, under an id that the table keeps
when it is overwritten and loses when it is dropped.

All of this runs under the table's lease.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from ..sources import files

FOLDER = "_quarry_loads"


class Entry:
    """One load of one table."""

    def __init__(self, spark: SparkSession, root: str, table_uid: str, location: str, load: str):
        self.spark, self.location = spark, location.rstrip("/")
        self.writing = f"{self.location}/{FOLDER}/{load}.writing"
        self.ready = f"{self.location}/{FOLDER}/{load}.ready"
        self.entry = f"{root.rstrip('/')}/_quarry_ledger/{table_uid}/{load}"

    def is_done(self) -> bool:
        return files.exists(self.spark, self.entry)

    def is_ready(self) -> bool:
        return files.exists(self.spark, self.ready)

    def write(self, rows: DataFrame, partition_cols: list[str]) -> None:
        files.delete_tree(self.spark, self.writing)  # what an earlier try left
        writer = rows.write.mode("errorifexists")
        (writer.partitionBy(*partition_cols) if partition_cols else writer).parquet(self.writing)

    def commit(self) -> None:
        if not files.rename(self.spark, self.writing, self.ready):
            raise RuntimeError(f"{self.writing} could not be renamed")

    def carry_forward(self) -> None:
        """Moves what is not yet in place; then the load is done."""
        for name in files.data_files(self.spark, self.ready):
            target = f"{self.location}/{name}"
            files.make_dirs(self.spark, target.rsplit("/", 1)[0])
            if not files.rename(self.spark, f"{self.ready}/{name}", target):
                raise RuntimeError(f"{self.ready}/{name} could not be moved to {target}")

    def finish(self) -> None:
        files.create_exclusive(self.spark, self.entry, "")
        files.delete_tree(self.spark, self.ready)


def digest(load_id: str) -> str:
    return hashlib.sha256(load_id.encode()).hexdigest()[:32]


def unfinished(spark: SparkSession, root: str, table_uid: str, location: str) -> list[Entry]:
    """Committed loads of the table that are not all in place."""
    names = files.list_children(spark, f"{location.rstrip('/')}/{FOLDER}")
    return [Entry(spark, root, table_uid, location, n.removesuffix(".ready")) for n in names if n.endswith(".ready")]
