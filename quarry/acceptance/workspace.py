"""Per-query isolation: a fresh database in the shared scratch folder, and
catalog tables over the given parquet files.

The source tables are *external* tables over the given files: registering
them reads only parquet footers, copies nothing, and dropping them leaves
the files alone. They are only ever read.
"""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..functions.names import quote
from ..session import fresh_dir, scratch_root

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


_REGISTERED: set[tuple[str, str]] = set()


def absolute(path: str) -> str:
    """A local path without a scheme made absolute; URIs are left alone."""
    path = path.rstrip("/")
    if "://" in path or path.startswith("file:"):
        return path
    return os.path.abspath(path)


def source_database(spark: SparkSession, sf_dir: str) -> str:
    """Database holding one external table per given parquet table.

    Registered once per application; later calls only check the database."""
    sf_dir = absolute(sf_dir)
    db = "quarry_src_" + hashlib.sha1(sf_dir.encode()).hexdigest()[:12]
    key = (spark.sparkContext.applicationId, db)
    if key in _REGISTERED and spark.catalog.databaseExists(db):
        return db
    if not spark.catalog.databaseExists(db):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} "
                  f"LOCATION '{scratch_root(spark)}/quarry/{db}'")
    for t in TABLES:
        if not spark.catalog.tableExists(f"{db}.{t}"):
            spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{t} USING parquet "
                      f"LOCATION '{sf_dir}/{t}.parquet'")
    _REGISTERED.add(key)
    return db


class Workspace:
    """A fresh database (and folder) for one run of one query."""

    def __init__(self, spark: SparkSession, sf_dir: str, label: str):
        self.spark = spark
        self.sf_dir = absolute(sf_dir)
        self.src = source_database(spark, self.sf_dir)
        self.dir = fresh_dir(spark, label)
        self.db = f"q_{label}_{uuid.uuid4().hex[:10]}"
        spark.sql(f"CREATE DATABASE {quote(self.db)} LOCATION '{self.dir}/db'")

    def source(self, table: str) -> str:
        return f"{self.src}.{table}"

    def table(self, table: str) -> str:
        return f"{self.db}.{table}"

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.source(table))

    def view(self, df: DataFrame, label: str) -> str:
        """Register ``df`` under a fresh temp-view name and return the name."""
        name = f"{self.db}__{label}"
        df.createOrReplaceTempView(name)
        return name
