"""Acceptance queries for extract (X1-X8, D1-D7, T1).

Each takes ``(spark, sf_dir)``, works in a fresh workspace over the given
tables and returns a lazy DataFrame. Where a refusal is part of the
behaviour, the query raises if the refusal does not happen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import extract_table, load_table
from ..errors import StageError
from ..sources import files
from ..sources.extract import ViewsNotEnabled
from ..sources.metadata import column_descriptions
from .workspace import Workspace

# The column descriptions the metadata queries attach.
ORDER_DESCRIPTIONS = [("o_orderkey", "order key"), ("o_custkey", "customer key")]


def extract_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "extract_scan")
    return extract_table(spark, "orders", dataset=ws.src, output_view=f"{ws.db}__orders").df


def extract_qualified(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "extract_qualified")
    spark.sql(f"CREATE TABLE {ws.table('customer')} USING parquet "
              f"LOCATION '{ws.sf_dir}/customer.parquet'")
    return extract_table(spark, "customer", dataset=ws.db, project="spark_catalog").df


def extract_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem in many files (at least 16, about 128 MB each at scale), read
    with at most 2 partitions."""
    ws = Workspace(spark, sf_dir, "extract_capped")
    n_files = max(16, files.total_bytes(spark, f"{ws.sf_dir}/lineitem.parquet") // (128 << 20) + 1)
    ws.read("lineitem").repartition(n_files).write.saveAsTable(ws.table("lineitem16"))
    df = extract_table(spark, "lineitem16", dataset=ws.db, max_parallelism=2).df
    return (df.withColumn("pid", F.spark_partition_id())
              .agg(F.count("*").alias("n_rows"), (F.countDistinct("pid") <= 2).alias("within_cap")))


def _spend_view(spark: SparkSession, ws: Workspace) -> str:
    # A persistent view may not refer to temp views: it is over a catalog table.
    spark.sql(f"CREATE VIEW {ws.table('customer_spend')} AS SELECT o_custkey, count(*) AS n_orders, "
              f"sum(o_totalprice) AS spend FROM {ws.source('orders')} GROUP BY o_custkey")
    try:
        extract_table(spark, "customer_spend", dataset=ws.db)
    except StageError as exc:
        if not isinstance(exc.__cause__, ViewsNotEnabled):
            raise
    else:
        raise AssertionError("a view was read without views_enabled")
    return "customer_spend"


def extract_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "extract_view")
    view = _spend_view(spark, ws)
    return extract_table(spark, view, dataset=ws.db, views_enabled=True).df


def extract_view_materialized(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "extract_view_mat")
    view = _spend_view(spark, ws)
    r = extract_table(spark, view, dataset=ws.db, views_enabled=True,
                      view_materialization_dataset=ws.db)
    if "materializedAs" not in r.detail:
        raise AssertionError("view was not materialised")
    return r.df


def extract_view_reused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view read three times: its table serves the second read, and after an
    append to the view's source a new one is made."""
    ws = Workspace(spark, sf_dir, "extract_view_reused")
    ws.read("orders").where("o_orderstatus = 'F'").write.saveAsTable(ws.table("source"))
    spark.sql(f"CREATE VIEW {ws.table('by_customer')} AS SELECT o_custkey, count(*) AS n_orders "
              f"FROM {ws.table('source')} GROUP BY o_custkey")

    def read():
        return extract_table(spark, "by_customer", dataset=ws.db, views_enabled=True, view_materialization_dataset=ws.db)

    reused = [read().detail.get("materializationReused", False) for _ in range(2)]
    ws.read("orders").where("o_orderstatus <> 'F'").write.insertInto(ws.table("source"))
    last = read()
    reused.append(last.detail.get("materializationReused", False))
    return last.df.withColumn("reused", F.lit(",".join(map(str, reused))))


def extract_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and nulls counted while the first action runs: a table write."""
    ws = Workspace(spark, sf_dir, "extract_observed")
    ws.read("documents").join(ws.read("labels"), "doc_id", "left").select("doc_id", "lang", "quality", "toxic") \
        .write.saveAsTable(ws.table("labelled"))
    r = extract_table(spark, "labelled", dataset=ws.db, output_view=f"{ws.db}__seen", observe=True,
                      observe_nulls=["quality", "lang"])
    load_table(spark, f"{ws.db}__seen", "copied", dataset=ws.db)
    seen = r.observed()
    return extract_table(spark, "copied", dataset=ws.db).df.select(
        "doc_id", "quality", F.lit(seen["records"]).alias("records"), F.lit(seen["nulls"]["quality"]).alias("no_quality"),
        F.lit(seen["nulls"]["lang"]).alias("no_lang"))


def extract_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "extract_count")
    return extract_table(spark, "lineitem", dataset=ws.src).df.agg(F.count("*").alias("n_rows"))


def _named_by_description(df: DataFrame) -> DataFrame:
    """The rows, each column that has a description under that as its name."""
    return df.withColumnsRenamed(dict(column_descriptions(df)))


def extract_metadata_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata from a JSON-lines file; kept through a table write and read."""
    ws = Workspace(spark, sf_dir, "extract_md_file")
    path = f"{ws.dir}/orders_columns.json"
    files.write_text(spark, path, "".join(
        '{"name": "%s", "metadata": {"description": "%s"}}\n' % pair for pair in ORDER_DESCRIPTIONS))
    r = extract_table(spark, "orders", dataset=ws.src, schema_uri=path, output_view=f"{ws.db}__orders")
    load_table(spark, f"{ws.db}__orders", "orders_described", dataset=ws.db)
    back = extract_table(spark, "orders_described", dataset=ws.db).df
    if column_descriptions(back) != column_descriptions(r.df):
        raise AssertionError("column metadata lost in the write")
    return _named_by_description(back)


def extract_metadata_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata from a view of (name, metadata text); kept through filter,
    select, a table write and its read-back."""
    ws = Workspace(spark, sf_dir, "extract_md_view")
    md = spark.createDataFrame([(n, '{"description": "%s"}' % d) for n, d in ORDER_DESCRIPTIONS],
                               "name string, metadata string")
    md_view = ws.view(md, "columns")
    df = extract_table(spark, "orders", dataset=ws.src, schema_view=md_view).df
    shaped = df.filter(F.col("o_orderstatus") != "P").select(*reversed(df.columns))
    load_table(spark, ws.view(shaped, "shaped"), "orders_shaped", dataset=ws.db)
    return _named_by_description(extract_table(spark, "orders_shaped", dataset=ws.db).df)


def _partitions_per_key(df: DataFrame, key: str) -> DataFrame:
    return (df.withColumn("pid", F.spark_partition_id())
              .groupBy(key).agg(F.count("*").alias("n_rows"), F.countDistinct("pid").alias("n_parts")))


def repartition_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "repartition_n")
    df = extract_table(spark, "lineitem", dataset=ws.src, num_partitions=8).df
    return (df.withColumn("pid", F.spark_partition_id())
              .agg(F.count("*").alias("n_rows"), F.countDistinct("pid").alias("n_parts")))


def repartition_n_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "repartition_n_cols")
    df = extract_table(spark, "lineitem", dataset=ws.src, num_partitions=8, partition_by=["l_orderkey"]).df
    return _partitions_per_key(df, "l_orderkey")


def repartition_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "repartition_cols")
    df = extract_table(spark, "lineitem", dataset=ws.src, partition_by=["l_orderkey"]).df
    return _partitions_per_key(df, "l_orderkey")


def view_immutable(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "view_immutable")
    view = f"{ws.db}__orders"
    extract_table(spark, "orders", dataset=ws.src, output_view=view, immutable_view=True)
    raised = False
    try:
        extract_table(spark, "customer", dataset=ws.src, output_view=view, immutable_view=True)
    except StageError:
        raised = True
    return spark.table(view).agg(F.lit(raised).alias("raised"), F.count("*").alias("n_rows"))


def persist_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "persist_records")
    r = extract_table(spark, "orders", dataset=ws.src, persist=True, output_view=f"{ws.db}__orders")
    cached = r.df.storageLevel.useMemory
    r.df.unpersist()
    return ws.read("orders").agg(F.count("*").alias("n_rows"), F.lit(r.stats["records"]).alias("records"),
                                 F.lit(cached).alias("cached"),
                                 F.lit(r.stats["output_columns"]).cast("int").alias("output_columns"))


QUERIES = {
    "extract_scan": extract_scan,
    "extract_qualified": extract_qualified,
    "extract_capped": extract_capped,
    "extract_view": extract_view,
    "extract_view_materialized": extract_view_materialized,
    "extract_view_reused": extract_view_reused,
    "extract_observed": extract_observed,
    "extract_count": extract_count,
    "extract_metadata_file": extract_metadata_file,
    "extract_metadata_view": extract_metadata_view,
    "repartition_n": repartition_n,
    "repartition_n_cols": repartition_n_cols,
    "repartition_cols": repartition_cols,
    "view_immutable": view_immutable,
    "persist_records": persist_records,
}

ORACLE = {
    "extract_scan": "SELECT * FROM orders",
    "extract_qualified": "SELECT * FROM customer",
    "extract_capped": "SELECT count(*) AS n_rows, TRUE AS within_cap FROM lineitem",
    "extract_view": "SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS spend FROM orders GROUP BY o_custkey",
    "extract_view_materialized": "SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS spend FROM orders GROUP BY o_custkey",
    "extract_view_reused": "SELECT o_custkey, count(*) AS n_orders, 'False,True,False' AS reused FROM orders GROUP BY o_custkey",
    "extract_observed": "SELECT doc_id, quality, count(*) OVER () AS records, count(*) FILTER (quality IS NULL) OVER () AS no_quality, count(*) FILTER (lang IS NULL) OVER () AS no_lang FROM documents LEFT JOIN labels USING (doc_id)",
    "extract_count": "SELECT count(*) AS n_rows FROM lineitem",
    "extract_metadata_file": "SELECT o_orderkey AS \"order key\", o_custkey AS \"customer key\", * EXCLUDE (o_orderkey, o_custkey) FROM orders",
    "extract_metadata_view": "SELECT o_orderkey AS \"order key\", o_custkey AS \"customer key\", * EXCLUDE (o_orderkey, o_custkey) FROM orders WHERE o_orderstatus <> 'P'",
    "repartition_n": "SELECT count(*) AS n_rows, CAST(8 AS BIGINT) AS n_parts FROM lineitem",
    "repartition_n_cols": "SELECT l_orderkey, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_parts FROM lineitem GROUP BY l_orderkey",
    "repartition_cols": "SELECT l_orderkey, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_parts FROM lineitem GROUP BY l_orderkey",
    "view_immutable": "SELECT TRUE AS raised, count(*) AS n_rows FROM orders",
    "persist_records": "SELECT count(*) AS n_rows, count(*) AS records, TRUE AS cached, CAST(6 AS INTEGER) AS output_columns FROM orders",
}
