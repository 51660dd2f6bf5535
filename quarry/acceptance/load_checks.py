"""Acceptance queries for load (L1-L14, T2).

Mode queries load the ``F`` orders first, then all the others with the mode
under test, and read the table back through ``extract_table``. Each query's
rows change if its operator does not do its work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import extract_table, load_table
from ..errors import StageError
from ..sinks import upkeep
from ..sinks.load import TableExists, TableMissing
from ..sources import catalog
from .workspace import Workspace


def _finished(ws: Workspace) -> str:
    return ws.view(ws.read("orders").filter(F.col("o_orderstatus") == "F"), "finished")


def _others(ws: Workspace) -> str:
    return ws.view(ws.read("orders").filter(F.col("o_orderstatus") != "F"), "others")


def _two_loads(spark: SparkSession, sf_dir: str, label: str, mode: str) -> tuple[Workspace, bool]:
    ws = Workspace(spark, sf_dir, label)
    load_table(spark, _finished(ws), "orders_out", dataset=ws.db)
    raised = False
    try:
        load_table(spark, _others(ws), "orders_out", dataset=ws.db, save_mode=mode)
    except StageError as exc:
        if not isinstance(exc.__cause__, TableExists):
            raise
        raised = True
    return ws, raised


def _read_back(spark: SparkSession, ws: Workspace, table: str) -> DataFrame:
    return extract_table(spark, table, dataset=ws.db).df


def load_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws, _ = _two_loads(spark, sf_dir, "load_overwrite", "Overwrite")
    return _read_back(spark, ws, "orders_out")


def load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws, _ = _two_loads(spark, sf_dir, "load_append", "Append")
    return _read_back(spark, ws, "orders_out")


def load_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws, _ = _two_loads(spark, sf_dir, "load_ignore", "Ignore")
    return _read_back(spark, ws, "orders_out")


def load_error_if_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws, raised = _two_loads(spark, sf_dir, "load_error_if_exists", "ErrorIfExists")
    return _read_back(spark, ws, "orders_out").agg(F.lit(raised).alias("raised"),
                                                   F.count("*").alias("n_rows"))


def load_append_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same load twice, by its id: the rows are there once."""
    ws = Workspace(spark, sf_dir, "load_append_once")
    for view, load_id in ((_finished(ws), "finished"), (_others(ws), "others"), (_others(ws), "others"),
                          (_finished(ws), "finished")):
        load_table(spark, view, "orders_out", dataset=ws.db, save_mode="Append", load_id=load_id)
    return _read_back(spark, ws, "orders_out")


def load_overwrite_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bare overwrite by another schema: the mode is all that decides; settings
    whose columns are gone go with them."""
    ws = Workspace(spark, sf_dir, "load_overwrite_schema")
    load_table(spark, ws.view(ws.read("events"), "events"), "replaced", dataset=ws.db, partition_field="ts",
               partition_expiration_ms=EXPIRATION_MS, as_of=EXPIRY_AS_OF, clustered_fields="user_id",
               required_columns=["event_id"])
    load_table(spark, ws.view(ws.read("orders"), "orders"), "replaced", dataset=ws.db)
    kept = len(catalog.partition_columns(spark, ws.table("replaced")))
    return _read_back(spark, ws, "replaced").withColumn("n_partition_columns", F.lit(kept))


def load_create_never(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``CREATE_NEVER`` overwrites a table that is there and refuses one that
    is not; a table made all the same would add its rows."""
    ws = Workspace(spark, sf_dir, "load_create_never")
    load_table(spark, _finished(ws), "there", dataset=ws.db)
    load_table(spark, _others(ws), "there", dataset=ws.db, create_disposition="CREATE_NEVER")
    try:
        load_table(spark, _finished(ws), "never_made", dataset=ws.db, create_disposition="CREATE_NEVER")
    except StageError as exc:
        if not isinstance(exc.__cause__, TableMissing):
            raise
    out = _read_back(spark, ws, "there")
    if spark.catalog.tableExists(ws.table("never_made")):
        out = out.unionByName(_read_back(spark, ws, "never_made"))
    return out


def load_qualified(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "load_qualified")
    load_table(spark, ws.view(ws.read("customer"), "customer"), "customer", dataset=ws.db, project="spark_catalog")
    return extract_table(spark, "customer", dataset=ws.db, project="spark_catalog").df


def _by_day_folder(spark: SparkSession, name: str) -> DataFrame:
    """Rows by the day that their file's folder is named after."""
    day = F.regexp_extract(F.col("_metadata.file_path"), r"/__day=(\d+-\d+-\d+)/", 1)
    return (spark.table(name).groupBy(F.to_date(F.nullif(day, F.lit(""))).alias("day"))
            .agg(F.count("*").alias("n_rows")))


def load_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "load_partitioned")
    load_table(spark, ws.view(ws.read("events"), "events"), "events_by_day", dataset=ws.db,
               partition_field="ts")
    return _by_day_folder(spark, ws.table("events_by_day"))


def load_overwrite_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bare overwrite of a partitioned, expiring table from itself keeps its
    partitions and expiry, and shows no day column."""
    ws = Workspace(spark, sf_dir, "load_overwrite_partitioned")
    load_table(spark, ws.view(ws.read("events"), "events"), "kept_days", dataset=ws.db, partition_field="ts",
               partition_expiration_ms=EXPIRATION_MS, as_of=EXPIRY_AS_OF)
    again = ws.view(spark.table(ws.table("kept_days")), "again")  # with its derived day column
    load_table(spark, again, "kept_days", dataset=ws.db, as_of=EXPIRY_AS_OF)
    columns = ",".join(_read_back(spark, ws, "kept_days").columns)
    return _by_day_folder(spark, ws.table("kept_days")).withColumn("columns", F.lit(columns))


def load_overwrite_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A same-shape overwrite brings its own column metadata."""
    ws = Workspace(spark, sf_dir, "load_overwrite_metadata")
    for text in ("first", "second"):
        view = ws.view(ws.read("orders").select("o_orderkey", "o_totalprice")
                       .withMetadata("o_totalprice", {"description": text}), text)
        load_table(spark, view, "described", dataset=ws.db)
    out = _read_back(spark, ws, "described")
    return out.withColumn("description", F.lit(out.schema["o_totalprice"].metadata.get("description")))


# Ten days of expiry, judged at 2024-01-31 00:00.
EXPIRATION_MS = 864000000
EXPIRY_AS_OF = "2024-01-31T00:00:00"


def load_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "load_expired")
    load_table(spark, ws.view(ws.read("events"), "events"), "events_recent", dataset=ws.db,
               partition_field="ts", partition_expiration_ms=EXPIRATION_MS, as_of=EXPIRY_AS_OF)
    return _read_back(spark, ws, "events_recent").select("event_id", "ts", "user_id")


def load_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept, in eight files or more, no two of whose o_custkey ranges overlap."""
    ws = Workspace(spark, sf_dir, "load_clustered")
    load_table(spark, ws.view(ws.read("orders"), "orders"), "orders_clustered", dataset=ws.db,
               clustered_fields="o_custkey,o_orderdate", clustered_ranges=12)
    per_file = (spark.table(ws.table("orders_clustered"))
                .groupBy(F.col("_metadata.file_path").alias("file"))
                .agg(F.min("o_custkey").alias("lo"), F.max("o_custkey").alias("hi"),
                     F.count("*").alias("n")))
    flagged = overlapping(per_file, "lo", "hi", f"{ws.dir}/ranges")
    return flagged.agg(F.sum("n").alias("n_rows"), (F.count("*") >= 8).alias("many_files"),
                       F.count(F.when(F.col("overlaps"), 1)).alias("overlapping_files"))


def load_reclustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clustered table that an append has overlapped, after its upkeep: all
    rows, no overlap, and the files that overlapped nothing by their old names."""
    ws = Workspace(spark, sf_dir, "load_reclustered")
    name = ws.table("orders_clustered")
    load_table(spark, ws.view(ws.read("orders"), "orders"), "orders_clustered", dataset=ws.db,
               clustered_fields="o_custkey", clustered_ranges=12)
    middle = ws.read("customer").agg(F.max("c_custkey")).first()[0] // 2
    upper = ws.read("orders").where((F.col("o_custkey") > middle) & (F.col("o_orderstatus") == "F"))
    load_table(spark, ws.view(upper, "upper"), "orders_clustered", dataset=ws.db, save_mode="Append")
    ranges = upkeep.file_ranges(spark.table(name), ["o_custkey"], [])
    before = {r["file"]: r["lo"] for r in ranges.collect()}
    hit = {r["file"] for r in upkeep.overlapping(ranges).collect()}
    done = upkeep.recluster(spark, "orders_clustered", dataset=ws.db)
    ranges = upkeep.file_ranges(spark.table(name), ["o_custkey"], [])
    after = {r["file"] for r in ranges.collect()}
    left = upkeep.overlapping(ranges).count()
    return _read_back(spark, ws, "orders_clustered").select(
        "o_orderkey", "o_custkey", F.lit(left).cast("int").alias("overlapping_files"),
        F.lit(0 < done["overlapping"] == len(hit) < len(before)).alias("some_rewritten"),
        F.lit(before.keys() - hit <= after and not hit & after).alias("others_untouched"))


def overlapping(ranges: DataFrame, lo: str, hi: str, scratch: str) -> DataFrame:
    """Flag each range whose start lies before the end of a range that starts
    earlier (ties broken by end), without sending all ranges to one task.

    Ranges are range-partitioned on the start and numbered once, in a table
    written to ``scratch``; each part takes a running maximum of the ends; the
    maximum end of all *earlier* parts comes from a table with one row per
    part (bounded by the partition count, so it is broadcast safely)."""
    (ranges.repartitionByRange(lo, hi).withColumn("_part", F.spark_partition_id())
     .write.parquet(scratch))
    ranged = ranges.sparkSession.read.parquet(scratch)
    within = Window.partitionBy("_part").orderBy(lo, hi).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_prev_local", F.max(hi).over(within))
    part_end = ranged.groupBy("_part").agg(F.max(hi).alias("_part_hi"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = part_end.select("_part", F.max("_part_hi").over(earlier).alias("_prev_parts"))
    out = local.join(F.broadcast(carried), "_part")
    prev = F.greatest(F.col("_prev_local"), F.col("_prev_parts"))
    return out.withColumn("overlaps", F.coalesce(F.col(lo) < prev, F.lit(False))) \
              .drop("_part", "_prev_local", "_prev_parts")


def load_field_addition(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "load_field_addition")
    docs = ws.read("documents")
    load_table(spark, ws.view(docs.filter("lang = 'de'").select("doc_id", "lang"), "de"), "docs",
               dataset=ws.db)
    load_table(spark, ws.view(docs.filter("lang <> 'de'").select("doc_id", "lang", "n_chars"), "rest"),
               "docs", dataset=ws.db, save_mode="Append", allow_field_addition=True)
    return _read_back(spark, ws, "docs").select("doc_id", "lang", "n_chars")


def load_field_addition_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A struct, also inside an array, that gains a field: old rows read NULL."""
    ws = Workspace(spark, sf_dir, "load_field_addition_nested")

    def shaped(status: str, *more: str) -> DataFrame:
        inner = F.struct("o_totalprice", *more)
        return (ws.read("orders").where(F.col("o_orderstatus") == status)
                .select("o_orderkey", inner.alias("price"), F.array(inner).alias("prices")))

    load_table(spark, ws.view(shaped("F"), "narrow"), "nested", dataset=ws.db)
    load_table(spark, ws.view(shaped("O", "o_orderpriority"), "wide"), "nested", dataset=ws.db, save_mode="Append",
               allow_field_addition=True)
    load_table(spark, ws.view(shaped("P"), "again"), "nested", dataset=ws.db, save_mode="Append")
    return _read_back(spark, ws, "nested").select(
        "o_orderkey", "price.o_totalprice", "price.o_orderpriority",
        F.col("prices")[0]["o_orderpriority"].alias("in_array"))


def load_field_addition_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "load_field_addition_refused")
    docs = ws.read("documents")
    load_table(spark, ws.view(docs.filter("lang = 'de'").select("doc_id", "lang"), "de"), "docs",
               dataset=ws.db)
    raised = False
    try:
        load_table(spark, ws.view(docs.filter("lang <> 'de'").select("doc_id", "lang", "n_chars"), "rest"),
                   "docs", dataset=ws.db, save_mode="Append")
    except StageError:
        raised = True
    return _read_back(spark, ws, "docs").agg(F.lit(raised).alias("raised"), F.count("*").alias("n_rows"))


def _labelled_then_unlabelled(spark: SparkSession, ws: Workspace, relax: bool) -> bool:
    labels = ws.read("labels").select("doc_id", "quality")
    load_table(spark, ws.view(labels, "labels"), "labelled", dataset=ws.db, required_columns=["quality"])
    unlabelled = (ws.read("documents").join(ws.read("labels"), "doc_id", "left_anti")
                  .select("doc_id", F.lit(None).cast("int").alias("quality")))
    try:
        load_table(spark, ws.view(unlabelled, "unlabelled"), "labelled", dataset=ws.db,
                   save_mode="Append", allow_field_relaxation=relax)
    except StageError:
        if relax:
            raise
        return True
    return False


def load_field_relaxation(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "load_field_relaxation")
    _labelled_then_unlabelled(spark, ws, relax=True)
    return _read_back(spark, ws, "labelled").select("doc_id", "quality")


def load_field_relaxation_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "load_field_relaxation_refused")
    raised = _labelled_then_unlabelled(spark, ws, relax=False)
    return _read_back(spark, ws, "labelled").agg(F.lit(raised).alias("raised"),
                                                 F.count("*").alias("n_rows"))


def load_self_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A DELETE written as SELECT + Overwrite of the table from itself."""
    ws = Workspace(spark, sf_dir, "load_self_overwrite")
    load_table(spark, ws.view(ws.read("orders"), "orders"), "orders_self", dataset=ws.db)
    kept = spark.table(ws.table("orders_self")).filter(F.col("o_orderstatus") != "P")
    load_table(spark, ws.view(kept, "kept"), "orders_self", dataset=ws.db, save_mode="Overwrite")
    return _read_back(spark, ws, "orders_self")


def load_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The returned frame has the rows, and the input view, which reads the
    replaced version of the same table, can still be read."""
    ws = Workspace(spark, sf_dir, "load_passthrough")
    load_table(spark, ws.view(ws.read("orders"), "orders"), "orders_copy", dataset=ws.db)
    kept = ws.view(spark.table(ws.table("orders_copy")).filter(F.col("o_orderstatus") != "P"), "kept")
    out = load_table(spark, kept, "orders_copy", dataset=ws.db)
    return out.withColumn("n_input", F.lit(spark.table(kept).count()))


def stream_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A streaming view over the orders files (never started) is refused by
    both; the table it was to overwrite keeps its rows."""
    ws = Workspace(spark, sf_dir, "stream_refused")
    load_table(spark, _finished(ws), "from_stream", dataset=ws.db)
    stream = (spark.readStream.schema(ws.read("orders").schema).option("pathGlobFilter", "orders.parquet")
              .parquet(ws.sf_dir))
    view = ws.view(stream, "orders_stream")
    read_refused = False
    try:
        extract_table(spark, view)
    except StageError:
        read_refused = True
    try:
        load_table(spark, view, "from_stream", dataset=ws.db)
    except StageError:
        pass
    return _read_back(spark, ws, "from_stream").withColumn("read_refused", F.lit(read_refused))


QUERIES = {
    "load_overwrite": load_overwrite,
    "load_append": load_append,
    "load_append_once": load_append_once,
    "load_overwrite_schema": load_overwrite_schema,
    "load_ignore": load_ignore,
    "load_error_if_exists": load_error_if_exists,
    "load_create_never": load_create_never,
    "load_qualified": load_qualified,
    "load_partitioned": load_partitioned,
    "load_overwrite_partitioned": load_overwrite_partitioned,
    "load_overwrite_metadata": load_overwrite_metadata,
    "load_expired": load_expired,
    "load_clustered": load_clustered,
    "load_reclustered": load_reclustered,
    "load_field_addition": load_field_addition,
    "load_field_addition_nested": load_field_addition_nested,
    "load_field_addition_refused": load_field_addition_refused,
    "load_field_relaxation": load_field_relaxation,
    "load_field_relaxation_refused": load_field_relaxation_refused,
    "load_self_overwrite": load_self_overwrite,
    "load_passthrough": load_passthrough,
    "stream_refused": stream_refused,
}

ORACLE = {
    "load_overwrite": "SELECT * FROM orders WHERE o_orderstatus <> 'F'",
    "load_append": "SELECT * FROM orders",
    "load_append_once": "SELECT * FROM orders",
    "load_overwrite_schema": "SELECT *, 0 AS n_partition_columns FROM orders",
    "load_ignore": "SELECT * FROM orders WHERE o_orderstatus = 'F'",
    "load_error_if_exists": "SELECT TRUE AS raised, count(*) AS n_rows FROM orders WHERE o_orderstatus = 'F'",
    "load_create_never": "SELECT * FROM orders WHERE o_orderstatus <> 'F'",
    "load_qualified": "SELECT * FROM customer",
    "load_partitioned": "SELECT CAST(ts AS DATE) AS day, count(*) AS n_rows FROM events GROUP BY 1",
    "load_expired": "SELECT event_id, ts, user_id FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-21'",
    "load_overwrite_partitioned": "SELECT CAST(ts AS DATE) AS day, count(*) AS n_rows, 'event_id,ts,user_id,event_type,value,props' AS columns FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-21' GROUP BY 1",
    "load_overwrite_metadata": "SELECT o_orderkey, o_totalprice, 'second' AS description FROM orders",
    "load_clustered": "SELECT count(*) AS n_rows, TRUE AS many_files, CAST(0 AS BIGINT) AS overlapping_files FROM orders",
    "load_reclustered": "WITH m AS (SELECT max(c_custkey) // 2 AS m FROM customer) SELECT o_orderkey, o_custkey, 0 AS overlapping_files, TRUE AS some_rewritten, TRUE AS others_untouched FROM (SELECT o_orderkey, o_custkey FROM orders UNION ALL SELECT o_orderkey, o_custkey FROM orders, m WHERE o_custkey > m AND o_orderstatus = 'F')",
    "load_field_addition": "SELECT doc_id, lang, CAST(NULL AS BIGINT) AS n_chars FROM documents WHERE lang = 'de' UNION ALL SELECT doc_id, lang, n_chars FROM documents WHERE lang <> 'de'",
    "load_field_addition_nested": "SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS o_orderpriority, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS in_array FROM orders",
    "load_field_addition_refused": "SELECT TRUE AS raised, count(*) AS n_rows FROM documents WHERE lang = 'de'",
    "load_field_relaxation": "SELECT doc_id, quality FROM labels UNION ALL SELECT d.doc_id, CAST(NULL AS INTEGER) AS quality FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "load_field_relaxation_refused": "SELECT TRUE AS raised, count(*) AS n_rows FROM labels",
    "load_self_overwrite": "SELECT * FROM orders WHERE o_orderstatus <> 'P'",
    "load_passthrough": "SELECT *, (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P') AS n_input FROM orders WHERE o_orderstatus <> 'P'",
    "stream_refused": "SELECT *, TRUE AS read_refused FROM orders WHERE o_orderstatus = 'F'",
}
