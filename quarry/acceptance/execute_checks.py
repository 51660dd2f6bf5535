"""Acceptance queries for execute (E1-E8) and the SQL statement catalogue.

Every statement runs as a CTAS through ``execute_sql`` with the source
database current, and its result table is read back with ``extract_table``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import execute_sql, extract_table
from ..errors import StageError
from ..operators.batched import histogram_quantile, sessions
from ..plans import statements
from ..sources import files
from .workspace import Workspace

# The statement behind execute_ctas / execute_uri / entry().
SEGMENT_ORDERS = ("SELECT c_mktsegment, count(*) AS n_orders FROM orders "
                  "JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment")


def execute_ctas(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "execute_ctas")
    execute_sql(spark, f"CREATE TABLE {ws.table('segment_orders')} AS {SEGMENT_ORDERS}", dataset=ws.src)
    return extract_table(spark, "segment_orders", dataset=ws.db).df


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extract orders and customer into temp views, CTAS orders per market
    segment over those views through ``execute_sql``, extract the result."""
    ws = Workspace(spark, sf_dir, "flagship")
    o = extract_table(spark, "orders", dataset=ws.src, output_view=f"{ws.db}__orders")
    c = extract_table(spark, "customer", dataset=ws.src, output_view=f"{ws.db}__customer")
    sql = SEGMENT_ORDERS.replace("FROM orders", f"FROM {o.detail['outputView']}") \
                        .replace("JOIN customer", f"JOIN {c.detail['outputView']}")
    execute_sql(spark, f"CREATE TABLE {ws.table('segment_orders')} AS {sql}", job_name="flagship")
    return extract_table(spark, "segment_orders", dataset=ws.db).df


def execute_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "execute_uri")
    path = f"{ws.dir}/segment_orders.sql"
    files.write_text(spark, path, f"CREATE TABLE {ws.table('segment_orders')} AS\n{SEGMENT_ORDERS}\n")
    execute_sql(spark, "SELECT 'inline text loses to input_uri'", input_uri=path, dataset=ws.src)
    return extract_table(spark, "segment_orders", dataset=ws.db).df


def execute_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An INSERT with parameters: ``${status}`` is substituted as text,
    ``:min_price`` bound as a value, ``:target`` names the table."""
    ws = Workspace(spark, sf_dir, "execute_params")
    execute_sql(spark, f"CREATE TABLE {ws.table('big_orders')} (o_orderkey BIGINT, o_totalprice DOUBLE) "
                       "USING parquet")
    sql = ("INSERT INTO IDENTIFIER(:target) SELECT o_orderkey, o_totalprice FROM orders "
           "WHERE o_totalprice > :min_price AND o_orderstatus = '${status}'")
    execute_sql(spark, sql, sql_params={"target": ws.table("big_orders"), "min_price": 100000, "status": "F"},
                dataset=ws.src)
    return extract_table(spark, "big_orders", dataset=ws.db).df


def execute_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job that fails at run time (a data check on every row) raises, with
    the stage detail, and adds no row to the table it was to insert into."""
    ws = Workspace(spark, sf_dir, "execute_error")
    execute_sql(spark, f"CREATE TABLE {ws.table('keys')} AS SELECT o_orderkey, o_totalprice FROM orders",
                dataset=ws.src)
    raised = False
    try:
        execute_sql(spark, f"INSERT INTO {ws.table('keys')} SELECT o_orderkey, "
                           "if(o_totalprice < 0, 0, raise_error('a price')) FROM orders", dataset=ws.src)
    except StageError as exc:
        raised = "sql" in exc.detail
    return extract_table(spark, "keys", dataset=ws.db).df.withColumn("raised", F.lit(raised))


def execute_default_db(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "execute_default_db")
    before = spark.catalog.currentDatabase()
    execute_sql(spark, f"CREATE TABLE orders_copy AS SELECT * FROM {ws.source('orders')}", dataset=ws.db)
    if spark.catalog.currentDatabase() != before:
        raise AssertionError("current database not restored")
    return extract_table(spark, "orders_copy", dataset=ws.db).df


def execute_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, sf_dir, "execute_tagged")
    tag = f"quarry-tagged-{uuid.uuid4().hex[:8]}"
    execute_sql(spark, f"CREATE TABLE {ws.table('by_status')} AS SELECT o_orderstatus, count(*) AS n "
                       "FROM orders GROUP BY o_orderstatus", dataset=ws.src, job_name=tag)
    ran = len(spark.sparkContext.statusTracker().getJobIdsForGroup(tag)) > 0
    tagged = ran and tag not in spark.getTags()
    return extract_table(spark, "by_status", dataset=ws.db).df.withColumn("tagged", F.lit(tagged))


def execute_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregate with merge, for this call alone: the price below which nine
    tenths of the line items of each return flag lie, to a hundred."""
    ws = Workspace(spark, sf_dir, "execute_aggregate")
    execute_sql(spark, f"CREATE TABLE {ws.table('prices')} AS SELECT key AS l_returnflag, result AS price "
                       "FROM ninth(TABLE(SELECT * FROM ninth_partial(TABLE("
                       "SELECT l_returnflag, l_extendedprice FROM lineitem))) PARTITION BY key)",
                dataset=ws.src, functions={"ninth": histogram_quantile(0.9, 100)})
    return extract_table(spark, "prices", dataset=ws.db).df


def execute_table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table function, for this call alone: each user's sessions, ended by six hours without an event."""
    ws = Workspace(spark, sf_dir, "execute_table_function")
    execute_sql(spark, f"CREATE TABLE {ws.table('sessions')} AS SELECT key AS user_id, first, last, n "
                       "FROM sessions(TABLE(SELECT user_id, timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01', "
                       "CAST(ts AS TIMESTAMP_NTZ)) AS at FROM events) "
                       "PARTITION BY user_id ORDER BY at)",
                dataset=ws.src, functions={"sessions": sessions(6 * 3_600_000_000)})
    return extract_table(spark, "sessions", dataset=ws.db).df


def _statement(key: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ws = Workspace(spark, sf_dir, key)
        execute_sql(spark, f"CREATE TABLE {ws.table('result')} AS {statements.SPARK[key]}",
                    dataset=ws.src, job_name=f"{key}-{uuid.uuid4().hex[:8]}")
        return extract_table(spark, "result", dataset=ws.db).df
    run.__name__ = key
    return run


QUERIES = {
    "execute_ctas": execute_ctas,
    "execute_uri": execute_uri,
    "execute_params": execute_params,
    "execute_error": execute_error,
    "execute_default_db": execute_default_db,
    "execute_tagged": execute_tagged,
    "execute_aggregate": execute_aggregate,
    "execute_table_function": execute_table_function,
    **{key: _statement(key) for key in statements.SPARK},
}

ORACLE = {
    "execute_ctas": SEGMENT_ORDERS,
    "execute_uri": SEGMENT_ORDERS,
    "execute_params": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'",
    "execute_error": "SELECT o_orderkey, o_totalprice, TRUE AS raised FROM orders",
    "execute_default_db": "SELECT * FROM orders",
    "execute_tagged": "SELECT o_orderstatus, count(*) AS n, TRUE AS tagged FROM orders GROUP BY 1",
    "execute_aggregate": """
        SELECT l_returnflag, quantile_disc(floor(l_extendedprice / 100), 0.9) * 100.0::DOUBLE AS price
        FROM lineitem GROUP BY 1""",
    "execute_table_function": """
        WITH e AS (SELECT user_id, epoch_us(ts) AS t FROM events),
        s AS (SELECT *, t - lag(t) OVER (PARTITION BY user_id ORDER BY t) > 6 * 3600000000 AS cut FROM e),
        n AS (SELECT *, count(*) FILTER (cut) OVER (PARTITION BY user_id ORDER BY t) AS session FROM s)
        SELECT user_id, min(t) AS first, max(t) AS last, count(*) AS n FROM n GROUP BY user_id, session""",
    **{key: statements.duckdb_text(key) for key in statements.SPARK},
}
