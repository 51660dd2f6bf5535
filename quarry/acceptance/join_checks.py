"""Acceptance queries for the joins that SQL text alone does not scale: as-of and interval."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import extract_table
from ..operators.asof import asof_join
from ..operators.intervals import interval_join
from .workspace import Workspace


def asof_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """To each event the user's last event of an earlier hour; of several in that
    hour the one with the largest id. First events have none."""
    ws = Workspace(spark, sf_dir, "asof_events")
    events = extract_table(spark, "events", dataset=ws.src).df.withColumn("hour", F.date_trunc("hour", "ts"))
    return asof_join(events.select("event_id", "user_id", "hour"),
                     events.select(F.col("event_id").alias("prev_id"), "user_id", F.col("hour").alias("prev_hour"),
                                   F.col("value").alias("prev_value")),
                     left_on="hour", right_on="prev_hour", by=["user_id"], ties=["prev_id"], exact=False)


def interval_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a customer's orders that are open at the same time; an order stays
    open for a day per 5,000 of its price."""
    ws = Workspace(spark, sf_dir, "interval_orders")
    orders = extract_table(spark, "orders", dataset=ws.src).df.select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("opened"),
        F.date_add(F.to_date("o_orderdate"), F.floor(F.col("o_totalprice") / 5000).cast("int")).alias("closed"))
    met = interval_join(orders, orders, left_interval=("opened", "closed"), right_interval=("opened", "closed"),
                        by=["o_custkey"], suffix="_2")
    return met.where("o_orderkey < o_orderkey_2").select("o_custkey", "o_orderkey", "o_orderkey_2", "opened", "closed_2")


QUERIES = {"asof_events": asof_events, "interval_orders": interval_orders}

ORACLE = {
    "asof_events": """
        WITH e AS (SELECT *, date_trunc('hour', ts) AS hour FROM events),
        r AS (SELECT event_id AS prev_id, user_id, hour AS prev_hour, value AS prev_value FROM e
              QUALIFY row_number() OVER (PARTITION BY user_id, hour ORDER BY event_id DESC) = 1)
        SELECT e.event_id, e.user_id, e.hour, r.prev_id, r.prev_hour, r.prev_value
        FROM e ASOF LEFT JOIN r ON e.user_id = r.user_id AND e.hour > r.prev_hour""",
    "interval_orders": """
        WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS opened,
                          CAST(o_orderdate AS DATE) + CAST(floor(o_totalprice / 5000) AS INTEGER) AS closed FROM orders)
        SELECT a.o_custkey, a.o_orderkey, b.o_orderkey AS o_orderkey_2, a.opened, b.closed AS closed_2
        FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey
                          AND a.opened <= b.closed AND b.opened <= a.closed""",
}
