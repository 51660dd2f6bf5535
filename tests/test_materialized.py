"""Materialised views that are read again while current, and counts that come with the first action."""

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from quarry import ConfigError, StageError, extract_table
from quarry.sources import catalog, materialized


@pytest.fixture()
def source(spark, ws):
    ws.read("orders").where("o_orderstatus = 'F'").write.saveAsTable(ws.table("source"))
    spark.sql(f"CREATE VIEW {ws.table('v')} AS SELECT o_custkey, count(*) AS n FROM {ws.table('source')} GROUP BY o_custkey")
    return ws


def read(spark, ws, view="v", **more):
    return extract_table(spark, view, dataset=ws.db, views_enabled=True, view_materialization_dataset=ws.db, **more)


@contextmanager
def jobs(spark, ran):
    """Appends the number of jobs that run inside."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        yield
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        ran.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))


def test_second_read_runs_no_job(spark, source):
    ran = []
    for _ in range(2):
        with jobs(spark, ran):
            r = read(spark, source)
    assert ran[0] > 0 and ran[1] == 0 and r.detail["materializationReused"]
    assert r.df.agg(F.sum("n")).first()[0] == spark.table(source.table("source")).count()


def test_a_changed_source_is_read_anew(spark, source):
    first = read(spark, source).detail["materializedAs"]
    source.read("orders").where("o_orderstatus = 'P'").write.insertInto(source.table("source"))
    second = read(spark, source)
    assert second.detail["materializedAs"] != first
    assert second.df.agg(F.sum("n")).first()[0] == source.read("orders").where("o_orderstatus <> 'O'").count()
    spark.sql(f"CREATE OR REPLACE VIEW {source.table('v')} AS SELECT o_custkey, count(*) + 1 AS n "
              f"FROM {source.table('source')} GROUP BY o_custkey")
    assert "materializationReused" not in read(spark, source).detail


def test_files_written_by_another_session_count(spark, source):
    read(spark, source)
    location = catalog.location(spark, source.table("source"))
    source.read("orders").where("o_orderstatus = 'P'").write.mode("append").parquet(location)  # the catalog isn't told
    r = read(spark, source)
    assert "materializationReused" not in r.detail
    assert r.df.agg(F.sum("n")).first()[0] == source.read("orders").where("o_orderstatus <> 'O'").count()


def test_an_expired_one_is_made_anew(spark, source):
    made = read(spark, source).detail["materializedAs"]
    past = (dt.datetime.now(dt.timezone.utc) - dt.timedelta(minutes=1)).isoformat()
    catalog.set_properties(spark, made, {catalog.PROP_EXPIRES_AT: past})
    again = read(spark, source)
    assert "materializationReused" not in again.detail and again.detail["materializedAs"] != made
    assert again.detail["materializationExpiresAt"] > past


@pytest.mark.parametrize("column", ["rand()", "current_timestamp()", "uuid()", "current_date()"])
def test_results_of_the_moment_are_not_reused(spark, source, column):
    spark.sql(f"CREATE OR REPLACE VIEW {source.table('v')} AS SELECT o_orderkey, {column} AS x FROM {source.table('source')}")
    names = {read(spark, source).detail["materializedAs"] for _ in range(2)}
    assert len(names) == 2


def test_rows_not_in_files_have_no_key(spark, source):
    assert materialized.state_key(spark.createDataFrame([(1,)], "a int")) is None
    assert materialized.state_key(spark.table(source.table("v"))) == materialized.state_key(spark.table(source.table("v")))
    wide = spark.table(source.table("source"))
    for k in range(60):  # more fields than a plan shows by default
        wide = wide.withColumn(f"x{k}", F.lit(k))
    assert materialized.state_key(wide.drop("x59")) != materialized.state_key(wide)
    assert materialized.state_key(wide.withColumn("x50", F.lit(7))) != materialized.state_key(wide)


def test_threads_share_one(spark, source):
    with ThreadPoolExecutor(4) as pool:
        found = list(pool.map(lambda _: read(spark, source), range(4)))
    assert len({r.detail["materializedAs"] for r in found}) == 1
    total = spark.table(source.table("source")).count()
    assert all(r.df.agg(F.sum("n")).first()[0] == total for r in found)


# --- observation -------------------------------------------------------------------------


def test_counts_come_with_the_first_action(spark, ws):
    ws.read("documents").join(ws.read("labels"), "doc_id", "left").write.saveAsTable(ws.table("labelled"))
    r = extract_table(spark, "labelled", dataset=ws.db, observe=True, observe_nulls=["quality", "DOC_ID"])
    ran = []
    with jobs(spark, ran):
        r.df.write.format("noop").mode("overwrite").save()
        seen = r.observed()
    plain = spark.table(ws.table("labelled"))
    assert ran == [1]
    assert seen == {"records": plain.count(), "nulls": {"quality": plain.where("quality IS NULL").count(), "doc_id": 0}}
    assert "records" not in r.stats


def test_persist_fills_the_cache_with_the_observed_action(spark, ws):
    ran = []
    with jobs(spark, ran):
        r = extract_table(spark, "orders", dataset=ws.src, persist=True, observe=True, observe_nulls=["o_custkey"])
    try:
        assert ran == [1] and r.df.storageLevel.useMemory
        assert r.stats["records"] == ws.read("orders").count() and r.observed()["nulls"] == {"o_custkey": 0}
    finally:
        r.df.unpersist()


def test_observe_arguments(spark, ws):
    with pytest.raises(ConfigError):
        extract_table(spark, "orders", dataset=ws.src, observe_nulls=["o_custkey"])
    with pytest.raises(StageError):
        extract_table(spark, "orders", dataset=ws.src, observe=True, observe_nulls=["nope"])
    with pytest.raises(ValueError):
        extract_table(spark, "orders", dataset=ws.src).observed()
