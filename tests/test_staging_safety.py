"""Staged writes never delete live data, and settings and days survive what they should."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from quarry import extract_table, load_table
from quarry.acceptance import extract_checks, load_checks
from quarry.acceptance.workspace import Workspace
from quarry.errors import ConfigError, StageError
from quarry.operators import distribute, layout
from quarry.sinks import expiry, load, staging
from quarry.sources import catalog, files

SF001 = "/root/testdata/sf0.001"


def nation(ws):
    return ws.view(ws.read("nation"), "nation")


def aged(spark, table, hours=1000.0, **more):
    props = {catalog.PROP_STARTED: str(int((time.time() - hours * 3600) * 1000)), catalog.PROP_WRITER: "lost", **more}
    catalog.set_properties(spark, table, props)


def test_same_name_in_two_datasets(spark, ws):
    other, stage = Workspace(spark, SF001, "test"), f"{ws.dir}/stage"
    for w in (ws, other):
        load_table(spark, nation(w), "t", dataset=w.db, staging_dir=stage)
    for _ in range(2):
        load_table(spark, nation(ws), "t", dataset=ws.db, staging_dir=stage)
    staging.sweep_leftovers(spark, "t", ws.db, older_than_hours=0)
    assert spark.table(other.table("t")).count() == 25


def test_renamed_backup_stays(spark, ws):
    load_table(spark, nation(ws), "t", dataset=ws.db)
    spark.sql(f"ALTER TABLE {ws.table('t')} RENAME TO {ws.table('t_backup')}")
    for _ in range(3):
        load_table(spark, nation(ws), "t", dataset=ws.db)
        staging.sweep_leftovers(spark, "t", ws.db, older_than_hours=0)
    assert spark.table(ws.table("t_backup")).count() == 25


def test_staging_dir_in_another_spelling(spark, ws):
    load_table(spark, nation(ws), "t", dataset=ws.db, staging_dir=f"{ws.dir}/stage")
    kept = ws.view(spark.table(ws.table("t")).where("n_regionkey > 0"), "kept")
    load_table(spark, kept, "t", dataset=ws.db, staging_dir=f"{ws.dir}//stage")
    assert spark.table(ws.table("t")).count() == 20 and spark.table(kept).count() == 20


def test_the_only_copy_is_put_in_place(spark, ws, monkeypatch):
    load_table(spark, nation(ws), "t", dataset=ws.db)
    narrow = ws.view(ws.read("nation").select("n_name"), "narrow")

    def lost(*_):
        raise OSError("driver lost")

    monkeypatch.setattr(staging, "_rename", lost)
    with pytest.raises(StageError):
        load_table(spark, narrow, "t", dataset=ws.db)
    monkeypatch.undo()
    side = next(r["tableName"] for r in spark.sql(f"SHOW TABLES IN {ws.db}").collect() if "__quarry_" in r["tableName"])
    aged(spark, ws.table(side))
    assert staging.sweep_leftovers(spark, "t", ws.db, older_than_hours=0) == []  # the target is missing
    load_table(spark, narrow, "t", dataset=ws.db, save_mode="Append")
    assert spark.table(ws.table("t")).count() == 50


def test_only_registered_side_tables_of_others_are_swept(spark, ws):
    load_table(spark, nation(ws), "t", dataset=ws.db)
    target = f"`{ws.db}`.`t`"
    running, running_dir = staging.write_version(spark, ws.read("nation"), target, staging_root=f"{ws.dir}/stage",
                                                 partition_cols=[])
    abandoned, abandoned_dir = staging.write_version(spark, ws.read("nation"), target,
                                                     staging_root=f"{ws.dir}/stage", partition_cols=[])
    spark.sql(f"CREATE TABLE {ws.table('t__quarry_0123456789abcdef')} USING parquet AS SELECT 1 AS a")
    aged(spark, abandoned)
    catalog.set_properties(spark, running, {catalog.PROP_STARTED: "0"})  # old, but this application writes it
    load_table(spark, nation(ws), "t", dataset=ws.db)
    assert staging.sweep_leftovers(spark, "t", ws.db, older_than_hours=24) == [abandoned]
    assert files.list_children(spark, running_dir) and not files.list_children(spark, abandoned_dir)
    assert spark.table(ws.table("t__quarry_0123456789abcdef")).count() == 1


def test_crash_between_the_two_catalog_calls(spark, ws, monkeypatch):
    load_table(spark, nation(ws), "t", dataset=ws.db)
    sql = spark.sql

    def cut(text, *a, **b):
        if text.startswith("DROP TABLE") and "__quarry_" in text:
            raise OSError("driver lost after SET LOCATION")
        return sql(text, *a, **b)

    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **b: cut(text, *a, **b))
    with pytest.raises(StageError):
        load_table(spark, nation(ws), "t", dataset=ws.db)
    monkeypatch.undo()
    more = ws.view(ws.read("nation").withColumn("extra", F.lit(1)), "more")
    load_table(spark, more, "t", dataset=ws.db, save_mode="Append", allow_field_addition=True)
    assert spark.table(ws.table("t")).count() == 50


# --- what an overwrite keeps -------------------------------------------------------------


def test_bare_overwrite_keeps_settings(spark, ws):
    events = ws.view(ws.read("events"), "events")
    settings = dict(partition_field="ts", partition_expiration_ms=10**10, clustered_fields="user_id",
                    required_columns=["event_id"])
    load_table(spark, events, "e", dataset=ws.db, as_of="2024-02-01", **settings)
    load_table(spark, ws.view(spark.table(ws.table("e")), "own"), "e", dataset=ws.db, as_of="2024-02-01")
    props = catalog.properties(spark, ws.table("e"))
    assert [props[p] for p in (catalog.PROP_PARTITION_FIELD, catalog.PROP_DAY_COLUMN, catalog.PROP_EXPIRATION_MS,
                               catalog.PROP_CLUSTERED, catalog.PROP_REQUIRED)] \
        == ["ts", "__day", str(10**10), "user_id", "event_id"]
    assert "__day" not in extract_table(spark, "e", dataset=ws.db).df.columns
    load_table(spark, events, "e", dataset=ws.db, partition_field="", clustered_fields="", required_columns=[])
    props = catalog.properties(spark, ws.table("e"))
    assert not {catalog.PROP_PARTITION_FIELD, catalog.PROP_EXPIRATION_MS, catalog.PROP_CLUSTERED,
                catalog.PROP_REQUIRED} & set(props)


def test_own_day_column_is_left_alone(spark, ws):
    own = ws.view(ws.read("events").withColumn("__day", F.lit("mine")), "own")
    load_table(spark, own, "e", dataset=ws.db, partition_field="ts")
    df = extract_table(spark, "e", dataset=ws.db, day_range=("2024-01-03", "2024-01-03")).df
    assert "__day_1" not in df.columns and df.where("__day <> 'mine'").count() == 0 and df.count() > 0


# --- days and expiry ---------------------------------------------------------------------


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Pacific/Auckland"])
def test_days_are_utc_in_any_session(spark, ws, zone):
    rows = ws.read("events").select("event_id", F.expr("cast(unix_micros(cast(ts as timestamp)) as bigint)").alias("us"))
    old = spark.conf.get("spark.sql.session.timeZone")
    stored = rows.select("event_id", F.timestamp_micros("us").alias("ts"))
    want = {r["event_id"] for r in rows.collect()
            if dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=r["us"]) >= dt.datetime(2024, 1, 22)}
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        load_table(spark, ws.view(stored, "z"), "z", dataset=ws.db, partition_field="ts",
                   partition_expiration_ms=load_checks.EXPIRATION_MS, as_of=load_checks.EXPIRY_AS_OF)
        got = {r["event_id"] for r in spark.table(ws.table("z")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == want


def test_expired_rows_are_never_written(spark, ws, monkeypatch):
    seen = []
    write = staging.write_version
    monkeypatch.setattr(staging, "write_version", lambda s, df, *a, **b: (seen.append(df.count()), write(s, df, *a, **b))[1])
    load_table(spark, ws.view(ws.read("events"), "events"), "e", dataset=ws.db, partition_field="ts",
               partition_expiration_ms=load_checks.EXPIRATION_MS, as_of=load_checks.EXPIRY_AS_OF)
    assert seen == [spark.table(ws.table("e")).count()] and seen[0] < ws.read("events").count()


def test_expiry_range_and_trouble_after_the_commit(spark, ws, monkeypatch):
    events = ws.view(ws.read("events"), "events")
    with pytest.raises(ConfigError):
        load_table(spark, events, "e", dataset=ws.db, partition_field="ts", partition_expiration_ms=10**14)
    assert expiry.expired_days(["2024-01-01"], 10**14, dt.datetime(2024, 1, 1)) == []
    load_table(spark, events, "e", dataset=ws.db, partition_field="ts")

    def broken(*_):
        raise OSError("store away")

    monkeypatch.setattr(load.expiry, "expire_partitions", broken)
    with pytest.raises(StageError) as e:
        load_table(spark, events, "e", dataset=ws.db, save_mode="Append")
    assert e.value.detail["committed"] is True


# --- evolution ---------------------------------------------------------------------------


def test_required_columns_of_the_call(spark, ws):
    labels = ws.read("labels")
    load_table(spark, ws.view(labels, "labels"), "l", dataset=ws.db, required_columns=["quality"])
    holes = ws.view(labels.withColumn("quality", F.lit(None).cast("int")), "holes")
    with pytest.raises(StageError):  # the call's own list wins over the relaxation
        load_table(spark, holes, "l", dataset=ws.db, save_mode="Append", allow_field_relaxation=True,
                   required_columns=["quality"])
    with pytest.raises(StageError):
        load_table(spark, ws.view(labels, "same"), "l", dataset=ws.db, save_mode="Append", required_columns=["qualty"])
    load_table(spark, ws.view(labels, "same"), "l", dataset=ws.db, save_mode="Append", allow_field_relaxation=True)
    assert catalog.properties(spark, ws.table("l"))[catalog.PROP_REQUIRED] == "quality"  # it held no NULL
    wider = labels.withColumn("rank", F.when(F.col("toxic") == 1, 1))
    with pytest.raises(StageError):
        load_table(spark, ws.view(wider, "wider"), "l", dataset=ws.db, save_mode="Append", allow_field_addition=True,
                   required_columns=["rank"])
    full = ws.view(labels.withColumn("rank", F.lit(1)), "full")
    load_table(spark, full, "l", dataset=ws.db, save_mode="Append", allow_field_addition=True, required_columns=["rank"])
    assert set(catalog.csv(catalog.properties(spark, ws.table("l"))[catalog.PROP_REQUIRED])) == {"quality", "rank"}
    load_table(spark, ws.view(spark.table(holes).withColumn("rank", F.lit(1)), "h"), "l", dataset=ws.db,
               save_mode="Append", allow_field_relaxation=True)
    assert spark.table(ws.table("l")).where("quality IS NULL").count() == labels.count()


def test_statistics_follow_a_field_addition(spark, ws):
    load_table(spark, nation(ws), "n", dataset=ws.db)
    spark.sql(f"ANALYZE TABLE {ws.table('n')} COMPUTE STATISTICS")
    big = ws.view(ws.read("nation").crossJoin(spark.range(200)).withColumn("note", F.expr("uuid()")), "big")
    load_table(spark, ws.view(spark.table(big).drop("id"), "wide"), "n",
               dataset=ws.db, save_mode="Append", allow_field_addition=True)
    said = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {ws.table('n')}").collect()}
    assert "25 rows" not in said["Statistics"]
    assert int(said["Statistics"].split()[0]) >= files.total_bytes(spark, catalog.location(spark, ws.table("n"))) * 0.9


# --- clustering --------------------------------------------------------------------------


def test_ranges_grow_with_the_estimate(spark, monkeypatch):
    df = spark.range(1000)
    advisory = layout.advisory_bytes(df)
    assert layout.range_count(df) is None
    for gb in (1, 100, 100_000):
        monkeypatch.setattr(layout, "estimated_bytes", lambda _, n=gb: n << 30)
        n = layout.range_count(df)
        assert n == min((gb << 30) // advisory, layout._MAX_RANGES) or n == -(-(gb << 30) // advisory)


# --- acceptance queries turn red when their operator is off --------------------------------


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("query,module,name,off", [
    ("load_partitioned", layout, "day_column", None),
    ("load_clustered", layout, "lay_out", lambda df, *a, **b: df.repartition(12)),
    ("load_overwrite_metadata", staging, "schema_digest", lambda df: "same"),
    ("load_expired", expiry, "unexpired", None)])
def test_switching_an_operator_off_shows(spark, monkeypatch, query, module, name, off):
    good = rows(load_checks.QUERIES[query](spark, SF001))
    if query == "load_partitioned":
        whole = load_checks.load_table
        monkeypatch.setattr(load_checks, "load_table", lambda *a, partition_field=None, **b: whole(*a, **b))
    elif query == "load_expired":
        monkeypatch.setattr(expiry, "unexpired", lambda df, *a: df)
        monkeypatch.setattr(expiry, "expire_partitions", lambda *a: [])
    else:
        monkeypatch.setattr(module, name, off)
    assert rows(load_checks.QUERIES[query](spark, SF001)) != good


def test_persist_off_shows(spark, monkeypatch):
    good = rows(extract_checks.QUERIES["persist_records"](spark, SF001))
    monkeypatch.setattr(distribute, "persist", lambda df, level: (df, -1))
    assert rows(extract_checks.QUERIES["persist_records"](spark, SF001)) != good


def test_metadata_view_is_bounded(spark, ws):
    many = ws.view(ws.read("orders").select(F.lit("o_orderkey").alias("name"), F.lit("{}").alias("metadata")), "many")
    load_table(spark, nation(ws), "n", dataset=ws.db)
    with pytest.raises(StageError):
        extract_table(spark, "n", dataset=ws.db, schema_view=many)
