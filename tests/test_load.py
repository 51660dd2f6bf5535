import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF001, explain
from quarry.acceptance.load_checks import QUERIES as LOAD_QUERIES
from quarry import ConfigError, StageError, extract_table, load_table
from quarry.operators.evolution import SchemaMismatch
from quarry.sinks import expiry
from quarry.sinks.load import TableExists, TableMissing
from quarry.sources import catalog, files


def _orders(ws, status=None, label="o"):
    df = ws.read("orders")
    if status:
        df = df.filter(F.col("o_orderstatus") == status)
    return ws.view(df, f"{label}_{status or 'all'}")


def _tables(spark, ws):
    return [t.name for t in spark.catalog.listTables(ws.db) if not t.isTemporary]


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_save_modes(spark, ws):
    f, o = _orders(ws, "F"), _orders(ws, "O")
    n_f, n_o = spark.table(f).count(), spark.table(o).count()
    load_table(spark, f, "t", dataset=ws.db)
    load_table(spark, o, "t", dataset=ws.db, save_mode="Append")
    assert spark.table(ws.table("t")).count() == n_f + n_o
    load_table(spark, f, "t", dataset=ws.db, save_mode="Ignore")
    assert spark.table(ws.table("t")).count() == n_f + n_o
    load_table(spark, o, "t", dataset=ws.db, save_mode="Overwrite")
    assert spark.table(ws.table("t")).count() == n_o


def test_error_if_exists_leaves_target_unchanged(spark, ws):
    load_table(spark, _orders(ws, "F"), "t", dataset=ws.db)
    before = _rows(spark.table(ws.table("t")))
    with pytest.raises(StageError) as e:
        load_table(spark, _orders(ws, "O"), "t", dataset=ws.db, save_mode="ErrorIfExists")
    assert isinstance(e.value.__cause__, TableExists)
    assert _rows(spark.table(ws.table("t"))) == before


def test_create_never(spark, ws):
    with pytest.raises(StageError) as e:
        load_table(spark, _orders(ws), "absent", dataset=ws.db, create_disposition="CREATE_NEVER")
    assert isinstance(e.value.__cause__, TableMissing)
    assert not spark.catalog.tableExists(ws.table("absent"))
    load_table(spark, _orders(ws), "present", dataset=ws.db)
    load_table(spark, _orders(ws, "F"), "present", dataset=ws.db, create_disposition="CREATE_NEVER")
    assert spark.table(ws.table("present")).count() == spark.table(_orders(ws, "F")).count()


def test_config_errors_are_listed_together(spark):
    with pytest.raises(ConfigError) as e:
        load_table(spark, "v", "t", save_mode="Upsert", create_disposition="MAYBE",
                   partition_expiration_ms="soon", clustered_fields="a,b,c,d,e", as_of="yesterday")
    assert len(e.value.errors) == 5


def test_replaced_versions_are_kept_for_a_while(spark, ws):
    stage = f"{ws.dir}/staging"
    load_table(spark, _orders(ws, "F"), "t", dataset=ws.db, staging_dir=stage)
    first = set(files.list_children(spark, stage))
    held = spark.table(ws.table("t"))
    n = held.count()
    load_table(spark, _orders(ws, "O"), "t", dataset=ws.db, staging_dir=stage)
    both = set(files.list_children(spark, stage))
    assert len(both) == 2 and held.count() == n  # a frame over the replaced version still reads
    live = catalog.location(spark, ws.table("t")).rsplit("/", 1)[1]
    assert both == first | {live} and _tables(spark, ws) == ["t"]
    # once its time is over, the next overwrite deletes it, and only it
    old = catalog.properties(spark, ws.table("t"))[catalog.PROP_RETIRED].split("|", 1)[1]
    catalog.set_properties(spark, ws.table("t"), {catalog.PROP_RETIRED: f"0|{old}"})
    load_table(spark, _orders(ws, "F"), "t", dataset=ws.db, staging_dir=stage)
    left = set(files.list_children(spark, stage))
    assert len(left) == 2 and live in left and not first & left


def test_failed_overwrite_keeps_old_table_and_cleans_staging(spark, ws):
    stage = f"{ws.dir}/staging"
    load_table(spark, _orders(ws, "F"), "t", dataset=ws.db, staging_dir=stage,
               required_columns=["o_custkey"])
    before = _rows(spark.table(ws.table("t")))
    bad = ws.view(ws.read("orders").withColumn("o_custkey", F.lit(None).cast("bigint")), "bad")
    with pytest.raises(StageError):
        load_table(spark, bad, "t", dataset=ws.db, staging_dir=stage, required_columns=["o_custkey"])
    assert _rows(spark.table(ws.table("t"))) == before
    assert len(files.list_children(spark, stage)) == 1
    assert _tables(spark, ws) == ["t"]


def test_self_overwrite(spark, ws):
    load_table(spark, _orders(ws), "t", dataset=ws.db)
    kept = ws.view(spark.table(ws.table("t")).filter("o_orderstatus <> 'P'"), "kept")
    out = load_table(spark, kept, "t", dataset=ws.db)
    want = _rows(ws.read("orders").filter("o_orderstatus <> 'P'"))
    assert _rows(spark.table(ws.table("t"))) == want
    assert _rows(out) == want


def test_append_from_itself(spark, ws):
    load_table(spark, _orders(ws, "F"), "t", dataset=ws.db)
    n = spark.table(ws.table("t")).count()
    load_table(spark, ws.view(spark.table(ws.table("t")), "self"), "t", dataset=ws.db, save_mode="Append")
    assert spark.table(ws.table("t")).count() == 2 * n


def test_passthrough_returns_input_rows(spark, ws):
    v = ws.view(ws.read("nation"), "nation")
    assert _rows(load_table(spark, v, "n", dataset=ws.db)) == _rows(ws.read("nation"))
    assert _rows(load_table(spark, v, "n", dataset=ws.db, save_mode="Append")) == _rows(ws.read("nation"))


def test_day_partitions_and_pruning(spark, ws):
    load_table(spark, ws.view(ws.read("events"), "ev"), "ev", dataset=ws.db, partition_field="ts")
    t = ws.table("ev")
    assert catalog.partition_columns(spark, t) == ["__day"]
    days = spark.sql(f"SHOW PARTITIONS {t}").count()
    assert days == ws.read("events").select(F.to_date("ts")).distinct().count()
    plan = explain(spark, spark.table(t).filter("__day = DATE'2024-01-05'"))
    assert "PartitionFilters" in plan and "2024-01-05" in plan


def test_date_field_partitions_by_itself(spark, ws):
    df = ws.read("orders").withColumn("d", F.to_date("o_orderdate")).filter("d < DATE'1995-02-01'")
    load_table(spark, ws.view(df, "od"), "od", dataset=ws.db, partition_field="d")
    assert catalog.partition_columns(spark, ws.table("od")) == ["d"]
    assert "d" in extract_table(spark, "od", dataset=ws.db).df.columns


def test_partition_field_must_be_a_date(spark, ws):
    with pytest.raises(StageError):
        load_table(spark, _orders(ws), "t", dataset=ws.db, partition_field="o_custkey")


def test_expiry_deletes_files_so_repair_cannot_revive(spark, ws):
    load_table(spark, ws.view(ws.read("events"), "ev"), "ev", dataset=ws.db, partition_field="ts",
               partition_expiration_ms=864000000, as_of="2024-01-31T00:00:00")
    t = ws.table("ev")
    kept = spark.table(t).agg(F.min("__day")).first()[0]
    assert kept == dt.date(2024, 1, 22)
    spark.sql(f"MSCK REPAIR TABLE {t}")
    assert spark.table(t).agg(F.min("__day")).first()[0] == dt.date(2024, 1, 22)
    # a later append re-applies the recorded expiry
    old = ws.view(ws.read("events").filter("ts < TIMESTAMP_NTZ'2024-01-05 00:00:00'"), "old")
    load_table(spark, old, "ev", dataset=ws.db, save_mode="Append", as_of="2024-01-31T00:00:00")
    assert spark.table(t).agg(F.min("__day")).first()[0] == dt.date(2024, 1, 22)


def test_expired_days_rule():
    as_of = dt.datetime(2024, 1, 31)
    days = ["2024-01-20", "2024-01-21", "2024-01-22", "__HIVE_DEFAULT_PARTITION__"]
    assert expiry.expired_days(days, 864000000, as_of) == ["2024-01-20", "2024-01-21"]


def test_clustered_files_have_disjoint_ranges(spark, ws):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        load_table(spark, _orders(ws), "c", dataset=ws.db, clustered_fields=["o_custkey"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    per_file = (spark.table(ws.table("c")).groupBy("_metadata.file_path")
                .agg(F.min("o_custkey").alias("lo"), F.max("o_custkey").alias("hi")).orderBy("lo").collect())
    assert len(per_file) > 1
    for a, b in zip(per_file, per_file[1:]):
        assert a["hi"] <= b["lo"]
    assert catalog.properties(spark, ws.table("c"))[catalog.PROP_CLUSTERED] == "o_custkey"


def test_hot_key_is_split_across_tasks(spark, ws):
    # every row has the same clustered value: the tie-breaker still spreads them
    hot = ws.read("lineitem").withColumn("k", F.lit(1))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        load_table(spark, ws.view(hot, "hot"), "hot", dataset=ws.db, clustered_fields="k")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    n_files = spark.table(ws.table("hot")).select("_metadata.file_path").distinct().count()
    assert n_files > 1


def test_clustering_with_a_map_column(spark, ws):
    df = ws.read("nation").withColumn("m", F.create_map(F.lit("k"), F.col("n_regionkey")))
    load_table(spark, ws.view(df, "nm"), "nm", dataset=ws.db, clustered_fields="n_regionkey")
    assert spark.table(ws.table("nm")).count() == 25


def test_day_partitions_without_adaptive_execution(spark, ws):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        load_table(spark, ws.view(ws.read("events"), "ev"), "ev", dataset=ws.db, partition_field="ts",
                   clustered_fields="user_id")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    t = spark.table(ws.table("ev"))
    assert t.count() == ws.read("events").count()
    assert t.filter(F.to_date("ts") != F.col("__day")).count() == 0


def test_field_addition(spark, ws):
    docs = ws.read("documents")
    load_table(spark, ws.view(docs.filter("lang = 'de'").select("doc_id", "lang"), "de"), "d", dataset=ws.db)
    rest = ws.view(docs.filter("lang <> 'de'").select("doc_id", "lang", "n_chars"), "rest")
    with pytest.raises(StageError) as e:
        load_table(spark, rest, "d", dataset=ws.db, save_mode="Append")
    assert isinstance(e.value.__cause__, SchemaMismatch)
    assert spark.table(ws.table("d")).columns == ["doc_id", "lang"]
    load_table(spark, rest, "d", dataset=ws.db, save_mode="Append", allow_field_addition=True)
    t = spark.table(ws.table("d"))
    assert t.columns == ["doc_id", "lang", "n_chars"]
    assert t.filter("lang = 'de'").filter("n_chars IS NOT NULL").count() == 0
    assert t.count() == docs.count()


def test_field_addition_on_partitioned_table(spark, ws):
    ev = ws.read("events")
    load_table(spark, ws.view(ev.select("event_id", "ts"), "narrow"), "ev", dataset=ws.db, partition_field="ts")
    load_table(spark, ws.view(ev.select("event_id", "ts", "value"), "wide"), "ev", dataset=ws.db,
               save_mode="Append", allow_field_addition=True)
    t = spark.table(ws.table("ev"))
    assert t.columns == ["event_id", "ts", "value", "__day"]
    assert t.count() == 2 * ev.count()


def test_missing_nullable_column_is_filled(spark, ws):
    load_table(spark, _orders(ws, "F"), "t", dataset=ws.db)
    narrow = ws.view(ws.read("orders").filter("o_orderstatus = 'O'").select("o_orderkey", "o_custkey"), "n")
    load_table(spark, narrow, "t", dataset=ws.db, save_mode="Append")
    assert spark.table(ws.table("t")).filter("o_totalprice IS NULL").count() == spark.table(narrow).count()


def test_type_change_refused(spark, ws):
    load_table(spark, _orders(ws, "F"), "t", dataset=ws.db)
    changed = ws.view(ws.read("orders").withColumn("o_custkey", F.col("o_custkey").cast("string")), "c")
    with pytest.raises(StageError) as e:
        load_table(spark, changed, "t", dataset=ws.db, save_mode="Append")
    assert isinstance(e.value.__cause__, SchemaMismatch)


def test_field_relaxation(spark, ws):
    labels = ws.read("labels").select("doc_id", "quality")
    load_table(spark, ws.view(labels, "l"), "l", dataset=ws.db, required_columns=["quality"])
    unl = ws.read("documents").join(ws.read("labels"), "doc_id", "left_anti") \
        .select("doc_id", F.lit(None).cast("int").alias("quality"))
    v = ws.view(unl, "u")
    with pytest.raises(StageError):
        load_table(spark, v, "l", dataset=ws.db, save_mode="Append")
    assert spark.table(ws.table("l")).count() == labels.count()
    load_table(spark, v, "l", dataset=ws.db, save_mode="Append", allow_field_relaxation=True)
    assert spark.table(ws.table("l")).count() == ws.read("documents").count()
    assert catalog.properties(spark, ws.table("l")).get(catalog.PROP_REQUIRED) == ""


def test_required_column_missing_needs_relaxation(spark, ws):
    load_table(spark, _orders(ws, "F"), "t", dataset=ws.db, required_columns=["o_totalprice"])
    narrow = ws.view(ws.read("orders").select("o_orderkey"), "n")
    with pytest.raises(StageError) as e:
        load_table(spark, narrow, "t", dataset=ws.db, save_mode="Append")
    assert isinstance(e.value.__cause__, SchemaMismatch)


def test_nested_types_round_trip(spark, ws):
    df = spark.sql("SELECT id, array(CAST(id AS FLOAT), 1.5F) AS a, "
                   "named_struct('x', CAST(id AS INT), 'y', CAST(id AS DECIMAL(38,9))) AS s, "
                   "map('k', CAST(id AS INT)) AS m FROM range(10)")
    load_table(spark, ws.view(df, "nested"), "nested", dataset=ws.db)
    back = extract_table(spark, "nested", dataset=ws.db).df
    assert back.schema.simpleString() == df.schema.simpleString()
    assert _rows(back.select("id", "s.y")) == _rows(df.select("id", "s.y"))


def test_empty_input(spark, ws):
    empty = ws.view(ws.read("orders").limit(0), "empty")
    out = load_table(spark, empty, "e", dataset=ws.db)
    assert out.count() == 0
    assert spark.table(ws.table("e")).columns == ws.read("orders").columns


def test_streaming_input_refused(spark, ws):
    spark.readStream.format("rate").load().createOrReplaceTempView("rate_in")
    with pytest.raises(StageError):
        load_table(spark, "rate_in", "never", dataset=ws.db)
    assert not spark.catalog.tableExists(ws.table("never"))


@pytest.mark.parametrize("name", sorted(LOAD_QUERIES))
def test_repeat_runs_give_same_answer(spark, name):
    a = _rows(LOAD_QUERIES[name](spark, SF001))
    b = _rows(LOAD_QUERIES[name](spark, SF001))
    assert a == b


def test_overlapping_matches_brute_force(spark, ws):
    import random
    from quarry.acceptance.load_checks import overlapping
    rnd = random.Random(7)
    for trial in range(4):
        rows = []
        for i in range(60):
            lo = rnd.randint(0, 200) if trial % 2 else i * 10
            hi = lo + (rnd.randint(0, 30) if trial % 2 else rnd.randint(0, 9))
            rows.append((i, lo, hi))
        df = spark.createDataFrame(rows, "id int, lo int, hi int").repartition(5)
        got = {r["id"]: r["overlaps"] for r in overlapping(df, "lo", "hi", f"{ws.dir}/r{trial}").collect()}
        order = sorted(rows, key=lambda r: (r[1], r[2]))
        want = {}
        for k, (i, lo, hi) in enumerate(order):
            want[i] = any(lo < h for _, _, h in order[:k])
        assert got == want


def test_hot_day_is_split_over_files(spark, ws):
    # a third of the events land on one day; the write must not funnel it into one task
    ev = ws.read("events").repartition(4)
    hot = ev.withColumn("ts", F.when(F.col("event_id") % 3 == 0, F.lit("2024-01-07 12:00:00")
                                     .cast("timestamp_ntz")).otherwise(F.col("ts")))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8k")
    try:
        load_table(spark, ws.view(hot, "hot"), "hot", dataset=ws.db, partition_field="ts")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files_per_day = (spark.table(ws.table("hot")).groupBy("__day")
                     .agg(F.countDistinct("_metadata.file_path").alias("files"), F.count("*").alias("n")))
    hot_day = files_per_day.orderBy(F.desc("n")).first()
    assert str(hot_day["__day"]) == "2024-01-07" and hot_day["files"] > 1
    assert spark.table(ws.table("hot")).count() == ev.count()


def test_expiry_on_unpartitioned_append_refused_before_writing(spark, ws):
    load_table(spark, _orders(ws, "F"), "t", dataset=ws.db)
    n = spark.table(ws.table("t")).count()
    with pytest.raises(StageError):
        load_table(spark, _orders(ws, "O"), "t", dataset=ws.db, save_mode="Append",
                   partition_expiration_ms=1000)
    assert spark.table(ws.table("t")).count() == n


def test_load_refuses_to_overwrite_a_view(spark, ws):
    spark.sql(f"CREATE VIEW {ws.table('v')} AS SELECT * FROM {ws.source('nation')}")
    with pytest.raises(StageError) as e:
        load_table(spark, _orders(ws), "v", dataset=ws.db)
    assert isinstance(e.value.__cause__, TypeError)
    assert spark.catalog.getTable(ws.table("v")).tableType == "VIEW"


def test_append_widens_int_to_bigint(spark, ws):
    base = ws.read("nation").select(F.col("n_nationkey").cast("bigint").alias("k"), "n_name")
    load_table(spark, ws.view(base, "b"), "w", dataset=ws.db)
    narrow = ws.read("nation").select(F.col("n_nationkey").alias("k"), "n_name")  # int
    load_table(spark, ws.view(narrow, "n"), "w", dataset=ws.db, save_mode="Append")
    t = spark.table(ws.table("w"))
    assert dict(t.dtypes)["k"] == "bigint" and t.count() == 50


def test_dotted_column_names(spark, ws):
    df = ws.read("nation").select(F.col("n_nationkey").alias("a.b"), F.col("n_regionkey").alias("r.k"),
                                  F.lit("2024-01-01").cast("date").alias("d.d"))
    load_table(spark, ws.view(df, "dotted"), "dotted", dataset=ws.db, clustered_fields="r.k",
               required_columns=["a.b"])
    load_table(spark, ws.view(df, "dotted"), "dotted", dataset=ws.db, save_mode="Append")
    assert spark.table(ws.table("dotted")).count() == 50


def test_overwrite_keeps_user_properties_and_comment(spark, ws):
    load_table(spark, _orders(ws, "F"), "t", dataset=ws.db)
    spark.sql(f"ALTER TABLE {ws.table('t')} SET TBLPROPERTIES ('team' = 'sales', 'comment' = 'orders by status')")
    load_table(spark, _orders(ws, "O"), "t", dataset=ws.db)
    props = catalog.properties(spark, ws.table("t"))
    assert props["team"] == "sales"
    assert spark.catalog.getTable(ws.table("t")).description == "orders by status"


def test_write_plans(spark, ws):
    from quarry.operators import layout
    ev = ws.read("events")
    day_df, day_col = layout.day_column(ev, "ts")
    plan = explain(spark, layout.lay_out(day_df, day_col, []), "")
    assert plan.count("Exchange ") == 1 and "REBALANCE_PARTITIONS_BY_COL" in plan
    assert "Sort [" not in plan                        # the writer sorts by the day itself
    plan = explain(spark, layout.lay_out(day_df, day_col, ["user_id"]), "")
    assert plan.count("Exchange ") == 1 and "Sort [__day" in plan
    plan = explain(spark, layout.lay_out(ws.read("orders"), None, ["o_custkey"]), "")
    assert "rangepartitioning(o_custkey" in plan and "__quarry_row" in plan and "Sort [o_custkey" in plan
    plan = explain(spark, layout.lay_out(ws.read("orders"), None, []), "")
    assert "Exchange" not in plan                      # unpartitioned, unclustered: no shuffle added


def test_same_shape_overwrite_repoints_in_one_step(spark, ws):
    from quarry.sources.extract import extract_table as _extract
    stage = f"{ws.dir}/staging"
    load_table(spark, _orders(ws, "F"), "t", dataset=ws.db, staging_dir=stage, clustered_fields="o_custkey")
    spark.sql(f"ALTER TABLE {ws.table('t')} SET TBLPROPERTIES ('team' = 'sales')")
    load_table(spark, _orders(ws, "O"), "t", dataset=ws.db, staging_dir=stage)
    props = catalog.properties(spark, ws.table("t"))
    assert props[catalog.PROP_CLUSTERED] == "o_custkey" and props["team"] == "sales"  # settings stay
    load_table(spark, _orders(ws, "O"), "t", dataset=ws.db, staging_dir=stage, clustered_fields=[])
    assert catalog.PROP_CLUSTERED not in catalog.properties(spark, ws.table("t"))  # an empty one drops it
    assert _tables(spark, ws) == ["t"]
    assert _rows(_extract(spark, "t", dataset=ws.db).df) == _rows(spark.table(_orders(ws, "O")))
    # a changed schema still publishes, by drop and rename
    narrow = ws.view(ws.read("orders").select("o_orderkey", "o_custkey"), "narrow")
    load_table(spark, narrow, "t", dataset=ws.db, staging_dir=stage)
    assert spark.table(ws.table("t")).columns == ["o_orderkey", "o_custkey"]


def test_publish_method_is_recorded(spark, ws, caplog):
    import json
    import logging
    with caplog.at_level(logging.INFO, logger="quarry"):
        load_table(spark, _orders(ws, "F"), "p", dataset=ws.db)
        load_table(spark, _orders(ws, "O"), "p", dataset=ws.db)
    loads = [json.loads(r.getMessage()) for r in caplog.records if r.name == "quarry"]
    loads = [e for e in loads if e.get("type") == "load"]
    assert [e["publish"] for e in loads] == ["rename", "set_location"]


def test_failed_field_addition_changes_nothing(spark, ws):
    load_table(spark, _orders(ws, "F"), "t", dataset=ws.db, required_columns=["o_custkey"])
    before_cols = spark.table(ws.table("t")).columns
    n = spark.table(ws.table("t")).count()
    bad = ws.read("orders").withColumn("o_custkey", F.lit(None).cast("bigint")).withColumn("extra", F.lit(1))
    with pytest.raises(StageError):
        load_table(spark, ws.view(bad, "bad"), "t", dataset=ws.db, save_mode="Append",
                   allow_field_addition=True)
    assert spark.table(ws.table("t")).columns == before_cols
    assert spark.table(ws.table("t")).count() == n


def test_field_addition_registers_new_days(spark, ws):
    ev = ws.read("events")
    first = ev.filter("ts < TIMESTAMP_NTZ'2024-01-10 00:00:00'").select("event_id", "ts")
    rest = ev.filter("ts >= TIMESTAMP_NTZ'2024-01-10 00:00:00'").select("event_id", "ts", "value")
    load_table(spark, ws.view(first, "first"), "ev", dataset=ws.db, partition_field="ts")
    load_table(spark, ws.view(rest, "rest"), "ev", dataset=ws.db, save_mode="Append",
               allow_field_addition=True)
    t = spark.table(ws.table("ev"))
    assert t.count() == ev.count()
    assert t.filter("value IS NOT NULL").count() == rest.count()
    days = spark.sql(f"SHOW PARTITIONS {ws.table('ev')}").count()
    assert days == ev.select(F.to_date("ts")).distinct().count()


def test_clustered_range_count_follows_initial_partition_num(spark, ws):
    from quarry.operators import layout
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "64")
    try:
        plan = explain(spark, layout.lay_out(ws.read("orders"), None, ["o_custkey"]), "")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    assert "rangepartitioning(o_custkey" in plan and ", 64), REPARTITION_BY_COL" in plan
