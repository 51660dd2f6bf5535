import pytest
from pyspark.sql import functions as F

from conftest import explain
from quarry import ConfigError, StageError, extract_table, load_table
from quarry.functions.names import qualify, split_name
from quarry.sources import files
from quarry.sources.extract import ViewsNotEnabled
from quarry.sources.metadata import column_descriptions
from quarry.streaming.guards import StreamingNotSupported


def test_qualify_names():
    assert qualify("t") == "`t`"
    assert qualify("t", "d") == "`d`.`t`"
    assert qualify("t", "d", "p") == "`p`.`d`.`t`"
    assert qualify("d.t") == "`d`.`t`"
    assert split_name("`a.b`.c") == ["a.b", "c"]


def test_project_is_a_catalog(spark, ws):
    df = extract_table(spark, "nation", dataset=ws.src, project="spark_catalog").df
    assert df.count() == 25
    with pytest.raises(StageError):
        extract_table(spark, "nation", dataset=ws.src, project="no_such_catalog")


def test_scan_is_lazy_and_registers_view(spark, ws):
    r = extract_table(spark, "orders", dataset=ws.src, output_view="t_orders")
    assert r.stats == {"output_columns": 6, "num_partitions": 1}
    assert "records" not in r.stats
    assert extract_table(spark, "orders", dataset=ws.src, num_partitions=5).stats["num_partitions"] == 5
    assert "num_partitions" not in extract_table(spark, "orders", dataset=ws.src,
                                                 partition_by=["o_custkey"]).stats
    assert spark.table("t_orders").count() == 1500


def test_count_reads_no_columns(spark, ws):
    df = extract_table(spark, "lineitem", dataset=ws.src).df
    plan = explain(spark, df.groupBy().count())
    assert "ReadSchema: struct<>" in plan


def test_filter_and_projection_reach_the_scan(spark, ws):
    df = extract_table(spark, "orders", dataset=ws.src).df
    plan = explain(spark, df.filter(F.col("o_orderstatus") == "F").select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_missing_table_raises_with_detail(spark, ws):
    with pytest.raises(StageError) as e:
        extract_table(spark, "nope", dataset=ws.db, output_view="x")
    assert e.value.detail["table"] == "nope"


def test_config_errors_are_listed_together(spark):
    with pytest.raises(ConfigError) as e:
        extract_table(spark, "", max_parallelism=0, num_partitions=-1, storage_level="FAST")
    assert len(e.value.errors) == 4


def test_cap_is_strict(spark, ws):
    ws.read("lineitem").repartition(6).write.saveAsTable(ws.table("li6"))
    r = extract_table(spark, "li6", dataset=ws.db, max_parallelism=2, collect_stats=True)
    assert r.stats["num_partitions"] <= 2
    assert r.df.count() == 6000


def test_views_need_enabling(spark, ws):
    spark.sql(f"CREATE VIEW {ws.table('v')} AS SELECT o_custkey FROM {ws.source('orders')}")
    with pytest.raises(StageError) as e:
        extract_table(spark, "v", dataset=ws.db)
    assert isinstance(e.value.__cause__, ViewsNotEnabled)
    assert extract_table(spark, "v", dataset=ws.db, views_enabled=True).df.count() == 1500


def test_view_materialization_reads_a_table(spark, ws):
    spark.sql(f"CREATE VIEW {ws.table('v')} AS SELECT o_custkey, count(*) AS n "
              f"FROM {ws.source('orders')} GROUP BY o_custkey")
    r = extract_table(spark, "v", dataset=ws.db, views_enabled=True, view_materialization_dataset=ws.db)
    name = r.detail["materializedAs"]
    assert spark.catalog.getTable(name).tableType in ("MANAGED", "EXTERNAL")
    assert "Exchange" not in explain(spark, r.df)  # the aggregate already ran once


def test_expired_materializations_are_dropped(spark, ws):
    spark.sql(f"CREATE VIEW {ws.table('v')} AS SELECT n_regionkey, count(*) AS n "
              f"FROM {ws.source('nation')} GROUP BY n_regionkey")
    first = extract_table(spark, "v", dataset=ws.db, views_enabled=True, view_materialization_dataset=ws.db)
    old = first.detail["materializedAs"]
    spark.sql(f"ALTER TABLE {old} SET TBLPROPERTIES ('quarry.expires_at' = '2000-01-01T00:00:00+00:00')")
    second = extract_table(spark, "v", dataset=ws.db, views_enabled=True, view_materialization_dataset=ws.db)
    assert not spark.catalog.tableExists(old)
    assert spark.catalog.tableExists(second.detail["materializedAs"])
    assert second.df.count() == 5


def test_metadata_view_wins_over_file(spark, ws):
    path = f"{ws.dir}/md.json"
    files.write_text(spark, path, '{"name": "o_orderkey", "metadata": {"description": "from file"}}\n')
    md = spark.createDataFrame([("o_orderkey", '{"description": "from view", "pii": false}')],
                               "name string, metadata string")
    md.createOrReplaceTempView("md_view")
    df = extract_table(spark, "orders", dataset=ws.src, schema_uri=path, schema_view="md_view").df
    assert df.schema["o_orderkey"].metadata == {"description": "from view", "pii": False}
    assert df.schema["o_custkey"].metadata == {}


def test_metadata_json_array_file(spark, ws):
    path = f"{ws.dir}/md.json"
    files.write_text(spark, path, '[{"name": "o_custkey", "description": "customer"}]')
    df = extract_table(spark, "orders", dataset=ws.src, schema_uri=path).df
    assert column_descriptions(df) == [("o_custkey", "customer")]


def test_metadata_for_unknown_column_raises(spark, ws):
    md = spark.createDataFrame([("nope", "{}")], "name string, metadata string")
    md.createOrReplaceTempView("md_bad")
    with pytest.raises(StageError):
        extract_table(spark, "orders", dataset=ws.src, schema_view="md_bad")


def test_repartition_plans(spark, ws):
    rr = extract_table(spark, "lineitem", dataset=ws.src, num_partitions=5).df
    assert "RoundRobinPartitioning(5)" in explain(spark, rr)
    hashed = extract_table(spark, "lineitem", dataset=ws.src, num_partitions=5, partition_by=["l_orderkey"]).df
    plan = explain(spark, hashed)
    assert "hashpartitioning(l_orderkey" in plan and ", 5)" in plan
    # a later aggregate on the same key reuses the partitioning: one Exchange only
    agg = hashed.groupBy("l_orderkey").count()
    assert explain(spark, agg).count("+- Exchange") == 1


def test_bad_partition_column_raises_with_detail(spark, ws):
    with pytest.raises(StageError) as e:
        extract_table(spark, "orders", dataset=ws.src, partition_by=["nope"])
    assert e.value.detail["partitionBy"] == ["nope"]


def test_persist_fills_cache(spark, ws):
    r = extract_table(spark, "orders", dataset=ws.src, persist=True, output_view="cached_orders")
    assert r.stats["records"] == 1500
    assert "InMemoryTableScan" in explain(spark, spark.table("cached_orders"))
    r.df.unpersist()


def test_immutable_view(spark, ws):
    extract_table(spark, "nation", dataset=ws.src, output_view="imm_v", immutable_view=True)
    with pytest.raises(StageError):
        extract_table(spark, "region", dataset=ws.src, output_view="imm_v", immutable_view=True)
    assert spark.table("imm_v").count() == 25
    extract_table(spark, "region", dataset=ws.src, output_view="imm_v")  # replace allowed
    assert spark.table("imm_v").count() == 5
    spark.catalog.dropTempView("imm_v")


def test_streaming_refused_before_anything_else(spark, ws):
    stream = spark.readStream.format("rate").load()
    stream.createOrReplaceTempView("rate_v")
    with pytest.raises(StageError) as e:
        extract_table(spark, "rate_v", schema_view="no_such_view")
    assert isinstance(e.value.__cause__, StreamingNotSupported)


def test_day_range_prunes_partitions(spark, ws):
    ws.view(ws.read("events"), "ev")
    load_table(spark, f"{ws.db}__ev", "ev", dataset=ws.db, partition_field="ts")
    df = extract_table(spark, "ev", dataset=ws.db, day_range=("2024-01-03", "2024-01-04")).df
    assert "__day" not in df.columns
    plan = explain(spark, df)
    assert "PartitionFilters: [isnotnull(__day" in plan
    n = ws.read("events").filter(F.to_date("ts").between("2024-01-03", "2024-01-04")).count()
    assert df.count() == n


def test_empty_table(spark, ws):
    ws.read("orders").limit(0).write.saveAsTable(ws.table("empty"))
    r = extract_table(spark, "empty", dataset=ws.db, persist=True)
    assert r.stats["records"] == 0
    assert r.df.columns == ws.read("orders").columns


def test_day_range_accepts_dates_datetimes_and_open_ends():
    import datetime as dt
    from quarry.sources.extract import _as_date
    assert _as_date("2024-01-03") == dt.date(2024, 1, 3)
    assert _as_date("2024-01-03T10:00:00") == dt.date(2024, 1, 3)
    assert _as_date(dt.datetime(2024, 1, 3, 5)) == dt.date(2024, 1, 3)
    assert _as_date(None) is None


def test_metadata_on_a_wide_frame_is_one_projection(spark, ws):
    from quarry.sources.metadata import attach_metadata
    wide = spark.range(3).select(*[F.col("id").alias(f"c{i}") for i in range(300)])
    pairs = [(f"C{i}", {"description": f"column {i}"}) for i in range(300)]
    out = attach_metadata(wide, pairs)
    assert out.schema["c299"].metadata == {"description": "column 299"}
    assert out.count() == 3


def test_cap_plan_is_a_coalesce_without_shuffle(spark, ws):
    df = extract_table(spark, "lineitem", dataset=ws.src, max_parallelism=3).df
    plan = explain(spark, df, "")
    assert "Coalesce 3" in plan and "Exchange" not in plan


def test_partition_by_accepts_a_comma_separated_string(spark, ws):
    df = extract_table(spark, "lineitem", dataset=ws.src, partition_by="l_orderkey, l_linenumber").df
    assert "hashpartitioning(l_orderkey#" in explain(spark, df, "") and "l_linenumber#" in explain(spark, df, "")
