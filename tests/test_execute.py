import pytest

from quarry import ConfigError, StageError, execute_sql
from quarry.acceptance.workspace import Workspace
from quarry.functions.params import MissingParameter, statements_of, substitute
from quarry.sources import files


def test_substitute():
    assert substitute("a = '${x}' AND b = ${ y }", {"x": "1", "y": 2}) == "a = '1' AND b = 2"
    with pytest.raises(MissingParameter):
        substitute("${nope}", {})


def test_ctas_runs_and_returns_none(spark, ws):
    assert execute_sql(spark, f"CREATE TABLE {ws.table('t')} AS SELECT * FROM nation", dataset=ws.src) is None
    assert spark.table(ws.table("t")).count() == 25


def test_uri_wins_over_inline(spark, ws):
    path = f"{ws.dir}/q.sql"
    files.write_text(spark, path, f"CREATE TABLE {ws.table('from_file')} AS SELECT * FROM region")
    execute_sql(spark, f"CREATE TABLE {ws.table('inline')} AS SELECT 1 AS x", input_uri=path, dataset=ws.src)
    assert spark.catalog.tableExists(ws.table("from_file"))
    assert not spark.catalog.tableExists(ws.table("inline"))


def test_params_text_and_values(spark, ws):
    execute_sql(spark, f"CREATE TABLE ${{db}}.p AS SELECT * FROM orders WHERE o_orderstatus = :s",
                sql_params={"db": ws.db, "s": "F"}, dataset=ws.src)
    n = ws.read("orders").filter("o_orderstatus = 'F'").count()
    assert spark.table(ws.table("p")).count() == n


def test_identifier_parameter(spark, ws):
    execute_sql(spark, f"CREATE TABLE {ws.table('i')} AS SELECT count(*) AS n FROM IDENTIFIER(:t)",
                sql_params={"t": ws.source("region")})
    assert spark.table(ws.table("i")).first()["n"] == 5


def test_missing_text_parameter_is_a_config_error(spark):
    with pytest.raises(ConfigError):
        execute_sql(spark, "SELECT ${missing}")


def test_unbound_marker_fails_at_run_time(spark, ws):
    with pytest.raises(StageError) as e:
        execute_sql(spark, "SELECT :nope AS x", sql_params={"other": 1})
    assert "UNBOUND_SQL_PARAMETER" in str(e.value)


def test_runtime_error_carries_detail(spark, ws):
    with pytest.raises(StageError) as e:
        execute_sql(spark, "SELECT assert_true(o_totalprice < 0) FROM orders", dataset=ws.src, job_name="boom")
    assert e.value.detail["jobName"] == "boom"
    assert "assert_true(o_totalprice < 0)" in e.value.detail["sql"]


def test_bare_select_is_forced(spark, ws):
    # lazily this would succeed; forced, the failing check fails the job
    with pytest.raises(StageError):
        execute_sql(spark, "SELECT assert_true(n_nationkey < 0) FROM nation", dataset=ws.src)


def test_namespace_restored_after_failure(spark, ws):
    before = (spark.catalog.currentCatalog(), spark.catalog.currentDatabase())
    with pytest.raises(StageError):
        execute_sql(spark, "SELECT * FROM no_such_table", dataset=ws.db)
    assert (spark.catalog.currentCatalog(), spark.catalog.currentDatabase()) == before


def test_jobs_are_tagged_and_tag_removed(spark, ws):
    execute_sql(spark, "SELECT count(*) FROM lineitem", dataset=ws.src, job_name="count-li")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("count-li")
    assert "count-li" not in spark.getTags()
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None


def test_default_job_name_uses_job_id(spark, ws):
    with pytest.raises(StageError) as e:
        execute_sql(spark, "SELECT * FROM no_such_table", job_id="42")
    assert e.value.detail["jobName"].startswith("jobId_42_")


def test_scripting_block_runs(spark, ws):
    execute_sql(spark, f"BEGIN CREATE TABLE {ws.table('a')} AS SELECT 1 AS x; "
                       f"INSERT INTO {ws.table('a')} VALUES (2); END")
    assert spark.table(ws.table("a")).count() == 2


def test_standard_sql_mode_for_the_call(spark, ws):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(StageError):  # ANSI cast error despite the session setting
            execute_sql(spark, "SELECT CAST(n_name AS INT) FROM nation", dataset=ws.src)
        assert spark.conf.get("spark.sql.ansi.enabled") == "false"
        execute_sql(spark, f"CREATE TABLE {ws.table('lax')} AS SELECT CAST(n_name AS INT) AS x FROM nation",
                    dataset=ws.src, ansi=False)
        assert spark.table(ws.table("lax")).filter("x IS NULL").count() == 25
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_stage_logs_detail_with_duration(spark, ws, caplog):
    import json
    import logging
    with caplog.at_level(logging.INFO, logger="quarry"):
        execute_sql(spark, "SELECT 1", job_name="logged")
        with pytest.raises(StageError):
            execute_sql(spark, "SELECT * FROM nope", job_name="logged-fail")
    events = [json.loads(r.getMessage()) for r in caplog.records if r.name == "quarry"]
    ok = [e for e in events if e["jobName"] == "logged"][0]
    bad = [e for e in events if e["jobName"] == "logged-fail"][0]
    assert ok["event"] == "exit" and ok["durationMs"] >= 0 and ok["sql"] == "SELECT 1"
    assert bad["event"] == "failed"


def test_multi_statement_text_runs_as_a_script(spark, ws):
    text = (f"CREATE TABLE {ws.table('s')} AS SELECT n_nationkey FROM nation;\n"
            f"INSERT INTO {ws.table('s')} SELECT r_regionkey FROM region; -- five more\n")
    execute_sql(spark, text, dataset=ws.src)
    assert spark.table(ws.table("s")).count() == 30
    with pytest.raises(StageError):
        execute_sql(spark, f"CREATE TABLE {ws.table('s2')} AS SELECT 1 AS x; SELECT 2", script=False)
    assert not spark.catalog.tableExists(ws.table("s2"))


def test_script_with_a_failing_statement_raises(spark, ws):
    with pytest.raises(StageError) as e:
        execute_sql(spark, f"CREATE TABLE {ws.table('f')} AS SELECT 1 AS x; SELECT * FROM missing_table",
                    dataset=ws.src)
    assert e.value.detail["sql"] == "SELECT * FROM missing_table"


def test_join_strategy_is_catalysts_size_checked_choice(spark, ws):
    from quarry.plans.statements import SPARK
    spark.sql(f"USE {ws.src}")
    try:
        plan = spark.sql("EXPLAIN " + SPARK["sql_inner_join"]).collect()[0][0]
        assert "BroadcastHashJoin" in plan                 # dimensions far under the threshold
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = spark.sql("EXPLAIN " + SPARK["sql_inner_join"]).collect()[0][0]
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("USE default")


def test_a_script_collects_nothing(spark, ws):
    """A SELECT in a script that is larger than any result the driver may take."""
    execute_sql(spark, f"SELECT 1; CREATE TABLE {ws.table('made')} AS SELECT 1 AS a; "
                       "SELECT id, repeat('x', 1000) FROM range(200000) -- ; no end here\n;", job_name="big")
    assert spark.table(ws.table("made")).count() == 1
    assert [s.strip()[:6] for s in statements_of("SELECT 1; SELECT ';'")] == ["SELECT", "SELECT"]


def test_threads_make_tables_in_their_own_database(spark):
    from concurrent.futures import ThreadPoolExecutor

    spaces = [Workspace(spark, "/root/testdata/sf0.001", "test") for _ in range(2)]
    before = spark.catalog.currentDatabase()

    def make(k):
        ws = spaces[k % 2]
        execute_sql(spark, f"CREATE TABLE made_{k} AS SELECT {k} AS k", dataset=ws.db)
        return spark.catalog.tableExists(ws.table(f"made_{k}"))

    with ThreadPoolExecutor(8) as pool:
        assert all(pool.map(make, range(50)))
    assert spark.catalog.currentDatabase() == before


def test_a_parameter_in_both_forms(spark, ws):
    execute_sql(spark, f"CREATE TABLE {ws.table('both')} AS SELECT '${{p}}' AS a, :p AS b", sql_params={"p": "x"})
    assert spark.table(ws.table("both")).first() == ("x", "x")


def test_placeholders_of_a_file_are_checked_first(spark, ws):
    path = f"{ws.dir}/q.sql"
    files.write_text(spark, path, "SELECT ${missing}")
    with pytest.raises(ConfigError):
        execute_sql(spark, input_uri=path)


def test_calls_in_threads_overlap(spark):
    import time
    from concurrent.futures import ThreadPoolExecutor

    def dawdle(k):
        time.sleep(4)
        return k

    spark.udf.register("dawdle", dawdle, "long")
    spaces = [Workspace(spark, "/root/testdata/sf0.001", "test") for _ in range(2)]
    before = (spark.catalog.currentCatalog(), spark.catalog.currentDatabase(), spark.conf.get("spark.sql.ansi.enabled"))

    def make(ws):
        began = time.time()
        execute_sql(spark, f"CREATE TABLE slow AS SELECT dawdle(n_nationkey) AS k FROM {ws.source('nation')} "
                           "WHERE n_nationkey = 1", dataset=ws.db)
        return began, time.time()

    with ThreadPoolExecutor(2) as pool:
        (a, b), (c, d) = pool.map(make, spaces)
    assert min(b, d) - max(a, c) > 2  # of statements that take four seconds each
    assert all(spark.table(ws.table("slow")).count() == 1 for ws in spaces)
    after = (spark.catalog.currentCatalog(), spark.catalog.currentDatabase(), spark.conf.get("spark.sql.ansi.enabled"))
    assert after == before


def test_a_call_leaves_its_temp_views_and_nothing_else(spark, ws):
    name = f"{ws.db}_v"
    spark.createDataFrame([(1,)], "a int").createOrReplaceTempView(f"{name}_old")
    execute_sql(spark, f"SET spark.sql.shuffle.partitions = 3; CREATE TEMP VIEW {name} AS SELECT 7 AS x; "
                       f"DROP VIEW {name}_old")
    assert spark.conf.get("spark.sql.shuffle.partitions") != "3"
    assert spark.table(name).first()["x"] == 7
    assert not spark.catalog.tableExists(f"{name}_old")
    execute_sql(spark, f"CREATE TABLE {ws.table('from_view')} AS SELECT * FROM {name}")
    assert spark.table(ws.table("from_view")).first()["x"] == 7
    execute_sql(spark, f"CREATE OR REPLACE TEMP VIEW {name} AS SELECT n_name FROM {ws.source('nation')}")
    assert spark.table(name).count() == 25
    assert spark.sparkContext.parallelize([(1,)]).toDF(["a"]).sparkSession is spark


def test_a_failed_call_changes_no_view(spark, ws):
    name = f"{ws.db}_w"
    with pytest.raises(StageError):
        execute_sql(spark, f"CREATE TEMP VIEW {name} AS SELECT 1 AS x; SELECT * FROM missing_table")
    assert not spark.catalog.tableExists(name)
