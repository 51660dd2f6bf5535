"""Functions known to one call of execute_sql: results, plans, refusals."""

import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import explain
from quarry import ConfigError, StageError, execute_sql
from quarry.functions import batched
from quarry.operators.batched import histogram_quantile, sessions

CALL = ("SELECT key, result FROM q(TABLE(SELECT * FROM q_partial(TABLE(SELECT k, v FROM {0}))) PARTITION BY key)")


def quantile(values, at, width):
    buckets = sorted(math.floor(v / width) for v in values if v is not None and math.isfinite(v))
    return buckets[math.ceil(at * len(buckets)) - 1] * float(width) if buckets else None


@pytest.mark.parametrize("held", [1, 7, 100_000])
def test_aggregate_equals_brute_force(spark, ws, monkeypatch, held):
    """Null and hot keys, null, NaN and infinite values, a key without a value; states merged at every size."""
    monkeypatch.setattr(batched, "HELD", held)
    r = random.Random(held)
    rows = [(None if k % 11 == 0 else "hot" if k % 3 else f"k{k % 40}", r.choice([None, math.nan, math.inf, 0.0, -0.5])
             if k % 13 == 0 else r.uniform(-500, 500)) for k in range(3000)] + [("none", None)] * 3
    spark.createDataFrame(rows, "k string, v double").repartition(5).createOrReplaceTempView("measures")
    execute_sql(spark, f"CREATE TABLE {ws.table('q')} AS " + CALL.format("measures"),
                functions={"q": histogram_quantile(0.37, 10)})
    by_key = {}
    for k, v in rows:
        by_key.setdefault(k, []).append(v)
    expected = {k: q for k, v in by_key.items() if (q := quantile(v, 0.37, 10)) is not None}
    got = [tuple(x) for x in spark.table(ws.table("q")).collect()]
    assert len(got) == len(expected) and dict(got) == expected


def test_empty_table_gives_no_rows(spark, ws):
    spark.createDataFrame([], "k string, v double").createOrReplaceTempView("nothing")
    execute_sql(spark, f"CREATE TABLE {ws.table('q')} AS " + CALL.format("nothing"),
                functions={"q": histogram_quantile(0.5, 1)})
    execute_sql(spark, f"CREATE TABLE {ws.table('s')} AS SELECT * FROM s(TABLE(SELECT 1L AS k, v FROM "
                       "(SELECT CAST(v AS BIGINT) AS v FROM nothing)) PARTITION BY k ORDER BY v)",
                functions={"s": sessions(1)})
    assert spark.table(ws.table("q")).count() == spark.table(ws.table("s")).count() == 0


def test_sessions_across_batches(spark, ws):
    """Ties, repeated rows, null keys and times; sessions that reach over several Arrow batches."""
    r = random.Random(5)
    rows = [(None if k % 9 == 0 else k % 4, None if k % 50 == 0 else r.randrange(3000)) for k in range(2000)]
    spark.createDataFrame(rows, "k long, t long").repartition(4).createOrReplaceTempView("clicks")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        execute_sql(spark, f"CREATE TABLE {ws.table('s')} AS SELECT * FROM s(TABLE(SELECT k, t FROM clicks) "
                           "PARTITION BY k ORDER BY t)", functions={"s": sessions(5)})
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    expected = []
    for key in (None, 0, 1, 2, 3):
        last = None
        for t in sorted(t for k, t in rows if k == key and t is not None):
            if last is None or t - last > 5:
                expected.append([key, t, t, 0])
            expected[-1][2:] = [t, expected[-1][3] + 1]
            last = t
    assert sorted(map(repr, map(list, spark.table(ws.table("s")).collect()))) == sorted(map(repr, expected))


def test_plan_has_states_in_the_shuffle_and_no_row_worker(spark):
    spark.range(1000).selectExpr("CAST(id % 3 AS STRING) AS k", "CAST(id AS DOUBLE) AS v").createOrReplaceTempView("m")
    own = spark.newSession()
    spark.table("m").createOrReplaceGlobalTempView("m_plan")
    batched.register(own, {"q": histogram_quantile(0.5, 1)})
    plan = explain(own, own.sql(CALL.format("global_temp.m_plan")), "")
    lines = [line for line in plan.splitlines() if "ArrowEvalPythonUDTF" in line or "Exchange" in line]
    assert ["ArrowEvalPythonUDTF" in line for line in lines] == [True, False, True], plan  # partial, shuffle, merge
    assert "BatchEvalPython" not in plan
    spark.catalog.dropGlobalTempView("m_plan")


def test_functions_end_with_the_call(spark, ws):
    @F.arrow_udf("double")
    def middle(v: pa.Array) -> float:
        return sorted(v.to_pylist())[len(v) // 2]

    execute_sql(spark, f"CREATE TABLE {ws.table('m')} AS SELECT middle(o_totalprice) AS m FROM orders",
                dataset=ws.src, functions={"middle": middle})
    prices = sorted(r[0] for r in ws.read("orders").select("o_totalprice").collect())
    assert spark.table(ws.table("m")).first()["m"] == prices[len(prices) // 2]
    with pytest.raises(StageError):
        execute_sql(spark, "SELECT middle(o_totalprice) FROM orders", dataset=ws.src)


def test_refusals(spark):
    class Rows:
        def eval(self, x: int):
            yield (x,)

    by_row = {"f": F.udf(lambda x: x, "long"), "t": F.udtf(Rows, returnType="x long"), "plain": len, "not a name": None}
    with pytest.raises(ConfigError) as e:
        execute_sql(spark, "SELECT 1", functions=by_row)
    assert len(e.value.errors) == 4
    with pytest.raises(ConfigError):
        execute_sql(spark, "SELECT 1", functions=[len])
    with pytest.raises(ValueError):
        histogram_quantile(0, 1)
