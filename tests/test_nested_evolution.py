"""Fields added inside structs, arrays and maps."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import ArrayType, IntegerType, LongType, MapType, StringType, StructField, StructType

from quarry import StageError, load_table
from quarry.operators import evolution
from quarry.sources import catalog

DEEP = "id int, s struct<a: int, b: array<struct<x: int>>, m: map<string, struct<y: int>>>"
DEEPER = ("id int, s struct<M: map<string, struct<y: int, z: string>>, b: array<struct<w: double, x: int>>, a: int, "
          "c: struct<d: int>>, more string")


def test_fields_at_every_depth(spark, ws):
    old = spark.createDataFrame([(1, (5, [(6,), None], {"k": (7,), "n": None})), (2, None)], DEEP)
    new = spark.createDataFrame([(3, ({"k": (8, "z")}, [(0.5, 9), None], 10, (11,)), "m"), (4, None, None)], DEEPER)
    load_table(spark, ws.view(old, "old"), "t", dataset=ws.db)
    with pytest.raises(StageError) as e:
        load_table(spark, ws.view(new, "new"), "t", dataset=ws.db, save_mode="Append")
    assert "s.b.element.w" in str(e.value) and spark.table(ws.table("t")).count() == 2
    load_table(spark, ws.view(new, "new"), "t", dataset=ws.db, save_mode="Append", allow_field_addition=True)
    got = {r["id"]: r.asDict(True) for r in spark.table(ws.table("t")).collect()}
    assert got[1]["s"] == {"a": 5, "b": [{"x": 6, "w": None}, None], "m": {"k": {"y": 7, "z": None}, "n": None}, "c": None}
    assert got[2]["s"] is None and got[4]["s"] is None and got[1]["more"] is None
    assert got[3] == {"id": 3, "s": {"a": 10, "b": [{"x": 9, "w": 0.5}, None], "m": {"k": {"y": 8, "z": "z"}},
                                     "c": {"d": 11}}, "more": "m"}
    load_table(spark, ws.view(old, "old"), "t", dataset=ws.db, save_mode="Append")  # the narrow shape still goes in
    assert spark.table(ws.table("t")).where("s.c.d IS NULL").count() == 5
    other = spark.newSession()  # the catalog, not this session, knows the new type
    assert other.table(ws.table("t")).where("s.c.d = 11").count() == 1


def test_partitioned_and_once(spark, ws):
    old = spark.sql("SELECT 1 AS id, named_struct('a', 1) AS s, DATE'2024-01-01' AS d")
    new = spark.sql("SELECT 2 AS id, named_struct('a', 2, 'b', 'x') AS s, DATE'2024-01-02' AS d")
    load_table(spark, ws.view(old, "old"), "t", dataset=ws.db, partition_field="d")
    for _ in range(2):
        load_table(spark, ws.view(new, "new"), "t", dataset=ws.db, save_mode="Append", allow_field_addition=True,
                   load_id="new")
    assert sorted((r["id"], r["s"]["b"]) for r in spark.table(ws.table("t")).collect()) == [(1, None), (2, "x")]
    assert catalog.partition_columns(spark, ws.table("t")) == ["d"]


def test_what_does_not_go_together(spark, ws):
    old = spark.sql("SELECT 1 AS id, named_struct('a', 1) AS s, map('k', 1) AS m, array(1) AS l")
    load_table(spark, ws.view(old, "old"), "t", dataset=ws.db)
    for expr in ("1 AS s", "named_struct('a', 'text') AS s", "map(1, 1) AS m", "array('x') AS l", "array(array(1)) AS l"):
        with pytest.raises(StageError):
            load_table(spark, ws.view(spark.sql(f"SELECT 1 AS id, {expr}"), "bad"), "t", dataset=ws.db,
                       save_mode="Append", allow_field_addition=True)
    wider = spark.sql("SELECT 2 AS id, named_struct('a', CAST(2 AS SMALLINT)) AS s")  # widens losslessly, inside too
    load_table(spark, ws.view(wider, "wider"), "t", dataset=ws.db, save_mode="Append")
    assert spark.table(ws.table("t")).where("s.a = 2").count() == 1


leaves = st.sampled_from([IntegerType(), LongType(), StringType()])
kinds = st.recursive(leaves, lambda k: st.one_of(
    k.map(ArrayType), k.map(lambda v: MapType(StringType(), v)),
    st.dictionaries(st.sampled_from("abcd"), k, min_size=1, max_size=3).map(
        lambda d: StructType([StructField(n, t) for n, t in d.items()]))), max_leaves=6)


def paths(kind, at=""):
    if isinstance(kind, StructType):
        return {p for f in kind.fields for p in paths(f.dataType, f"{at}.{f.name}")}
    if isinstance(kind, ArrayType):
        return paths(kind.elementType, f"{at}[]")
    if isinstance(kind, MapType):
        return paths(kind.valueType, f"{at}{{}}")
    return {at}


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(table=kinds, incoming=kinds)
def test_merge_keeps_every_field_of_both(spark, table, incoming):
    new: list[str] = []
    merged = evolution.merge(table, incoming, "c", new)
    if merged is None:
        return
    assert paths(merged) == paths(table) | paths(incoming)
    assert bool(new) == bool(paths(incoming) - paths(table))
    df = spark.createDataFrame([], StructType([StructField("c", incoming)]))
    out = df.select(evolution.rebuilt(df["c"], incoming, merged).alias("c"))
    assert out.schema["c"].dataType.simpleString() == merged.simpleString()
