"""As-of and interval joins against brute force, their plans, and hot keys."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators.asof import asof_join
from quarry.operators.intervals import interval_join
from tests.conftest import explain


def brute_asof(left, right, exact=True, forward=False):
    out = []
    for lid, k, t in left:
        fits = [r for r in right if None not in (k, t, r[1], r[2]) and r[1] == k
                and (r[2] == t and exact or (r[2] > t if forward else r[2] < t))]
        pick = (min if forward else max)(fits, key=lambda r: (r[2], r[0]), default=(None, None, None))
        out.append((lid, k, t, pick[0], pick[2]))
    return sorted(out, key=repr)


def frames(spark, left, right, parts=4):
    return (spark.createDataFrame(left, "lid long, k int, t long").repartition(parts),
            spark.createDataFrame(right, "rid long, k int, t long").repartition(parts))


@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_asof_equals_brute_force(spark, exact, direction):
    r = random.Random(direction + str(exact))
    value = lambda n: None if r.random() < 0.05 else r.randrange(n)
    left = [(i, 1 if i % 3 == 0 else value(6), value(60)) for i in range(300)]  # a third has one key
    right = [(i, 1 if i % 3 == 0 else value(6), value(60)) for i in range(120)]
    a, b = frames(spark, left, right)
    got = asof_join(a, b, left_on="t", right_on="t", by=["k"], ties=["rid"], exact=exact, direction=direction)
    assert got.columns == ["lid", "k", "t", "rid", "t_right"]
    want = brute_asof(left, right, exact, direction == "forward")
    assert sorted(map(tuple, got.collect()), key=repr) == want
    inner = asof_join(a, b, left_on="t", right_on="t", by=[("k", "k")], ties=["rid"], exact=exact, direction=direction,
                      how="inner")
    assert sorted(map(tuple, inner.collect()), key=repr) == [x for x in want if x[3] is not None]


def test_asof_carries_over_many_parts(spark):
    """One match long ago, then only left rows of the same hot key in all later parts."""
    left = [(i, 5, 10 + i) for i in range(4000)]
    a, b = frames(spark, left, [(77, 5, 3), (78, 4, 9), (79, 6, 1)])
    got = asof_join(a, b, left_on="t", right_on="t", by=["k"], ties=["rid"])
    assert got.select(F.spark_partition_id()).distinct().count() >= 1
    assert {r["rid"] for r in got.collect()} == {77} and got.count() == 4000


def test_asof_without_keys_and_with_odd_columns(spark):
    a = spark.createDataFrame([(1, 5.0, {"x": 1}), (2, 1.0, None)], "`a.b` int, at double, own map<string,int>")
    b = spark.createDataFrame([(9, 4.0), (8, 4.5)], "part int, at double")
    got = asof_join(a, b, left_on="at", right_on="at")
    assert got.columns == ["a.b", "at", "own", "part", "at_right"]
    assert sorted(map(tuple, got.collect())) == [(1, 5.0, {"x": 1}, 8, 4.5), (2, 1.0, None, None, None)]
    empty = b.where("false")
    assert asof_join(a, empty, left_on="at", right_on="at").where("part is null").count() == 2
    assert asof_join(a.where("false"), b, left_on="at", right_on="at").count() == 0
    with pytest.raises(ValueError):
        asof_join(a, b, left_on="at", right_on="at", direction="sideways")


def test_asof_spreads_a_hot_key(spark):
    a = spark.range(20_000).selectExpr("id AS lid", "1 AS k", "id AS t")
    b = spark.range(0, 20_000, 7).selectExpr("id AS rid", "1 AS k", "id AS t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = asof_join(a, b, left_on="t", right_on="t", by=["k"])
        plan = explain(spark, got)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert got.where("rid <> lid - lid % 7").count() == 0 and got.count() == 20_000
        counts = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert max(counts) < 10_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def brute_intervals(left, right, closed):
    return sorted((a[0], b[0]) for a in left for b in right if None not in a and None not in b and a[1] == b[1]
                  and a[2] <= a[3] and b[2] <= b[3]
                  and (a[2] <= b[3] and b[2] <= a[3] if closed else
                       a[2] < b[3] and b[2] < a[3] and a[2] < a[3] and b[2] < b[3]))


def interval_rows(r, n, key_share):
    rows = []
    for i in range(n):
        start = r.randrange(-2000, 2000)
        length = r.choice([0, 0, 1, 3, r.randrange(50), r.randrange(3000), -5])
        k = 1 if r.random() < key_share else r.choice([None, 2, 3])
        rows.append((i, k, None if r.random() < 0.03 else start, start + length))
    return rows


@pytest.mark.parametrize("closed", [True, False])
def test_intervals_equal_brute_force(spark, closed):
    r = random.Random(closed)
    left, right = interval_rows(r, 250, 0.5), interval_rows(r, 250, 0.5)
    schema = "{0}id long, k int, {0}s long, {0}e long"
    a, b = (spark.createDataFrame(x, schema.format(n)) for x, n in ((left, "l"), (right, "r")))
    got = interval_join(a, b, left_interval=("ls", "le"), right_interval=("rs", "re"), by=["k"], closed=closed)
    assert got.columns == ["lid", "k", "ls", "le", "rid", "k_right", "rs", "re"]
    assert sorted((x["lid"], x["rid"]) for x in got.collect()) == brute_intervals(left, right, closed)
    plan = explain(spark, got)
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-(1 << 62), 1 << 62), st.integers(0, 1 << 62)), max_size=6),
       st.lists(st.tuples(st.integers(-300, 300), st.integers(0, 300)), max_size=6))
def test_intervals_of_any_length(spark, wide, narrow):
    left = [(i, 0, s, min(s + n, (1 << 63) - 1)) for i, (s, n) in enumerate(wide)]
    right = [(i, 0, s, s + n) for i, (s, n) in enumerate(narrow)]
    a, b = (spark.createDataFrame(x, "id long, k int, s long, e long") for x in (left, right))
    got = interval_join(a, b, left_interval=("s", "e"), right_interval=("s", "e"), by=["k"])
    assert sorted((x["id"], x["id_right"]) for x in got.collect()) == brute_intervals(left, right, True)


def test_intervals_of_other_types(spark):
    day = dt.date(2024, 1, 1)
    rows = [(i, day + dt.timedelta(i), day + dt.timedelta(i + 2), float(i), i + 0.5,
             dt.datetime(2024, 1, 1, i), dt.datetime(2024, 1, 1, i, 0, 0, 5)) for i in range(6)]
    schema = "id int, d1 date, d2 date, f1 double, f2 double, t1 {0}, t2 {0}"
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame(rows, schema.format(kind))
        for names, distance in ((("d1", "d2"), 2), (("f1", "f2"), 0), (("t1", "t2"), 0)):
            got = interval_join(df, df, left_interval=names, right_interval=names)
            assert sorted((x["id"], x["id_right"]) for x in got.collect()) == \
                [(i, j) for i in range(6) for j in range(6) if abs(i - j) <= distance]
    odd = spark.createDataFrame([(1, float("nan"), 2.0), (2, 0.0, float("inf")), (3, float("-inf"), -1.0)], "id int, s double, e double")
    got = interval_join(odd, odd, left_interval=("s", "e"), right_interval=("s", "e"))
    assert sorted((x["id"], x["id_right"]) for x in got.collect()) == [(2, 2), (3, 3)]


def test_cuts_stay_few(spark):
    """A million-unit interval against points: at most two bins a level, one level of the other side."""
    from quarry.operators import intervals

    a = spark.range(100).selectExpr("id", "id AS s", "id + 1000000 AS e")
    b = spark.range(100).selectExpr("id", "id AS s", "id AS e")
    ma, mb = (intervals._measured(x, ("s", "e"), [], [], True) for x in (a, b))
    assert intervals._cut(ma, intervals._levels(mb), "a").count() <= 200
    assert intervals._cut(mb, intervals._levels(ma), "b").count() <= 100
