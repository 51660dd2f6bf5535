"""Property test for the append planner: random table and incoming schemas."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import (DoubleType, FloatType, IntegerType, LongType, StringType, StructField,
                               StructType)

from quarry.operators.evolution import SchemaMismatch, plan_append

TYPES = [IntegerType(), LongType(), FloatType(), DoubleType(), StringType()]
WIDER = {("int", "bigint"), ("float", "double")}
names = st.lists(st.sampled_from(list("abcdefgh")), min_size=1, max_size=6, unique=True)


@st.composite
def schemas(draw):
    target = draw(names)
    incoming = draw(names)
    t_types = {n: draw(st.sampled_from(TYPES)) for n in target}
    i_types = {n: (t_types[n] if n in t_types and draw(st.booleans()) else draw(st.sampled_from(TYPES)))
               for n in incoming}
    part = [target[-1]] if len(target) > 1 and draw(st.booleans()) else []
    required = draw(st.lists(st.sampled_from(target), unique=True, max_size=2))
    return target, t_types, incoming, i_types, part, required


@pytest.mark.filterwarnings("ignore")
@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(case=schemas(), add=st.booleans(), relax=st.booleans())
def test_plan_append(spark, case, add, relax):
    target, t_types, incoming, i_types, part, required = case
    tschema = StructType([StructField(n, t_types[n]) for n in target])
    ischema = StructType([StructField(n, i_types[n]) for n in incoming])
    inc = spark.createDataFrame([], ischema)
    added = [n for n in incoming if n not in target]
    bad_type = [n for n in incoming if n in target and i_types[n] != t_types[n]
                and (i_types[n].simpleString(), t_types[n].simpleString()) not in WIDER]
    missing = [n for n in target if n not in incoming]
    expect_fail = ((added and not add) or bad_type or any(n in part for n in missing)
                   or any(n in required for n in missing if n not in part) and not relax)
    if expect_fail:
        with pytest.raises(SchemaMismatch):
            plan_append(tschema, part, inc, required, add, relax)
        return
    plan = plan_append(tschema, part, inc, required, add, relax)
    out = inc.select(*plan.columns).schema
    data = [n for n in target if n not in part]
    assert out.fieldNames() == data + added + part
    for f in out.fields:
        want = t_types.get(f.name, i_types.get(f.name))
        assert f.dataType == want
    assert [f.name for f in plan.added] == added
    assert set(plan.still_required) | set(plan.relaxed) == set(required)
