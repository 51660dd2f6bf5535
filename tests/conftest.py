import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8)
    # The cluster names the shared scratch folder; set one only where unset.
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    yield s


@pytest.fixture()
def ws(spark):
    from quarry.acceptance.workspace import Workspace
    return Workspace(spark, SF001, "test")


def explain(spark, df, mode: str = "FORMATTED") -> str:
    """The physical plan, via the public EXPLAIN statement (FORMATTED lists
    each node's details; "" gives the one-line-per-node tree)."""
    name = f"explain_{id(df)}"
    df.createOrReplaceTempView(name)
    return spark.sql(f"EXPLAIN {mode} SELECT * FROM {name}").collect()[0][0]
