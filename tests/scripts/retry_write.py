"""Run by tests/test_retries.py in its own JVM with task retries allowed.

The first attempt of every even-numbered task of the input stage fails;
the retried attempts must produce exactly the input rows in the written
tables (no duplicates, no losses), for clustered and day-partitioned loads.
"""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import pandas as pd  # noqa: E402
from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import LongType  # noqa: E402

from quarry import load_table  # noqa: E402
from quarry.acceptance.workspace import Workspace  # noqa: E402
from quarry.session import build_session  # noqa: E402


@F.pandas_udf(LongType())
def flaky(x: pd.Series) -> pd.Series:
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        raise RuntimeError("injected task failure")
    return x


def main(sf_dir: str) -> None:
    spark = build_session("local[4,3]", shuffle_partitions=6)
    ws = Workspace(spark, sf_dir, "retry")
    events = ws.read("events").repartition(4)
    src = events.withColumn("event_id", flaky("event_id"))
    view = ws.view(src, "flaky")
    load_table(spark, view, "clustered", dataset=ws.db, clustered_fields="user_id")
    load_table(spark, view, "by_day", dataset=ws.db, partition_field="ts", clustered_fields="user_id")
    load_table(spark, view, "appended", dataset=ws.db, partition_field="ts")
    load_table(spark, view, "appended", dataset=ws.db, save_mode="Append")
    out = {}
    for t in ("clustered", "by_day", "appended"):
        df = spark.table(ws.table(t))
        out[t] = {"rows": df.count(), "distinct": df.select("event_id").distinct().count()}
    out["expected"] = events.count()
    print("RESULT " + json.dumps(out))


if __name__ == "__main__":
    main(sys.argv[1])
