"""How the headline operators grow with data: the given sf0.1 tables,
replicated k times by Spark (union of k copies with shifted keys), through
extract/load. Prints one JSON line per k.

    BENCH_SCALES=1,10,30 python bench_scale.py

Not the driver's bench (that is bench.py); this separates fixed cost per
query from cost per row.
"""

from __future__ import annotations

import json
import os
import sys
import time
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from quarry import extract_table, load_table  # noqa: E402
from quarry.acceptance.workspace import Workspace  # noqa: E402
from quarry.session import build_session  # noqa: E402


def replicate(df: DataFrame, key: str, k: int) -> DataFrame:
    span = df.agg(F.max(key) + 1).first()[0]
    copies = [df.withColumn(key, F.col(key) + F.lit(i * span)) for i in range(k)]
    return reduce(DataFrame.unionByName, copies)


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app="quarry-scale", shuffle_partitions=2 * cpus)
    for k in [int(x) for x in os.environ.get("BENCH_SCALES", "1,10,30").split(",")]:
        ws = Workspace(spark, sf_dir, f"scale{k}")
        # materialise the replicated inputs once, as tables of many files
        for name, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey"), ("events", "event_id")):
            replicate(ws.read(name), key, k).repartition(2 * cpus).write.saveAsTable(ws.table(f"{name}_x"))
        noop = lambda df: df.write.format("noop").mode("overwrite").save()
        res = {"k": k, "lineitem_rows": spark.table(ws.table("lineitem_x")).count()}
        res["extract_count"] = timed(lambda: extract_table(spark, "lineitem_x", dataset=ws.db).df.count())
        res["repartition_n_cols"] = timed(lambda: noop(
            extract_table(spark, "lineitem_x", dataset=ws.db, num_partitions=2 * cpus,
                          partition_by=["l_orderkey"]).df.groupBy("l_orderkey").count()))
        ws.view(spark.table(ws.table("orders_x")), "o")
        res["load_overwrite"] = timed(lambda: load_table(spark, f"{ws.db}__o", "o_out", dataset=ws.db))
        ws.view(spark.table(ws.table("events_x")), "e")
        res["load_partitioned"] = timed(lambda: load_table(spark, f"{ws.db}__e", "e_out", dataset=ws.db,
                                                           partition_field="ts"))
        res["load_clustered"] = timed(lambda: load_table(spark, f"{ws.db}__o", "o_cl", dataset=ws.db,
                                                         clustered_fields="o_custkey,o_orderdate"))
        print(json.dumps(res), flush=True)


if __name__ == "__main__":
    main()
