"""Benchmark the headline queries; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is the registered acceptance query (the engine's own functions
over the given tables), forced end to end with the no-op sink so every
write, read-back and aggregate runs without collecting rows to the
driver. One warm-up run, then the median of ``BENCH_RUNS`` timed runs.
``value`` is the sum of the medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.acceptance.registry import QUERIES  # noqa: E402
from quarry.session import build_session  # noqa: E402

HEADLINE = ["extract_count", "repartition_n_cols", "load_overwrite", "load_partitioned",
            "load_clustered", "sql_inner_join", "sql_frame"]


def _run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", app="quarry-bench", shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    for n in names:  # warm-up: JIT, catalog, file listing caches
        _run(spark, n, sf_dir)
    medians = {}
    for n in names:
        medians[n] = round(statistics.median(_run(spark, n, sf_dir) for _ in range(runs)), 4)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    try:
        sf_value = float(sf)
    except ValueError:
        sf_value = sf
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(medians.values()), 4),
                      "unit": "sec", "queries": medians, "sf": sf_value, "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
