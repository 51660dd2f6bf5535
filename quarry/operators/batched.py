"""An aggregate with merge and a table function to call from SQL text, over Arrow batches."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.udtf import UserDefinedTableFunction

from ..functions.batched import MergedAggregate


def histogram_quantile(at: float, width: float, key: str = "string") -> MergedAggregate:
    """The lower edge of the bucket, ``width`` wide, that holds the value at rank
    ``ceil(at * n)`` of the n values that are neither null nor NaN. A state is the
    counts of the buckets hit, however many rows there are; a key with none has no
    result. Values are doubles within 2**53 buckets of zero."""
    if not (0 < at <= 1 and width > 0):
        raise ValueError("at must lie in (0, 1] and width be positive")

    def states(key: pa.ChunkedArray, bucket: pa.ChunkedArray, n: pa.ChunkedArray) -> pa.Table:
        counts = pa.table({"key": key, "bucket": bucket, "n": n}).group_by(["key", "bucket"]).aggregate([("n", "sum")])
        held = counts.group_by("key", use_threads=False).aggregate([("bucket", "list"), ("n_sum", "list")])
        columns = [held.column(c).combine_chunks() for c in ("bucket_list", "n_sum_list")]
        return pa.table({"key": held.column("key"), "state": pa.StructArray.from_arrays(columns, ["bucket", "n"])})

    def update(keys: pa.Array, values: pa.Array) -> pa.Table:
        bucket = pc.floor(pc.divide(values.cast(pa.float64()), width))
        counted = pc.fill_null(pc.is_finite(bucket), False)
        bucket = bucket.filter(counted).cast(pa.int64())
        return states(keys.filter(counted), bucket, pa.array([1]).take(pa.array([0] * len(bucket), pa.int64())))

    def merge(held: pa.Table) -> pa.Table:
        state = held.column("state").combine_chunks()
        bucket, n = pc.struct_field(state, [0]), pc.struct_field(state, [1])
        owner = held.column("key").take(pc.list_parent_indices(bucket))
        return states(owner, pc.list_flatten(bucket), pc.list_flatten(n))

    def finish(found: pa.Array) -> pa.Array:
        out = []
        for state in found.to_pylist():
            rank, seen = -(-at * sum(state["n"]) // 1), 0
            for bucket, n in sorted(zip(state["bucket"], state["n"], strict=True)):
                seen += n
                if seen >= rank:
                    out.append(bucket * float(width))
                    break
        return pa.array(out, pa.float64())

    return MergedAggregate(key, "struct<bucket: array<bigint>, n: array<bigint>>", "double", update, merge, finish)


def sessions(gap: int, key: str = "bigint") -> UserDefinedTableFunction:
    """A table function: the sessions (key, first, last, n) of a table of (key, time),
    called with ``PARTITION BY`` the key and ``ORDER BY`` the time (a bigint). Rows at
    most ``gap`` apart are of one session; a row without a time is of none. One open
    session is all that is held of a key, so one with a third of all rows streams."""

    class Sessions:
        def __init__(self):
            self.open = None

        def eval(self, batch: pa.RecordBatch):
            keys, times = batch.column(0), batch.column(1)
            at = times.drop_null().to_numpy()
            if len(at) == 0:
                return
            cuts = [0, *((at[1:] - at[:-1] > gap).nonzero()[0] + 1).tolist(), len(at)]
            found = [[int(at[a]), int(at[z - 1]), z - a] for a, z in zip(cuts, cuts[1:], strict=False)]
            if self.open is not None:
                first, last, n = self.open[1]
                if found[0][0] - last <= gap:
                    found[0] = [first, found[0][1], n + found[0][2]]
                else:
                    found.insert(0, self.open[1])
            self.open = (keys.slice(0, 1), found.pop())
            yield self._table(found)

        def terminate(self):
            if self.open is not None:
                yield self._table([self.open[1]])

        def _table(self, found: list[list[int]]) -> pa.Table:
            keys = self.open[0].take(pa.array([0] * len(found), pa.int64()))
            first, last, n = ([row[k] for row in found] for k in range(3))
            return pa.table([keys, pa.array(first, pa.int64()), pa.array(last, pa.int64()), pa.array(n, pa.int64())],
                            ["key", "first", "last", "n"])

    return F.arrow_udtf(Sessions, returnType=f"key {key}, first bigint, last bigint, n bigint")
