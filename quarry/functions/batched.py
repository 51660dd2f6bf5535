"""Functions of the caller's that SQL text may use for one call: aggregates with
merge, table functions, and Arrow or pandas functions.

All of them get Arrow batches. Functions that Python would call row by row are
refused.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.udtf import UserDefinedTableFunction
from pyspark.util import PythonEvalType

#: States a task holds before it merges them; of twice as many keys or more it passes them on.
HELD = 100_000
_BY_ROW = (PythonEvalType.SQL_BATCHED_UDF, PythonEvalType.SQL_ARROW_BATCHED_UDF,
           PythonEvalType.SQL_TABLE_UDF, PythonEvalType.SQL_ARROW_TABLE_UDF)


@dataclass(frozen=True)
class MergedAggregate:
    """An aggregate whose states merge, so that each task reduces its rows
    before the shuffle.

    ``key``, ``state`` and ``result`` are Spark type texts. ``update(keys,
    values)`` gives a table (key, state) of a batch, ``merge(table)`` one row
    per key of such a table, ``finish(states)`` the results. Registered as
    ``name``, the text calls two table functions: ``name_partial(TABLE(SELECT
    k, v ...))`` gives (key, state), a few per key and task, and
    ``name(TABLE(...) PARTITION BY key)`` gives (key, result).

    A null key is a key like any other; what null values count is ``update``'s
    to say. A key that a third of all rows share brings a few states per task, and
    they are merged as they stream in: no task holds its rows, nor all its states.
    """

    key: str
    state: str
    result: str
    update: Callable[[pa.Array, pa.Array], pa.Table]
    merge: Callable[[pa.Table], pa.Table]
    finish: Callable[[pa.Array], pa.Array]

    def partial(self) -> UserDefinedTableFunction:
        return F.arrow_udtf(_holding(self, None), returnType=f"key {self.key}, state {self.state}")

    def merged(self) -> UserDefinedTableFunction:
        return F.arrow_udtf(_holding(self, self.finish), returnType=f"key {self.key}, result {self.result}")


def _holding(own: MergedAggregate, finish: Callable[[pa.Array], pa.Array] | None) -> type:
    """A table function that merges what it is given: rows, or (with ``finish``) the states of one key."""
    limit = HELD

    class Held:
        def __init__(self):
            self.tables, self.rows = [], 0

        def _hold(self, table: pa.Table) -> None:
            self.tables, self.rows = [table], table.num_rows

        def eval(self, batch: pa.RecordBatch):
            keys, seconds = batch.column(0), batch.column(1)
            table = own.update(keys, seconds) if finish is None else pa.table({"key": keys, "state": seconds})
            self.tables.append(table)
            self.rows += table.num_rows
            if self.rows >= 2 * limit:
                self._hold(own.merge(pa.concat_tables(self.tables)))
                if finish is None and self.rows >= limit:  # many keys: the next stage merges them
                    yield self.tables.pop()
                    self.rows = 0

        def terminate(self):
            if self.rows:
                self._hold(own.merge(pa.concat_tables(self.tables)))
                table = self.tables[0]
                if finish is not None:
                    table = pa.table({"key": table.column("key"),
                                      "result": finish(table.column("state").combine_chunks())})
                yield table

    return Held


def problem(name: Any, function: Any) -> str | None:
    """What is wrong with ``function`` under ``name``, if anything."""
    if not (isinstance(name, str) and name.isidentifier()):
        return f"functions: {name!r} is not a function name"
    if isinstance(function, MergedAggregate):
        return None
    kind = getattr(function, "evalType", None)
    if kind is None:
        return f"functions: {name} must be a MergedAggregate, arrow_udtf, arrow_udf or pandas_udf"
    return f"functions: {name} would be called row by row" if kind in _BY_ROW else None


def register(spark: SparkSession, functions: dict[str, Any]) -> None:
    """Make ``functions`` known to ``spark``'s SQL under their names."""
    for name, function in functions.items():
        if isinstance(function, MergedAggregate):
            spark.udtf.register(f"{name}_partial", function.partial())
            spark.udtf.register(name, function.merged())
        elif isinstance(function, UserDefinedTableFunction):
            spark.udtf.register(name, function)
        else:
            spark.udf.register(name, function)
