"""quarry: move and shape warehouse tables on Spark.

Three entry points, linked by temporary views:

* :func:`extract_table` -- a catalog table or view into a DataFrame and a
  temp view, with read cap, repartitioning, column metadata and caching.
* :func:`load_table` -- a temp view into a table, with four save modes,
  staged overwrite, day partitions with expiry, clustering and opt-in
  schema evolution.
* :func:`execute_sql` -- parameterised SQL text run on Spark, for its side
  effects, with a named job and errors that carry the stage detail.
"""

from .errors import ConfigError, StageError
from .plans.execute import execute_sql
from .sinks.load import load_table
from .sources.extract import ExtractResult, extract_table

__all__ = ["extract_table", "load_table", "execute_sql", "ExtractResult", "ConfigError", "StageError"]
