"""``extract_table``: a catalog table or view into a DataFrame and a temp view.

Reads lazily: unless ``persist`` is set, no row is read here; the scan
runs when a later step needs it, with Catalyst pushing that step's filters
and column pruning into the parquet scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import Checks, StageError, wrap
from ..functions.names import qualify
from ..logs import timed
from ..operators import distribute
from ..streaming.guards import refuse_streaming
from . import catalog, materialized, metadata

STAGE = "extract_table"


@dataclass
class ExtractResult:
    df: DataFrame
    stats: dict[str, Any] = field(default_factory=dict)
    detail: dict[str, Any] = field(default_factory=dict)
    observation: distribute.Observed | None = None

    def observed(self) -> dict[str, Any]:
        """``{"records": rows, "nulls": {column: nulls}}``; waits for the first action on ``df``."""
        if self.observation is None:
            raise ValueError("extract_table was called without observe=True")
        return self.observation.get()


class ViewsNotEnabled(RuntimeError):
    pass


def extract_table(
    spark: SparkSession,
    table: str,
    *,
    dataset: str | None = None,
    project: str | None = None,
    output_view: str | None = None,
    immutable_view: bool = False,
    max_parallelism: int | None = None,
    views_enabled: bool = False,
    view_materialization_project: str | None = None,
    view_materialization_dataset: str | None = None,
    materialization_expiration_minutes: int = 24 * 60,
    schema_uri: str | None = None,
    schema_view: str | None = None,
    num_partitions: int | None = None,
    partition_by: Sequence[str] = (),
    day_range: tuple[Any, Any] | None = None,
    persist: bool = False,
    observe: bool = False,
    observe_nulls: Sequence[str] = (),
    storage_level: str | None = None,
    collect_stats: bool = False,
    id: str | None = None,  # noqa: A002 -- the stage key is called id
    name: str | None = None,
    description: str | None = None,
    params: dict[str, str] | None = None,
) -> ExtractResult:
    """Read ``[project.][dataset.]table`` and register it as ``output_view``.

    * ``max_parallelism`` caps the scan's partitions (coalesce, no shuffle).
    * A persistent view is read only with ``views_enabled``; with a
      ``view_materialization_dataset`` its result is first written there as
      a table and that table is read. While that table is current (not
      expired, and no source of the view has changed) it is read again
      without running the view. Such tables expire after
      ``materialization_expiration_minutes``; see
      :mod:`quarry.sources.materialized`.
    * ``schema_view`` (wins) or ``schema_uri`` adds column metadata.
    * ``num_partitions`` / ``partition_by`` repartition as in
      :func:`quarry.operators.distribute.repartition`.
    * ``day_range=(lo, hi)`` keeps days lo..hi of a day-partitioned table
      written by ``load_table``; the filter is on the partition column, so
      only those partitions are listed and read.
    * ``persist`` caches and counts; ``stats['records']`` is then set.
    * ``observe`` counts the rows, and the nulls of ``observe_nulls``, while the
      first action on ``df`` (or on a view of it that keeps all its rows) runs;
      the result's :meth:`ExtractResult.observed` then has them, without a job
      of their own. With ``persist`` that action is the one that fills the cache.
    * ``stats['num_partitions']`` is always there for a table that is not
      repartitioned by key alone (an explicit ``num_partitions``, or the
      planned scan's). For views and key-only repartitioning it would mean
      running their shuffles: there it comes with ``collect_stats`` or ``persist``.
    """
    if isinstance(partition_by, str):
        partition_by = [c.strip() for c in partition_by.split(",") if c.strip()]
    partition_by = list(partition_by or [])
    chk = Checks(STAGE)
    chk.text("table", table, required=True)
    for k, v in (("dataset", dataset), ("project", project), ("output_view", output_view),
                 ("view_materialization_project", view_materialization_project),
                 ("view_materialization_dataset", view_materialization_dataset),
                 ("schema_uri", schema_uri), ("schema_view", schema_view)):
        chk.text(k, v)
    chk.positive_int("max_parallelism", max_parallelism)
    chk.positive_int("num_partitions", num_partitions)
    chk.positive_int("materialization_expiration_minutes", materialization_expiration_minutes)
    for k, v in (("immutable_view", immutable_view), ("views_enabled", views_enabled),
                 ("persist", persist), ("collect_stats", collect_stats)):
        chk.boolean(k, v)
    chk.boolean("observe", observe)
    chk.require(observe or not observe_nulls, "observe_nulls needs observe=True")
    chk.require(all(isinstance(c, str) and c for c in partition_by),
                f"partition_by must be column names, got {partition_by!r}")
    chk.require(storage_level is None or storage_level in distribute.STORAGE_LEVELS,
                f"storage_level must be one of {sorted(distribute.STORAGE_LEVELS)}, got {storage_level!r}")
    chk.require(day_range is None or (isinstance(day_range, (tuple, list)) and len(day_range) == 2),
                f"day_range must be a (first_day, last_day) pair, got {day_range!r}")
    chk.raise_if_any()

    detail: dict[str, Any] = {
        "type": "extract", "id": id, "name": name or output_view or table, "description": description,
        "table": table, "dataset": dataset, "project": project, "outputView": output_view,
        "persist": persist, "viewsEnabled": views_enabled, "params": dict(params or {}),
        "maxParallelism": max_parallelism, "numPartitions": num_partitions,
        "partitionBy": partition_by, "viewMaterializationProject": view_materialization_project,
        "viewMaterializationDataset": view_materialization_dataset,
    }
    try:
        with timed(detail):
            target = qualify(table, dataset, project, current=spark.catalog.currentDatabase())
            detail["resolved"] = target
            kind = catalog.object_type(spark, target)
            if kind is None:
                raise LookupError(f"table or view {target} not found")
            df = spark.table(target)
            refuse_streaming(df, STAGE, target)
            detail["objectType"] = kind

            if kind == "VIEW":
                if not views_enabled:
                    raise ViewsNotEnabled(f"{target} is a view; reading views needs views_enabled=True")
                if view_materialization_dataset:
                    df = materialized.materialize(spark, target, view_materialization_project,
                                                  view_materialization_dataset, materialization_expiration_minutes,
                                                  detail)
            elif kind != "TEMPORARY":
                df = _day_partitions(spark, target, df, day_range)

            pairs = None
            if schema_view:
                pairs = metadata.read_metadata_view(spark, schema_view, len(df.columns))
            elif schema_uri:
                pairs = metadata.read_metadata_file(spark, schema_uri)
            if pairs:
                df = metadata.attach_metadata(df, pairs)

            df = distribute.cap_parallelism(df, max_parallelism)
            df = distribute.repartition(df, num_partitions, partition_by)

            observation = None
            if observe and not persist:
                df, observation = distribute.observe(df, observe_nulls)
            if output_view:
                if immutable_view:
                    df.createTempView(output_view)
                else:
                    df.createOrReplaceTempView(output_view)

            stats: dict[str, Any] = {"output_columns": len(df.schema)}
            if persist and observe:
                df, observation = distribute.persist_observed(df, storage_level, observe_nulls)
                stats["records"] = observation.get()["records"]
            elif persist:
                df, stats["records"] = distribute.persist(df, storage_level)
            if collect_stats or persist:
                stats["num_partitions"] = distribute.partition_count(df)
            elif num_partitions is not None:
                stats["num_partitions"] = num_partitions  # D2/D3 give exactly this many
            elif kind not in ("VIEW", "TEMPORARY") and not partition_by:
                stats["num_partitions"] = distribute.partition_count(df)  # a scan: planned, not run
            detail.update({"outputColumns": stats["output_columns"]})
            if "records" in stats:
                detail["records"] = stats["records"]
            if "num_partitions" in stats:
                detail["numPartitions"] = stats["num_partitions"]
            return ExtractResult(df, stats, detail, observation)
    except StageError:
        raise
    except Exception as exc:  # every failure carries the stage detail
        raise wrap(STAGE, detail, exc) from exc


def _day_partitions(spark: SparkSession, target: str, df: DataFrame,
                    day_range: tuple[Any, Any] | None) -> DataFrame:
    """Prune to ``day_range`` and hide a derived day column.

    A table written with a timestamp ``partition_field`` carries a derived
    ``__day`` partition column (``__day_1``, ... if the name was taken). A filter on the timestamp cannot prune it,
    a filter on ``__day`` can: that is what ``day_range`` is for.
    """
    if day_range is None and not any(c.startswith(catalog.DERIVED_DAY) for c in df.columns):
        return df  # nothing to prune or hide: skip the catalog round trip
    props = catalog.properties(spark, target)
    day_col = props.get(catalog.PROP_DAY_COLUMN)
    if day_range is not None:
        if not day_col:
            raise ValueError(f"day_range given but {target} is not day-partitioned")
        lo, hi = (_as_date(x) for x in day_range)
        if lo is not None:
            df = df.filter(F.col(day_col) >= F.lit(lo))
        if hi is not None:
            df = df.filter(F.col(day_col) <= F.lit(hi))
    return df.drop(day_col) if catalog.is_derived(props) else df


def _as_date(x: Any) -> dt.date | None:
    if x is None or isinstance(x, dt.date) and not isinstance(x, dt.datetime):
        return x
    if isinstance(x, dt.datetime):
        return x.date()
    text = str(x).strip()
    try:
        return dt.date.fromisoformat(text)
    except ValueError:
        return dt.datetime.fromisoformat(text).date()
