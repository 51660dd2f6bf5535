"""``execute_sql``: run SQL text on Spark for its side effects.

Catalyst parses, optimises and runs the text. Commands (CTAS, INSERT,
DDL) run when ``spark.sql`` is called; a bare query is lazy, so it is
forced with the no-op sink, which runs the whole plan without collecting
a row to the driver. The call blocks until the work is done and raises a
``StageError`` carrying the stage detail if anything fails.
"""

from __future__ import annotations

import contextlib
import uuid
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql.session import _monkey_patch_RDD

from ..errors import Checks, StageError, wrap
from ..functions import batched
from ..functions.names import quote, split_name
from ..logs import timed
from ..functions.params import statements_of, substitute
from ..sources import files

STAGE = "execute_sql"


def execute_sql(
    spark: SparkSession,
    sql: str | None = None,
    *,
    input_uri: str | None = None,
    sql_params: dict[str, Any] | None = None,
    project: str | None = None,
    dataset: str | None = None,
    job_name: str | None = None,
    job_id: str | None = None,
    ansi: bool = True,
    script: bool | None = None,
    functions: dict[str, Any] | None = None,
    id: str | None = None,  # noqa: A002 -- the stage key is called id
    name: str | None = None,
    description: str | None = None,
    params: dict[str, str] | None = None,
) -> None:
    """Run ``sql`` (or the text at ``input_uri``, which wins) and return None.

    ``sql_params`` fill ``${name}`` placeholders as text and bind the
    remaining ``:name`` markers as values. ``project`` / ``dataset`` set the
    current catalog / database for the call alone.
    ``job_name`` (default ``jobId_[<job_id>_]<uuid>``) tags every Spark job
    the statement runs, as job group and session tag, so it can be found
    and cancelled. ``ansi`` runs the text in standard-SQL mode
    (``spark.sql.ansi.enabled``) whatever the session says, restored after.
    Text with several ``;``-separated statements runs them one by one; each
    bare query among them is forced with the no-op sink, so no row reaches the
    driver. A ``BEGIN ... END`` script is handed to Spark whole, which does
    collect its bare queries. ``script``: ``False`` takes the text as one
    statement, whatever it holds; ``None`` and ``True`` split it.
    ``functions`` are known to the text of this call by their names: aggregates
    with merge (``functions.batched.MergedAggregate``), ``arrow_udtf`` table
    functions, ``arrow_udf`` and ``pandas_udf`` functions; functions that Python
    would call row by row are refused.

    Each call runs in a clone of the session's state (settings, namespace,
    temp views, functions), so calls in several threads overlap and none sees
    another's database. The calling session is left as it is, but for temp
    views: those the call makes or drops are there, or gone, for the next one.
    ``SET`` and temporary functions of the text end with the call. Its jobs can
    be cancelled by their group, ``SparkContext.cancelJobGroup(job_name)``.
    """
    chk = Checks(STAGE)
    chk.require(input_uri is not None or sql is not None, "one of sql or input_uri is required")
    chk.text("sql", sql)
    chk.text("input_uri", input_uri)
    chk.text("project", project)
    chk.text("dataset", dataset)
    chk.text("job_name", job_name)
    chk.require(sql_params is None or isinstance(sql_params, dict), "sql_params must be a dict")
    chk.boolean("ansi", ansi)
    chk.require(script in (None, True, False), f"script must be None, True or False, got {script!r}")
    chk.require(functions is None or isinstance(functions, dict), "functions must be a dict")
    for known, function in (functions.items() if isinstance(functions, dict) else ()):
        fault = batched.problem(known, function)
        chk.require(fault is None, str(fault))
    text = sql
    if isinstance(input_uri, str) and input_uri.strip():
        try:
            text = files.read_small_text(spark, input_uri)
        except Exception:  # an unreadable file fails the run, with the stage detail
            text = None
    if isinstance(text, str) and (sql_params is None or isinstance(sql_params, dict)):
        try:
            substitute(text, sql_params)
        except KeyError as exc:
            chk.require(False, str(exc).strip('"'))
    chk.raise_if_any()

    sql_params = dict(sql_params or {})
    generated = f"jobId_{job_id}_{uuid.uuid4()}" if job_id else f"jobId_{uuid.uuid4()}"
    tag = job_name or generated
    detail: dict[str, Any] = {
        "type": "execute", "id": id, "name": name or tag, "description": description,
        "inputURI": input_uri, "sqlParams": sql_params, "params": dict(params or {}),
        "project": project, "dataset": dataset, "jobName": tag,
    }
    try:
        with timed(detail):
            if text is None:
                text = files.read_small_text(spark, input_uri)
            final = substitute(text, sql_params)
            detail["sql"] = final
            with _own_session(spark, project, dataset, ansi) as own, _tagged(own, tag):
                batched.register(own, functions or {})
                for statement in _statements(final, script):
                    detail["sql"] = statement
                    result = own.sql(statement, args=sql_params) if sql_params else own.sql(statement)
                    result.write.format("noop").mode("overwrite").save()
            return None
    except StageError:
        raise
    except Exception as exc:
        raise wrap(STAGE, detail, exc) from exc


def _statements(text: str, script: bool | None) -> list[str]:
    if script is False or text.lstrip()[:5].upper() == "BEGIN":
        return [text]
    return statements_of(text) or [text]


@contextlib.contextmanager
def _own_session(spark: SparkSession, project: str | None, dataset: str | None, ansi: bool):
    """A clone of the session's state for one call: its settings, current
    namespace, temp views and functions, to change as the call likes. The temp
    views that a call which succeeds made, replaced or dropped are handed back."""
    own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    _monkey_patch_RDD(spark)  # the newest session has taken rdd.toDF() for itself
    before = _temp_views(own)
    if project:
        own.catalog.setCurrentCatalog(project)
    if dataset:
        own.sql(f"USE {'.'.join(quote(p) for p in split_name(dataset))}")
    own.conf.set("spark.sql.ansi.enabled", "true" if ansi else "false")
    yield own
    after = _temp_views(own)
    views = _catalog_of(spark)
    for name, made in after.items():
        if name not in before or not made.equals(before[name]):
            views.createTempView(name, made, True)
    for name in before.keys() - after.keys():
        views.dropTempView(name)


def _catalog_of(spark: SparkSession):
    return spark._jsparkSession.sessionState().catalog()


def _temp_views(spark: SparkSession) -> dict:
    """The session's own temp views, by name, as its catalog holds them."""
    views = _catalog_of(spark)
    listed = views.listLocalTempViews("*")
    names = [listed.apply(k).table() for k in range(listed.size())]
    found = {name: views.getRawTempView(name) for name in names}
    return {name: view.get() for name, view in found.items() if view.isDefined()}


@contextlib.contextmanager
def _tagged(spark: SparkSession, tag: str):
    sc = spark.sparkContext
    old_group = sc.getLocalProperty("spark.jobGroup.id")
    old_desc = sc.getLocalProperty("spark.job.description")
    sc.setJobGroup(tag, f"execute_sql {tag}")
    spark.addTag(tag)
    try:
        yield
    finally:
        spark.removeTag(tag)
        sc.setLocalProperty("spark.jobGroup.id", old_group)
        sc.setLocalProperty("spark.job.description", old_desc)
