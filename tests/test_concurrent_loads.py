"""Many writers of one table, leases, and appends that happen once."""

import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from quarry import ConfigError, StageError, load_table
from quarry.sinks import ledger, lease, load, staging
from quarry.sources import catalog, files


def one_row(spark, ws, k, kind):
    return ws.view(spark.createDataFrame([(k, kind)], "k int, kind string"), f"{kind}{k}")


def test_twenty_writers(spark, ws):
    """No call fails, and the table holds what some order of the calls leaves."""
    load_table(spark, one_row(spark, ws, 100, "overwrite"), "t", dataset=ws.db)
    times = {}

    def write(k):
        kind = "append" if k % 3 else "overwrite"
        view = one_row(spark, ws, k, kind)
        began = time.time()
        load_table(spark, view, "t", dataset=ws.db, save_mode=kind.capitalize())
        times[k] = (began, time.time())

    with ThreadPoolExecutor(10) as pool:
        list(pool.map(write, range(20)))
    rows = [(r["k"], r["kind"]) for r in spark.table(ws.table("t")).collect()]
    times[100] = (0.0, 0.0)
    last = [k for k, kind in rows if kind == "overwrite"]
    assert len(last) == 1 and len(rows) == len(set(rows))
    for k, (began, ended) in times.items():
        if k != 100 and k % 3 and began > times[last[0]][1]:
            assert (k, "append") in rows
        if k != 100 and k % 3 and ended < times[last[0]][0]:
            assert (k, "append") not in rows
        if not k % 3 and k not in (last[0], 100):
            assert began < times[last[0]][1]
    assert staging._side_tables(spark, ws.table("t")) == []


def test_concurrent_appends_keep_all_rows(spark, ws):
    """Also those that find no table: one makes it, the others append."""
    def write(k):
        load_table(spark, one_row(spark, ws, k, "append"), "made", dataset=ws.db, save_mode="Append")

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(write, range(16)))
    assert sorted(r["k"] for r in spark.table(ws.table("made")).collect()) == list(range(16))


def test_racing_creators(spark, ws):
    def write(k):
        try:
            load_table(spark, one_row(spark, ws, k, "append"), "raced", dataset=ws.db, save_mode="ErrorIfExists")
            return 1
        except StageError as exc:
            assert isinstance(exc.__cause__, load.TableExists)
            return 0

    with ThreadPoolExecutor(6) as pool:
        assert sum(pool.map(write, range(6))) == 1
    assert spark.table(ws.table("raced")).count() == 1


# --- leases ------------------------------------------------------------------------------


def test_a_lease_is_exclusive(spark, ws):
    inside, most = [], []

    def work(_):
        with lease.held(spark, ws.dir, "some table"):
            inside.append(1)
            most.append(len(inside))
            time.sleep(0.02)
            inside.pop()

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(work, range(18)))
    assert max(most) == 1
    path = lease.marker(files.qualified(spark, ws.dir), "some table")
    created = [files.create_exclusive(spark, path, str(k)) for k in range(3)]
    assert created == [True, False, False] and files.read_if_there(spark, path) == "0"


def test_a_marker_whose_owner_is_gone_is_taken_over(spark, ws, monkeypatch):
    monkeypatch.setattr(lease, "GONE_SECONDS", 0.3)
    path = lease.marker(files.qualified(spark, ws.dir), "left")
    files.create_exclusive(spark, path, "a lost driver")
    with lease.held(spark, ws.dir, "left") as own:
        own.check()
        files.delete_tree(spark, path)
        files.create_exclusive(spark, path, "one that took us for gone")
        with pytest.raises(lease.LostLease):
            own.check()
    assert files.read_if_there(spark, path) == "one that took us for gone"


def test_an_owner_that_lives_keeps_its_marker(spark, ws, monkeypatch):
    monkeypatch.setattr(lease, "GONE_SECONDS", 0.5)
    monkeypatch.setattr(lease, "BEAT_SECONDS", 0.1)
    path = lease.marker(files.qualified(spark, ws.dir), "kept")
    waiter = lease.Lease(spark, path, "waiter")
    with lease.held(spark, ws.dir, "kept") as own:
        taken = threading.Thread(target=lease._acquire, args=(waiter,))
        taken.start()
        time.sleep(2)
        own.check()
    taken.join(10)
    assert files.read_if_there(spark, path) == "waiter"


def test_a_lost_lease_publishes_nothing(spark, ws, monkeypatch):
    load_table(spark, one_row(spark, ws, 1, "overwrite"), "t", dataset=ws.db)
    monkeypatch.setattr(lease.Lease, "check", lambda self: (_ for _ in ()).throw(lease.LostLease("gone")))
    with pytest.raises(StageError):
        load_table(spark, one_row(spark, ws, 2, "overwrite"), "t", dataset=ws.db)
    assert [r["k"] for r in spark.table(ws.table("t")).collect()] == [1]


def test_a_live_directory_noted_as_replaced_is_dated_anew(spark, ws, monkeypatch):
    """A driver lost between the note and SET LOCATION, a day ago."""
    load_table(spark, one_row(spark, ws, 1, "overwrite"), "t", dataset=ws.db)
    live = catalog.location(spark, ws.table("t"))
    long_ago = int((time.time() - 90 * 3600) * 1000)
    catalog.set_properties(spark, ws.table("t"), {catalog.PROP_RETIRED: f"{long_ago}|{live}"})
    held = spark.table(ws.table("t"))
    load_table(spark, one_row(spark, ws, 2, "overwrite"), "t", dataset=ws.db)
    assert [r["k"] for r in held.collect()] == [1]


# --- once --------------------------------------------------------------------------------


class Killed(BaseException):
    """Not an Exception: nothing in the library handles it, as nothing handles a kill."""


def killed(*_, **__):
    raise Killed


def after(call, times=1):
    left = [times]

    def run(*a, **b):
        out = call(*a, **b)
        left[0] -= 1
        if left[0] == 0:
            raise Killed
        return out
    return run


POINTS = {
    "before the commit": (ledger.Entry, "commit", lambda f: killed),
    "after the commit": (ledger.Entry, "commit", after),
    "while moving": (ledger.files, "rename", lambda f: after(f, 3)),
    "after moving": (ledger.Entry, "carry_forward", after),
    "before the ledger": (ledger.Entry, "finish", lambda f: killed),
    "after the ledger": (ledger.files, "create_exclusive", lambda f: after(f, 2)),
}


@pytest.mark.parametrize("point", sorted(POINTS))
@pytest.mark.parametrize("days", [False, True])
def test_killed_anywhere_the_rows_are_there_once(spark, ws, monkeypatch, point, days):
    base = spark.range(4).select(F.col("id").alias("k"), F.expr("DATE'2024-01-01' + CAST(id AS INT)").alias("d"))
    load_table(spark, ws.view(base, "base"), "t", dataset=ws.db, **({"partition_field": "d"} if days else {}))
    more = ws.view(base.withColumn("k", F.col("k") + 100).withColumn("extra", F.lit(1)).repartition(3), "more")

    def append():
        load_table(spark, more, "t", dataset=ws.db, save_mode="Append", load_id="more", allow_field_addition=True)

    owner, name, broken = POINTS[point]
    with monkeypatch.context() as m:
        m.setattr(owner, name, broken(getattr(owner, name)))
        with pytest.raises(Killed):
            append()
    append()
    append()
    got = sorted((r["k"], r["extra"]) for r in spark.table(ws.table("t")).collect())
    assert got == [(k, None) for k in range(4)] + [(k, 1) for k in range(100, 104)]
    append()
    assert spark.table(ws.table("t")).count() == 8


def test_the_next_append_carries_a_load_forward(spark, ws, monkeypatch):
    load_table(spark, one_row(spark, ws, 0, "overwrite"), "t", dataset=ws.db)
    with monkeypatch.context() as m:
        m.setattr(ledger.Entry, "carry_forward", killed)
        with pytest.raises(Killed):
            load_table(spark, one_row(spark, ws, 1, "append"), "t", dataset=ws.db, save_mode="Append", load_id="one")
    assert spark.table(ws.table("t")).count() == 1
    load_table(spark, one_row(spark, ws, 2, "append"), "t", dataset=ws.db, save_mode="Append")
    assert sorted(r["k"] for r in spark.table(ws.table("t")).collect()) == [0, 1, 2]
    load_table(spark, one_row(spark, ws, 1, "append"), "t", dataset=ws.db, save_mode="Append", load_id="one")
    assert spark.table(ws.table("t")).count() == 3


def test_ids_outlive_an_overwrite_and_not_a_drop(spark, ws):
    def append(k):
        load_table(spark, one_row(spark, ws, k, "append"), "t", dataset=ws.db, save_mode="Append", load_id=f"load {k}")

    append(1)  # makes the table
    append(1)
    append(2)
    assert spark.table(ws.table("t")).count() == 2
    load_table(spark, one_row(spark, ws, 9, "overwrite"), "t", dataset=ws.db)
    append(1)
    append(2)
    assert [r["k"] for r in spark.table(ws.table("t")).collect()] == [9]
    spark.sql(f"DROP TABLE {ws.table('t')}")
    append(2)
    append(1)
    assert sorted(r["k"] for r in spark.table(ws.table("t")).collect()) == [1, 2]
    with pytest.raises(ConfigError):
        load_table(spark, one_row(spark, ws, 9, "overwrite"), "t", dataset=ws.db, load_id="x")


def test_overwrite_by_another_schema_drops_settings(spark, ws, caplog):
    frame = spark.createDataFrame([(1, 2, "x")], "a int, b int, c string").withColumn("d", F.current_date())
    load_table(spark, ws.view(frame, "f"), "t", dataset=ws.db, partition_field="d", clustered_fields="a,b",
               required_columns=["a", "c"])
    load_table(spark, ws.view(frame.select("a"), "g"), "t", dataset=ws.db)
    props = catalog.properties(spark, ws.table("t"))
    assert catalog.PROP_PARTITION_FIELD not in props and catalog.PROP_CLUSTERED not in props
    assert props[catalog.PROP_REQUIRED] == "a"
    with pytest.raises(StageError):  # what the call itself asks for must be there
        load_table(spark, ws.view(frame.select("a"), "h"), "t", dataset=ws.db, clustered_fields="b")
    retyped = frame.withColumn("d", F.lit("no date"))
    load_table(spark, ws.view(frame, "f"), "t2", dataset=ws.db, partition_field="d")
    load_table(spark, ws.view(retyped, "r"), "t2", dataset=ws.db)
    assert catalog.partition_columns(spark, ws.table("t2")) == []
