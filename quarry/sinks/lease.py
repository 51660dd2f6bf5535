"""One publisher of a table at a time, across threads, sessions and drivers.

A lease is a marker file, one for each target, made by an exclusive create:
only one of many that try succeeds. It holds the token of its owner, who keeps
it fresh by touching it. Whoever finds it taken waits; if it has not been
touched for ``GONE_SECONDS`` of the waiter's own clock, its owner is gone, and
the waiter moves the marker away (a rename: again only one succeeds) and tries
anew. An owner looks at the marker once more right before it changes the
catalog (:meth:`Lease.check`): if the token is another's, it was taken for gone
and gives up (``LostLease``), and nothing is published.

Exclusive creates are atomic on HDFS and on object stores that support
conditional writes; on a local file system, the one case that Hadoop's own
create leaves open, the operating system's exclusive create is used.
"""

from __future__ import annotations

import contextlib
import hashlib
import threading
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

from ..sources import files

BEAT_SECONDS = 10.0
GONE_SECONDS = 60.0
_LOCAL: dict[str, threading.Lock] = {}
_LOCAL_GUARD = threading.Lock()


class LostLease(RuntimeError):
    pass


class Lease:
    def __init__(self, spark: SparkSession, path: str, token: str):
        self.spark, self.path, self.token = spark, path, token

    def check(self) -> None:
        """Raises unless the marker is still ours."""
        if files.read_if_there(self.spark, self.path) != self.token:
            raise LostLease(f"{self.path} was taken by another writer; nothing was published")


def marker(root: str, identity: str) -> str:
    return f"{root.rstrip('/')}/_quarry_leases/{hashlib.sha256(identity.encode()).hexdigest()[:24]}"


@contextlib.contextmanager
def held(spark: SparkSession, root: str, identity: str) -> Iterator[Lease]:
    """The lease of table ``identity``, whose markers lie under ``root``; waits for it."""
    path = marker(files.qualified(spark, root), identity)
    with _LOCAL_GUARD:
        local = _LOCAL.setdefault(path, threading.Lock())
    with local:  # threads of one process queue here, not at the file
        lease = Lease(spark, path, uuid.uuid4().hex)
        _acquire(lease)
        done = threading.Event()
        beat = threading.Thread(target=_beat, args=(lease, done), daemon=True)
        beat.start()
        try:
            yield lease
        finally:
            done.set()
            beat.join()
            if files.read_if_there(spark, path) == lease.token:
                files.delete_tree(spark, path)


def _beat(lease: Lease, done: threading.Event) -> None:
    while not done.wait(BEAT_SECONDS):
        with contextlib.suppress(Exception):  # the next check tells
            files.touch(lease.spark, lease.path)


def _acquire(lease: Lease) -> None:
    spark, pause, seen, since = lease.spark, 0.05, None, time.monotonic()
    while not files.create_exclusive(spark, lease.path, lease.token):
        now = (files.read_if_there(spark, lease.path), files.modified_ms(spark, lease.path))
        if now != seen:
            seen, since = now, time.monotonic()
        elif seen[1] is not None and time.monotonic() - since > GONE_SECONDS:
            _break(lease, seen[0])
            seen = None
        time.sleep(pause)
        pause = min(pause * 1.5, 1.0)


def _break(lease: Lease, stale: str | None) -> None:
    """Moves away a marker whose owner is gone."""
    aside = f"{lease.path}.gone-{lease.token}"
    if files.rename(lease.spark, lease.path, aside):
        if files.read_if_there(lease.spark, aside) != stale:  # someone was quicker, and this one is alive
            files.rename(lease.spark, aside, lease.path)
        else:
            files.delete_tree(lease.spark, aside)
