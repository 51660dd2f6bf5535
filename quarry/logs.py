"""Stage logging: one JSON line per stage run, with the stage detail.

Uses the standard ``logging`` module (logger ``quarry``), so the caller's
logging set-up decides where it goes. Successful runs log at INFO, failed
ones at ERROR; both carry ``durationMs``.
"""

from __future__ import annotations

import contextlib
import json
import logging
import time
from typing import Any

log = logging.getLogger("quarry")


@contextlib.contextmanager
def timed(detail: dict[str, Any]):
    start = time.perf_counter()
    try:
        yield
    except BaseException as exc:
        detail["durationMs"] = int((time.perf_counter() - start) * 1000)
        log.error(json.dumps({"event": "failed", "error": type(exc).__name__, **detail}, default=str))
        raise
    detail["durationMs"] = int((time.perf_counter() - start) * 1000)
    log.info(json.dumps({"event": "exit", **detail}, default=str))
