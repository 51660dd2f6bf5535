"""Writes stay exact when tasks fail and are retried (separate JVM, local[4,3])."""

import json
import os
import subprocess
import sys

from conftest import SF001

SCRIPT = os.path.join(os.path.dirname(__file__), "scripts", "retry_write.py")


def test_retried_tasks_neither_duplicate_nor_lose_rows():
    proc = subprocess.run([sys.executable, SCRIPT, SF001], capture_output=True, text=True, timeout=600)
    lines = [ln for ln in proc.stdout.splitlines() if ln.startswith("RESULT ")]
    assert lines, proc.stderr[-3000:]
    out = json.loads(lines[-1][len("RESULT "):])
    n = out["expected"]
    for t in ("clustered", "by_day"):
        assert out[t] == {"rows": n, "distinct": n}, out
    assert out["appended"] == {"rows": 2 * n, "distinct": n}, out
    assert "injected task failure" in proc.stderr
