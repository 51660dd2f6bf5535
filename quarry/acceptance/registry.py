"""All acceptance queries and their DuckDB oracle texts, by name."""

from __future__ import annotations

from . import execute_checks, extract_checks, join_checks, load_checks

_CHECKS = (extract_checks, load_checks, execute_checks, join_checks)
QUERIES = {name: query for checks in _CHECKS for name, query in checks.QUERIES.items()}
ORACLE = {name: sql for checks in _CHECKS for name, sql in checks.ORACLE.items()}

assert set(QUERIES) == set(ORACLE), set(QUERIES) ^ set(ORACLE)
