"""SQL parameters: ``${name}`` text substitution plus ``:name`` value binding.

``:name`` markers are bound by Spark's parser as typed literals: no
injection, usable wherever a literal is (and for names via
``IDENTIFIER(:name)``). ``${name}`` is plain text substitution for parity
with script-style parameters; it can splice anything, including SQL, so
only pass trusted values through it. A ``${name}`` with no value is an
error, as is a ``:name`` marker Spark cannot bind.
"""

from __future__ import annotations

import re

_PLACEHOLDER = re.compile(r"\$\{\s*([A-Za-z_][A-Za-z0-9_]*)\s*\}")


class MissingParameter(KeyError):
    pass


def substitute(sql: str, params: dict[str, str] | None) -> str:
    params = params or {}
    missing = sorted({m.group(1) for m in _PLACEHOLDER.finditer(sql) if m.group(1) not in params})
    if missing:
        raise MissingParameter(f"no value for SQL parameter(s): {', '.join(missing)}")
    return _PLACEHOLDER.sub(lambda m: str(params[m.group(1)]), sql)


def statements_of(sql: str) -> list[str]:
    """The statements of ``sql``: what stands between semicolons that are in no
    quotes and no comments. Pieces without any word are left out."""
    out, cur, i, n, word = [], [], 0, len(sql), False
    while i < n:
        ch = sql[i]
        j = i + 1
        if ch in "'\"`":  # to the closing quote; a backslash escapes in strings
            while j < n and sql[j] != ch:
                j += 2 if sql[j] == "\\" and ch != "`" else 1
            j, word = min(j + 1, n), True
        elif sql.startswith("--", i):
            j = sql.find("\n", i)
            j = n if j < 0 else j
        elif sql.startswith("/*", i):
            depth, j = 1, i + 2
            while j < n and depth:  # bracketed comments nest
                if sql.startswith("/*", j):
                    depth, j = depth + 1, j + 2
                elif sql.startswith("*/", j):
                    depth, j = depth - 1, j + 2
                else:
                    j += 1
        elif ch == ";":
            if word:
                out.append("".join(cur).strip())
            cur, word, i = [], False, j
            continue
        elif not ch.isspace():
            word = True
        cur.append(sql[i:j])
        i = j
    if word:
        out.append("".join(cur).strip())
    return out
