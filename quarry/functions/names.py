"""Table names: ``table`` completed by optional ``dataset`` and ``project``.

``project`` maps to a catalog and ``dataset`` to a database (schema). The
result is a backtick-quoted multi-part identifier that ``spark.table``,
``spark.catalog`` and SQL text all accept.
"""

from __future__ import annotations


def split_name(name: str) -> list[str]:
    """Split a dotted name, honouring backtick quoting."""
    parts, cur, quoted, i = [], [], False, 0
    while i < len(name):
        ch = name[i]
        if ch == "`":
            if quoted and i + 1 < len(name) and name[i + 1] == "`":
                cur.append("`")
                i += 2
                continue
            quoted = not quoted
        elif ch == "." and not quoted:
            parts.append("".join(cur))
            cur = []
        else:
            cur.append(ch)
        i += 1
    parts.append("".join(cur))
    return [p.strip() for p in parts]


def quote(part: str) -> str:
    return "`" + part.replace("`", "``") + "`"


def qualify(table: str, dataset: str | None = None, project: str | None = None, *,
            current: str | None = None) -> str:
    """``project.dataset.table`` as a quoted identifier; unset parts are left
    out. With a project but no dataset, ``current`` (the current database) is
    the dataset: a project is a catalog, never taken for a database."""
    parts = split_name(table)
    if dataset:
        parts = split_name(dataset) + parts[-1:]
    if project:
        if len(parts) == 1:
            if not current:
                raise ValueError(f"project {project!r} needs a dataset, or a current database")
            parts = [current, *parts]
        parts = [*split_name(project), *parts[-2:]]
    return ".".join(quote(p) for p in parts)


def parts_of(name: str) -> list[str]:
    return split_name(name)


def sibling(name: str, table: str) -> str:
    """A name in the same catalog and database as ``name``."""
    parts = split_name(name)
    return ".".join(quote(p) for p in [*parts[:-1], table])

