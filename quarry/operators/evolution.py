"""Schema evolution on append (L11, L12) and the required-column guard.

Parquet tables do not keep NOT NULL, so "required" columns are recorded in
a table property and enforced in the write plan itself: a NULL in such a
column fails the write job in the same pass (``raise_error``), and a failed
job commits nothing.

Rules for appending ``incoming`` to a table with schema ``target``:

* a column only in ``incoming`` is added (nullable; old rows read NULL)
  when ``allow_field_addition``, else the append is refused;
* a column only in the table is filled with typed NULLs; if it is
  required, that needs ``allow_field_relaxation``;
* with ``allow_field_relaxation`` a required column that the call does not
  itself list as required becomes nullable when it is absent from
  ``incoming`` or holds a NULL there (one aggregate over the columns in
  question, and only then);
* a column that the call lists as required must exist, in the table or in
  ``incoming``; one that the append adds is enforced and recorded like any;
* a column in both with a different type is refused, unless the incoming
  type widens losslessly to the table's (int to bigint, float to double),
  in which case it is cast;
* inside structs, arrays and maps the same holds for each field, however deep:
  a field that only the table has is filled with NULL, one that only the input
  has is added to the column's type (with ``allow_field_addition``; old rows
  read NULL), fields are matched by name, and their order is the table's. Map
  keys have to be of the same type.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType

from ..functions.columns import col, widens_to


class SchemaMismatch(ValueError):
    pass


@dataclass
class AppendPlan:
    columns: list[Column]          # incoming, aligned to the table (+ added columns)
    added: list[StructField]       # to add with ALTER TABLE ADD COLUMNS
    relaxed: list[str]             # required columns that become nullable
    still_required: list[str]
    widened: dict[str, DataType] = field(default_factory=dict)  # columns whose type gains fields inside


def _canon(t: DataType) -> str:
    return t.simpleString()


def merge(table: DataType, incoming: DataType, at: str, new: list[str]) -> DataType | None:
    """The table's type with the fields that only ``incoming`` has (their names go
    to ``new``), None if the two don't go together."""
    if _canon(table) == _canon(incoming) or widens_to(incoming, table):
        return table
    if isinstance(table, StructType) and isinstance(incoming, StructType):
        theirs = {f.name.lower(): f for f in incoming.fields}
        if len(theirs) < len(incoming.fields):
            return None  # names that differ in case alone
        out = []
        for f in table.fields:
            other = theirs.pop(f.name.lower(), None)
            kind = f.dataType if other is None else merge(f.dataType, other.dataType, f"{at}.{f.name}", new)
            if kind is None:
                return None
            out.append(StructField(f.name, kind, True, f.metadata))
        for f in theirs.values():
            new.append(f"{at}.{f.name}")
            out.append(StructField(f.name, f.dataType, True, f.metadata))
        return StructType(out)
    if isinstance(table, ArrayType) and isinstance(incoming, ArrayType):
        kind = merge(table.elementType, incoming.elementType, f"{at}.element", new)
        return kind and ArrayType(kind, True)
    if isinstance(table, MapType) and isinstance(incoming, MapType) and _canon(table.keyType) == _canon(incoming.keyType):
        kind = merge(table.valueType, incoming.valueType, f"{at}.value", new)
        return kind and MapType(table.keyType, kind, True)
    return None


def rebuilt(value: Column, source: DataType, target: DataType) -> Column:
    """A value of type ``source`` as one of ``target``, which :func:`merge` gave."""
    if _canon(source) == _canon(target):
        return value
    if isinstance(target, StructType):
        theirs = {f.name.lower(): f for f in source.fields}
        fields = []
        for f in target.fields:
            own = theirs.get(f.name.lower())
            inner = F.lit(None).cast(f.dataType) if own is None else \
                rebuilt(value.getField(own.name), own.dataType, f.dataType)
            fields.append(inner.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(target, ArrayType):
        return F.transform(value, lambda x: rebuilt(x, source.elementType, target.elementType))
    if isinstance(target, MapType):
        return F.transform_values(value, lambda _, x: rebuilt(x, source.valueType, target.valueType))
    return value.cast(target)


def plan_append(target: StructType, partition_cols: list[str], incoming: DataFrame,
                required: list[str], allow_field_addition: bool,
                allow_field_relaxation: bool, called: list[str] = ()) -> AppendPlan:
    """``required``: what the table records; ``called``: what this call lists."""
    tgt = {f.name.lower(): f for f in target.fields}
    inc = {f.name.lower(): f for f in incoming.schema.fields}
    part = {c.lower() for c in partition_cols}
    firm = {c.lower() for c in called}
    req = {c.lower() for c in required} | firm

    problems = []
    unknown = [c for c in called if c.lower() not in tgt and c.lower() not in inc]
    if unknown:
        problems.append(f"required column(s) {unknown} are neither in the table nor in the input")
    added = [f for k, f in inc.items() if k not in tgt]
    if added and not allow_field_addition:
        problems.append(f"new column(s) {[f.name for f in added]} need allow_field_addition=True")
    kinds: dict[str, DataType] = {}
    inside: list[str] = []
    widened: dict[str, DataType] = {}
    for k, f in inc.items():
        if k in tgt:
            new: list[str] = []
            kinds[k] = merge(tgt[k].dataType, f.dataType, f.name, new)
            if kinds[k] is None:
                problems.append(f"column {f.name!r} is {_canon(f.dataType)}, the table has "
                                f"{_canon(tgt[k].dataType)}")
            elif new:
                inside += new
                widened[tgt[k].name] = kinds[k]
    if inside and not allow_field_addition:
        problems.append(f"new field(s) {inside} need allow_field_addition=True")
    missing = [f for k, f in tgt.items() if k not in inc]
    for f in missing:
        if f.name.lower() in part:
            problems.append(f"partition column {f.name!r} is missing")
        elif f.name.lower() in firm:
            problems.append(f"column {f.name!r}, required by this call, is missing")
        elif f.name.lower() in req and not allow_field_relaxation:
            problems.append(f"required column {f.name!r} is missing; needs allow_field_relaxation=True")
    if problems:
        raise SchemaMismatch("; ".join(problems))
    relaxed = []
    if allow_field_relaxation:
        loose = sorted(k for k in req - firm if k in tgt)
        holding = _holding_nulls(incoming, [inc[k].name for k in loose if k in inc and inc[k].nullable])
        relaxed = [tgt[k].name for k in loose if k not in inc or inc[k].name in holding]

    known = {**{f.name.lower(): f.name for f in added}, **{k: f.name for k, f in tgt.items()}}
    still = [known[k] for k in sorted(req) if k in known and known[k] not in relaxed]
    data_cols = [f for f in target.fields if f.name.lower() not in part]
    part_cols = [f for f in target.fields if f.name.lower() in part]
    cols = []
    for f in [*data_cols, *added, *part_cols]:
        k = f.name.lower()
        if k not in inc:
            c = F.lit(None).cast(f.dataType)
        elif k in tgt:
            c = rebuilt(col(inc[k].name), inc[k].dataType, kinds[k])
        else:
            c = col(inc[k].name)
        cols.append(c.alias(f.name))
    return AppendPlan(cols, added, relaxed, still, widened)


def _holding_nulls(df: DataFrame, columns: list[str]) -> set[str]:
    if not columns:
        return set()
    row = df.agg(*[F.count(F.when(col(c).isNull(), 1)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    return {c for i, c in enumerate(columns) if row[i]}


def guard_required(df: DataFrame, required: list[str], table: str) -> DataFrame:
    """Fail the job on a NULL in any required column, in the same pass."""
    if not required:
        return df
    types = {f.name.lower(): f for f in df.schema.fields}
    out = []
    for f in df.schema.fields:
        c = col(f.name)
        if f.name.lower() in {r.lower() for r in required}:
            msg = F.lit(f"NULL in required column {f.name} of {table}")
            c = F.when(c.isNull(), F.raise_error(msg).cast(types[f.name.lower()].dataType)).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def ddl_type(f: StructField) -> str:
    return f.dataType.simpleString()
