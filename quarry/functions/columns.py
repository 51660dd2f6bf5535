"""Column references by exact name (a dot in a name is not a struct path)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DoubleType, FloatType, IntegerType, LongType,
                               ShortType)


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


# The lossless widenings an append may apply.
_WIDER = {
    ByteType: (ShortType, IntegerType, LongType),
    ShortType: (IntegerType, LongType),
    IntegerType: (LongType,),
    FloatType: (DoubleType,),
}


def widens_to(source: DataType, target: DataType) -> bool:
    """True if every ``source`` value is exactly representable in ``target``."""
    return isinstance(target, _WIDER.get(type(source), ()))
