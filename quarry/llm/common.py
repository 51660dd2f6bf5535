"""Helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import hashlib
import os
from collections.abc import Iterator
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir
from ..sources import files

SPACES = (9, 10, 11, 12, 13, 32)  # the bytes that separate words


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Python workers that start on this machine are told where
    this package lies; on a cluster it is installed or sent along (--py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Scope:
    """The scratch folders that one piece of work makes. What a frame still reads
    can't be told from here: whoever opened a scope releases it once the frames
    made in it are written elsewhere or not wanted any more."""

    def __init__(self):
        self.paths: list[str] = []

    def release(self, spark: SparkSession) -> None:
        while self.paths:
            files.delete_tree(spark, self.paths.pop())


_SCOPE: ContextVar[Scope | None] = ContextVar("scope", default=None)


@contextlib.contextmanager
def scope() -> Iterator[Scope]:
    """Scratch folders made inside, by this thread, belong to the scope."""
    own = Scope()
    before = _SCOPE.set(own)
    try:
        yield own
    finally:
        _SCOPE.reset(before)


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder in the shared scratch folder. It goes with its scope, or else
    when the driver's JVM ends."""
    path = fresh_dir(spark, label)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(place)
    fs.deleteOnExit(place)
    if (own := _SCOPE.get()) is not None:
        own.paths.append(path)
    return path


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared scratch folder and read back: cuts
    the lineage, and survives the loss of any executor."""
    path = scratch(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, path: str) -> None:
    """Deletes a scratch folder that nothing reads any more."""
    files.delete_tree(spark, path)


def content(col: Column | str = "text") -> Column:
    """The text an operator works on: null counts as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def file_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes in ``column`` (one
    row at least), so that arrays made per byte stay small."""
    for b in batches:
        size = np.cumsum(np.diff(np.frombuffer(_offsets(b.column(column)), np.int64)))
        at = 0
        while at < b.num_rows:
            done = int(size[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(size, done + limit, "right")))
            yield b.slice(at, end - at)
            at = end


def _offsets(col: pa.Array) -> bytes:
    return text_bytes(col)[1].tobytes()


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column one after the other as bytes, and where each
    starts (one entry more than there are rows). A null is empty."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    _, off, data = col.buffers()
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    starts = np.frombuffer(off, wide)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[starts[0]:starts[-1]], starts - starts[0]


#: Odd multiplier and its inverse modulo 2**64, for polynomial hashes of byte strings.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: int = BASE) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64; a process keeps the first few million."""
    kept = _POWERS.get(base)
    if kept is None or len(kept) < n:
        out = np.full(max(n, 1 << 22), np.uint64(base))
        out[0] = 1
        kept = np.multiply.accumulate(out)
        if len(kept) <= 1 << 23:
            _POWERS[base] = kept
    return kept[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit moves every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: What a byte counts as in a hash.
BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


class Rolling:
    """Hashes of any substring of a byte string in constant time each: the
    polynomial sum over the substring, moved to a common origin, modulo
    2**64, and mixed. Meant for strings of up to some hundred bytes."""

    def __init__(self, raw: np.ndarray):
        self.back = powers(len(raw) + 1, INVERSE)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(BYTE[raw] * powers(len(raw)), out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start])


def words_of(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word (a run of bytes that are no ASCII
    white space, never across two rows)."""
    blank = np.zeros(256, bool)
    blank[list(SPACES)] = True
    inside = ~blank[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = starts[1:-1]
    cuts = cuts[cuts < len(raw)]
    first[cuts] |= inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = cuts[cuts > 0] - 1
    last[cuts] |= inside[cuts]
    s = np.flatnonzero(first)
    return s, np.flatnonzero(last) + 1, np.searchsorted(starts, s, "right") - 1
