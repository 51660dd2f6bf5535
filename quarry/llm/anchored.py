"""Windows that occur more than once, found through anchors.

Shared by the byte-level and the word-level substring operators. A text is a
sequence of symbols (bytes or words); a *window* is ``window`` of them in a
row. A rolling hash of every ``gram`` symbols picks one gram of each window, its
*anchor*: the one of least hash, the last of equal ones. Equal windows have the
same anchor at the same place, so:

1. every chunk of documents sends the distinct hashes of its anchors, packed
   per shard; a shard answers which of them other chunks have too;
2. for anchors that recur, a chunk sends each distinct *stretch* (the run of
   windows that share the anchor, about two windows long) once, with its
   number of copies, to the shard of the anchor, which compares symbols and
   answers with one bit per window;
3. a chunk lays the answers over its documents.

Documents lie in a table bucketed by chunk, so their texts are never shuffled;
what moves are hashes, stretches that may recur, and bits. An anchor that very
many chunks share (a passage that a third of all documents has) would gather
its stretches in one shard; the windows of such anchors travel one by one, by
their own 128-bit hash, and so spread over all shards.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BASE, INVERSE, content, mixed, pieces, powers, release, scratch, stored, text_bytes

CHUNK_ROWS = 512
#: Bytes of a chunk, at most (or one text): longer texts come in chunks of fewer rows.
CHUNK_BYTES = 8 << 20
#: Chunks that share an anchor before its windows travel one by one.
HOT_CHUNKS = 500
SENT = "shard int, chunk long, meta binary, body binary"
#: kind 0: anchors that recur elsewhere; 1: anchors that very many chunks have; 2: bits of a stretch.
ANSWER = "chunk long, kind int, blob binary"
INDEX_BITS = np.uint64(28)
INDEX_MASK = np.uint64((1 << 28) - 1)

META = np.dtype([("anchor", "<u8"), ("stretch", "<u8"), ("ahead", "<i4"), ("windows", "<i4"), ("symbols", "<i4"),
                 ("copies", "<i4"), ("order", "<i8"), ("row", "<i8"), ("at", "<i8")])
SINGLE = np.dtype([("low", "<u8"), ("high", "<u8"), ("stretch", "<u8"), ("k", "<i4"), ("copies", "<i4"),
                   ("order", "<i8"), ("row", "<i8"), ("at", "<i8")])


@dataclass(frozen=True)
class Kind:
    """window, gram: in symbols. symbols(raw, starts): of the texts' bytes, the
    value of each symbol for hashing, the symbols themselves as they travel, and
    where each text starts among them. hot: see ``HOT_CHUNKS``."""

    window: int
    gram: int
    symbols: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]
    hot: int = HOT_CHUNKS


# --- the documents, bucketed by chunk ------------------------------------------------------


@dataclass
class Chunked:
    """``docs`` as a bucketed table with columns c0, c1, ... in the order of ``columns``."""

    spark: SparkSession
    name: str
    columns: list[str]
    types: list[str]
    buckets: int
    path: str

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        release(self.spark, self.path)

    def column(self, name: str) -> str:
        return f"c{self.columns.index(name)}"


def chunked(docs: DataFrame) -> Chunked:
    spark = docs.sparkSession
    columns, types = docs.columns, [t for _, t in docs.dtypes]
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    text = f"c{columns.index('text')}"
    rows = (rows.withColumn(text, content(text)).withColumn("id", F.monotonically_increasing_id())
            .withColumn("row", F.col("id").bitwiseAND((1 << 33) - 1)))
    # rows per chunk by the text's length: 512, 256, ... 1
    few = F.lit(0)
    for k in range(1, CHUNK_ROWS.bit_length()):
        few = F.when(F.octet_length(text) <= CHUNK_BYTES >> k, F.lit(k)).otherwise(few)
    chunk = "(id >> 33) * (1L << 38) + few * (1L << 34) + (row div (1L << few))"
    rows = rows.withColumn("few", few).withColumn("chunk", F.expr(chunk)).drop("id", "few")
    buckets = max(shuffles, 1)
    out = Chunked(spark, f"chunked_{uuid.uuid4().hex}", columns, types, buckets, scratch(spark, "chunked"))
    rows.write.bucketBy(buckets, "chunk").option("path", out.path).mode("overwrite").saveAsTable(out.name)
    return out


# --- anchors and stretches -------------------------------------------------------------


@dataclass
class Stretches:
    """The stretches of some texts. first, last: window starts; anchor: place of the anchor; all in symbols."""

    value: np.ndarray
    symbols: np.ndarray
    starts: np.ndarray
    first: np.ndarray
    last: np.ndarray
    place: np.ndarray
    anchor: np.ndarray
    window: int
    sums: np.ndarray = field(repr=False, default=None)
    back: np.ndarray = field(repr=False, default=None)

    def hashes(self) -> np.ndarray:
        """One hash per stretch, of its symbols and its length."""
        end = self.last + self.window
        h = (self.sums[end] - self.sums[self.first]) * self.back[self.first]
        return mixed(h + (end - self.first).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))

    def rows(self) -> np.ndarray:
        return np.searchsorted(self.starts, self.first, "right") - 1


def _sums(value: np.ndarray, base: int, inverse: int) -> tuple[np.ndarray, np.ndarray]:
    sums = np.zeros(len(value) + 1, np.uint64)
    np.cumsum(value * powers(len(value), base), out=sums[1:])
    return sums, powers(len(value) + 1, inverse)


def stretches(kind: Kind, raw: np.ndarray, starts: np.ndarray) -> Stretches:
    value, symbols, at = kind.symbols(raw, starts)
    sums, back = _sums(value, BASE, INVERSE)
    if len(value) > int(INDEX_MASK):
        raise ValueError(f"{len(value)} symbols in one piece of a chunk, the most is 2**28 - 1")
    n, grams = len(value) - kind.gram + 1, kind.window - kind.gram + 1
    none = np.zeros(0, np.int64)
    if len(value) < kind.window:
        return Stretches(value, symbols, at, none, none, none, np.zeros(0, np.uint64), kind.window, sums, back)
    gram = mixed((sums[kind.gram:] - sums[:n]) * back[:n])
    # least hash first, of equal ones the last: hash above, place counted down below
    key = (gram & ~INDEX_MASK) | (INDEX_MASK - np.arange(n, dtype=np.uint64))
    size = 1
    while size * 2 <= grams:
        key = np.minimum(key[:len(key) - size], key[size:])
        size *= 2
    if grams > size:
        key = np.minimum(key[:len(key) - (grams - size)], key[grams - size:])
    inside = np.zeros(len(value) - kind.window + 1, bool)  # windows that lie in one text
    room = np.maximum(np.diff(at) - kind.window + 1, 0)
    mark = np.zeros(len(inside) + 1, np.int64)
    has = room > 0
    np.add.at(mark, at[:-1][has], 1)
    np.add.at(mark, at[:-1][has] + room[has], -1)
    inside = np.cumsum(mark)[:-1] > 0
    x = np.flatnonzero(inside)
    if not len(x):
        return Stretches(value, symbols, at, none, none, none, np.zeros(0, np.uint64), kind.window, sums, back)
    place = (INDEX_MASK - (key[x] & INDEX_MASK)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    end = np.concatenate([new[1:], [len(x)]]) - 1
    return Stretches(value, symbols, at, x[new], x[end], place[new], gram[place[new]], kind.window, sums, back)


def parts_of(kind: Kind, batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, Stretches]]:
    for part in pieces(batches, text):
        raw, starts = text_bytes(part.column(text))
        yield part, stretches(kind, raw, starts)


def spread(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts per item: the item of each unit, and its number within the item."""
    of = np.repeat(np.arange(len(count)), count)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)


def _by_shard(keys: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    shard = (keys >> np.uint64(20)) % np.uint64(shards)
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(shard[part[0]]), part


def _sent(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * 4
    return pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.binary(), pa.binary()),
                                                           strict=True)], ["shard", "chunk", "meta", "body"])


def answers(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) or [()] * 3
    return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.binary()), strict=True)],
                    ["chunk", "kind", "blob"])


def recurring_anchors(kind: Kind, base: Chunked, shards: int) -> DataFrame:
    """Of every chunk, the anchors that another chunk has too (kinds 0 and 1)."""
    text = base.column("text")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            chunk = b.column("chunk").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if hi > lo:
                    found = [s.anchor for _, s in parts_of(kind, [b.slice(lo, hi - lo)], text)]
                    keys = np.unique(np.concatenate(found))
                    yield _sent([(shard, int(chunk[lo]), keys[part].tobytes(), None)
                                 for shard, part in _by_shard(keys, shards)])

    def answer(table: pa.Table) -> pa.Table:
        chunks = np.concatenate([np.full(len(m) // 8, i) for i, m in enumerate(table["meta"].to_pylist())])
        keys = np.frombuffer(b"".join(table["meta"].to_pylist()), "<u8")
        chunk = table["chunk"].to_numpy()[chunks]
        order = np.lexsort((chunk, keys))
        keys, chunk = keys[order], chunk[order]
        first = np.concatenate([[True], (keys[1:] != keys[:-1]) | (chunk[1:] != chunk[:-1])])
        keys, chunk = keys[first], chunk[first]
        _, which, count = np.unique(keys, return_inverse=True, return_counts=True)
        out = []
        for k, hit in ((0, (count >= 2) & (count <= kind.hot)), (1, (count >= 2) & (count > kind.hot))):
            mine = np.flatnonzero(hit[which])
            mine = mine[np.argsort(chunk[mine], kind="stable")]
            for part in np.split(mine, np.flatnonzero(np.diff(chunk[mine])) + 1):
                if len(part):
                    out.append((int(chunk[part[0]]), k, keys[part].tobytes()))
        return answers(out)

    return (base.read().select("chunk", text).mapInArrow(send, SENT).groupBy("shard").applyInArrow(answer, ANSWER))


def ordered(table: pa.Table) -> pa.RecordBatch:
    return pa.Table.from_batches(table.sort_by("row").to_batches()).combine_chunks().to_batches()[0]


def _blobs(table: pa.Table, kind: int, dtype) -> np.ndarray:
    blobs = [b for b, k in zip(table["blob"].to_pylist(), table["kind"].to_pylist(), strict=True) if k == kind]
    return np.frombuffer(b"".join(blobs), dtype)


def _isin(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)
    return sorted_set[at] == values


def send_stretches(kind: Kind, base: Chunked, anchors: DataFrame, shards: int, order: str | None) -> DataFrame:
    """The distinct stretches of every chunk whose anchors recur, to their shards."""
    text = base.column("text")
    order_col = base.column(order) if order else None

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows:
            chunk = left["chunk"][0].as_py()
            parts = list(parts_of(kind, [ordered(left)], text))
            elsewhere, hot = (np.sort(_blobs(right, k, "<u8")) for k in (0, 1))
            own, times = np.unique(np.concatenate([s.anchor for _, s in parts]), return_counts=True)
            own = own[times > 1]
            rows = _packed(kind, chunk, parts, elsewhere, own, hot, shards, order_col)
        return pa.Table.from_batches([_sent(rows)])

    return (base.read().groupBy("chunk").cogroup(anchors.groupBy("chunk")).applyInArrow(send, SENT))


def _packed(kind: Kind, chunk: int, parts: list, elsewhere: np.ndarray, own: np.ndarray, hot: np.ndarray,
            shards: int, order_col: str | None) -> list[tuple]:
    metas, bodies = [], []
    for part, s in parts:
        pick = _isin(s.anchor, elsewhere) | _isin(s.anchor, own) | _isin(s.anchor, hot)
        if not pick.any():
            continue
        all_hashes = s.hashes()
        row = s.rows()
        ids = orders(part, order_col)
        i = np.flatnonzero(pick)
        meta = np.zeros(len(i), META)
        meta["anchor"], meta["stretch"] = s.anchor[i], all_hashes[i]
        meta["ahead"], meta["windows"] = s.place[i] - s.first[i], s.last[i] - s.first[i] + 1
        meta["symbols"] = meta["windows"] + kind.window - 1
        meta["order"], meta["row"] = ids[row[i]], part.column("row").to_numpy()[row[i]]
        meta["at"] = s.first[i] - s.starts[row[i]]
        metas.append(meta)
        bodies.append((s, s.first[i]))
    if not metas:
        return []
    meta = np.concatenate(metas)
    source = np.repeat(np.arange(len(metas)), [len(m) for m in metas])
    where = np.concatenate([f for _, f in bodies])
    # one of each distinct stretch, its earliest occurrence, with the number of its copies
    by = np.lexsort((meta["at"], meta["row"], meta["order"], meta["stretch"]))
    head = np.flatnonzero(np.concatenate([[True], np.diff(meta["stretch"][by]) != 0]))
    copies = np.diff(np.concatenate([head, [len(by)]]))
    one = by[head]
    meta, source, where = meta[one], source[one], where[one]
    meta["copies"] = copies
    alone = _isin(meta["anchor"], hot)
    out = []
    for shard, part in _by_shard(meta["anchor"][~alone], shards):
        part = np.flatnonzero(~alone)[part]
        body = b"".join(bodies[source[j]][0].symbols[where[j]:where[j] + meta["symbols"][j]].tobytes() for j in part)
        out.append((shard, chunk, meta[part].tobytes(), body))
    if alone.any():
        singles = _singles(kind, meta, source, where, bodies, np.flatnonzero(alone))
        for shard, part in _by_shard(singles["low"], shards):
            out.append((shard, chunk, singles[part].tobytes(), None))
    return out


def orders(part: pa.RecordBatch, order_col: str | None) -> np.ndarray:
    """The ids documents are ordered by; a null comes before all others."""
    if order_col is None:
        return np.zeros(part.num_rows, np.int64)
    return part.column(order_col).cast(pa.int64()).fill_null(-(1 << 63)).to_numpy()


SECOND = 0xC2B2AE3D27D4EB4F
SECOND_INVERSE = pow(SECOND, -1, 1 << 64)


def _singles(kind: Kind, meta: np.ndarray, source: np.ndarray, where: np.ndarray, bodies: list,
             pick: np.ndarray) -> np.ndarray:
    """The windows of stretches ``pick`` one by one, each under two hashes."""
    out = []
    for k in np.unique(source[pick]):
        s = bodies[k][0]
        own = pick[source[pick] == k]
        item, step = spread(meta["windows"][own])
        of = own[item]
        x = where[of] + step
        sums, back = _sums(s.value, SECOND, SECOND_INVERSE)
        one = np.zeros(len(of), SINGLE)
        one["low"] = mixed((s.sums[x + kind.window] - s.sums[x]) * s.back[x])
        one["high"] = mixed((sums[x + kind.window] - sums[x]) * back[x])
        one["stretch"], one["k"] = meta["stretch"][of], step
        for name in ("copies", "order", "row"):
            one[name] = meta[name][of]
        one["at"] = meta["at"][of] + step
        out.append(one)
    return np.concatenate(out)


def marks(base: Chunked, kind: Kind, symbol, judge: Callable[["Shard"], list[tuple]], order: str | None = None) -> DataFrame:
    """The answers of kind 2 for every chunk, stored. ``judge`` looks at what one
    shard has received and returns them (``bit_rows``)."""
    shards = 4 * base.buckets
    anchors = stored(base.spark, recurring_anchors(kind, base, shards), "anchors")

    def answer(table: pa.Table) -> pa.Table:
        return answers(judge(received(table, symbol)))

    sent = send_stretches(kind, base, anchors, shards, order)
    return stored(base.spark, sent.groupBy("shard").applyInArrow(answer, ANSWER), "answers")


def laid_over(base: Chunked, found: DataFrame, lay: Callable[[pa.Table, pa.Table], list[pa.RecordBatch]],
              schema: str, label: str) -> DataFrame:
    """``lay(documents, answers)`` of every chunk, stored; then the base goes."""
    names = [f.split()[0] for f in schema.split(", ")]

    def over(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:  # answers always are for a chunk with documents
            return pa.table({n: pa.array([]) for n in names})
        return pa.Table.from_batches(lay(left, right))

    out = stored(base.spark, base.read().groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(over, schema),
                 label)
    base.drop()
    return out


@dataclass
class Shard:
    """What one shard has been sent: stretches with their symbols, and single windows."""

    meta: np.ndarray
    chunk: np.ndarray
    symbols: np.ndarray  # of all stretches, one after the other
    begin: np.ndarray
    singles: np.ndarray
    single_chunk: np.ndarray


def received(table: pa.Table, symbol) -> Shard:
    metas, bodies, chunks, singles, single_chunks = [], [], [], [], []
    for chunk, meta, body in zip(table["chunk"].to_pylist(), table["meta"].to_pylist(), table["body"].to_pylist(),
                                 strict=True):
        if body is None:
            singles.append(np.frombuffer(meta, SINGLE))
            single_chunks.append(np.full(len(singles[-1]), chunk))
        else:
            metas.append(np.frombuffer(meta, META))
            bodies.append(body)
            chunks.append(np.full(len(metas[-1]), chunk))
    join = lambda xs, empty: np.concatenate(xs) if xs else empty
    meta = join(metas, np.zeros(0, META))
    size = meta["symbols"].astype(np.int64)
    return Shard(meta, join(chunks, np.zeros(0, np.int64)), np.frombuffer(b"".join(bodies), symbol),
                 np.cumsum(size) - size, join(singles, np.zeros(0, SINGLE)),
                 join(single_chunks, np.zeros(0, np.int64)))


def bit_rows(chunk: np.ndarray, stretch: np.ndarray, k: np.ndarray, states: np.ndarray) -> list[tuple]:
    """Answers of kind 2 for windows k of stretches: per chunk, each stretch's hash
    and a state (1 or 2) for each of its windows that has one."""
    entry = np.dtype([("stretch", "<u8"), ("k", "<i4"), ("state", "<i4")])
    order = np.argsort(chunk, kind="stable")
    out = []
    for part in np.split(order, np.flatnonzero(np.diff(chunk[order])) + 1):
        if len(part):
            rec = np.zeros(len(part), entry)
            rec["stretch"], rec["k"], rec["state"] = stretch[part], k[part], states[part]
            out.append((int(chunk[part[0]]), 2, _runs(rec)))
    return out


RUN = np.dtype([("stretch", "<u8"), ("k", "<i2"), ("length", "<i2"), ("state", "<i2")])


def _runs(rec: np.ndarray) -> bytes:
    """Neighbouring windows of one stretch and state as one entry."""
    rec = rec[np.lexsort((rec["k"], rec["stretch"]))]
    new = np.concatenate([[True], (np.diff(rec["stretch"]) != 0) | (np.diff(rec["k"]) != 1)
                          | (np.diff(rec["state"]) != 0)])
    head = np.flatnonzero(new)
    out = np.zeros(len(head), RUN)
    out["stretch"], out["k"], out["state"] = rec["stretch"][head], rec["k"][head], rec["state"][head]
    out["length"] = np.diff(np.concatenate([head, [len(rec)]]))
    return out.tobytes()


def answered(table: pa.Table) -> np.ndarray:
    """All answers of kind 2 for a chunk, by stretch."""
    runs = _blobs(table, 2, RUN)
    return runs[np.argsort(runs["stretch"], kind="stable")]


def marked(s: Stretches, runs: np.ndarray, keep_first: np.ndarray | None = None) -> np.ndarray:
    """Which windows (by their start among the symbols) the answers mark. With
    ``keep_first`` (per stretch), windows of state 2 are left out there."""
    mark = np.zeros(len(s.value) + 1, np.int64)
    if len(runs) and len(s.first):
        h = s.hashes()
        lo, hi = np.searchsorted(runs["stretch"], h, "left"), np.searchsorted(runs["stretch"], h, "right")
        of, nth = spread(hi - lo)
        r = runs[lo[of] + nth]
        if keep_first is not None:
            stay = ~((r["state"] == 2) & keep_first[of])
            of, r = of[stay], r[stay]
        start = s.first[of] + r["k"]
        np.add.at(mark, start, 1)
        np.add.at(mark, start + r["length"], -1)
    return np.cumsum(mark)[:-1] > 0


def covered(windows: np.ndarray, size: int) -> np.ndarray:
    """Symbols inside any of the marked windows."""
    starts = np.flatnonzero(windows)
    mark = np.zeros(len(windows) + 1, np.int64)
    np.add.at(mark, starts, 1)
    np.add.at(mark, starts + size, -1)
    return np.cumsum(mark)[:-1] > 0
