"""Suffix-array dedup by prefix-free parsing: removes every byte that a string
of ``WINDOW`` bytes covers which starts anywhere else too.

Rolling-hash triggers (the least hash of any ``GRAM`` bytes within a window) cut
the corpus into phrases that overlap in their trigger, so equal text is cut
alike wherever it stands. The parse of a document is the sequence of its
triggers; the dictionary holds each distinct stretch around a trigger once,
with its number of occurrences, however often the corpus repeats it. Triggers
that occur once in the corpus can't lie in a repeated string and drop out at
once. The dictionary is sharded by trigger. A stretch that occurs twice is
repeated whole, and is settled without looking at its suffixes. Where one
trigger has several stretches, their suffixes are sorted: by trigger and
distance to it (the parse), then by their bytes, eight at a time, in corpus
order; a suffix that has become alone leaves the sort, and those that share all
``WINDOW`` bytes with a neighbour are repeats.

The suffixes of different stretches are compared by their bytes. Two things are
told apart by hashes: a stretch that occurs twice, by a 64-bit hash of its bytes
and length, and windows of triggers that more than ``HOT_CHUNKS`` chunks share,
by 128 bits (see ``anchored``). No suffix array of the parse or of the
dictionary is built.

Defined cases: a null text counts as empty; a null ``doc_id`` is kept; repeated
rows are copies of each other like any equal texts; other columns are ignored
(or carried along by ``deduplicated``). A cut that splits a character drops the
rest of that character from the returned text, but not from ``kept`` (bytes).
A text of 2**28 bytes or more is an error (``ValueError``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import anchored
from .anchored import Kind, Shard, spread
from .common import BYTE

WINDOW = 200
GRAM = 32


def _bytes(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return BYTE[raw], raw, starts


def repeats(window: int = WINDOW, gram: int = GRAM) -> Kind:
    return Kind(window, gram, _bytes)


def sorted_repeats(shard: Shard, kind: Kind) -> tuple[np.ndarray, np.ndarray]:
    """(distinct stretch of each entry, repeated windows by distinct stretch)."""
    meta = shard.meta
    _, one, which = np.unique(meta["stretch"], return_index=True, return_inverse=True)
    total = np.bincount(which, meta["copies"], len(one))
    anchor, ahead, windows = meta["anchor"][one], meta["ahead"][one], meta["windows"][one]
    offset = np.cumsum(windows) - windows  # of a stretch's windows among all
    repeated = np.repeat(total >= 2, windows)
    _, group, members = np.unique(anchor, return_inverse=True, return_counts=True)
    open_ = members[group] > 1  # the trigger has other stretches
    item, step = spread(np.where(open_, windows, 0))
    at = shard.begin[one][item] + step
    place = offset[item] + step
    # the parse: same trigger, same distance to it
    cls = group[item].astype(np.int64) << 20 | (ahead[item] - step)
    text = np.concatenate([shard.symbols, np.zeros(8, np.uint8)]).astype(np.uint64)
    for t in range(0, kind.window, 8):
        size = min(8, kind.window - t)
        word = np.zeros(len(at), np.uint64)
        for j in range(size):
            word = word << np.uint64(8) | text[at + t + j]
        order = np.lexsort((word, cls))
        c, w = cls[order], word[order]
        new = np.concatenate([[True], (c[1:] != c[:-1]) | (w[1:] != w[:-1])]) if len(c) else np.zeros(0, bool)
        number = np.cumsum(new) - 1
        shared = np.bincount(number)[number] > 1 if len(c) else new
        order, cls = order[shared], number[shared]
        at, place = at[order], place[order]
        if not len(at):
            break
    repeated[place] = True
    return which, repeated, offset, windows


def answer_shard(kind: Kind, shard: Shard) -> list[tuple]:
    out = []
    if len(shard.meta):
        which, repeated, offset, windows = sorted_repeats(shard, kind)
        entry, step = spread(windows[which])
        hit = repeated[offset[which][entry] + step]
        entry, step = entry[hit], step[hit]
        out += anchored.bit_rows(shard.chunk[entry], shard.meta["stretch"][entry], step, np.ones(len(step), np.int64))
    if len(shard.singles):
        s = shard.singles
        _, which = np.unique(s[["low", "high"]], return_inverse=True)
        hit = np.bincount(which, s["copies"])[which] >= 2
        out += anchored.bit_rows(shard.single_chunk[hit], s["stretch"][hit], s["k"][hit],
                                 np.ones(int(hit.sum()), np.int64))
    return out


def deduplicated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = anchored.HOT_CHUNKS) -> DataFrame:
    """Every row of ``docs`` with all its columns (as c0, c1, ... in their order;
    the text without what is removed), and n_bytes, n_removed, spans (start and
    end, in bytes, of each maximal removed run, one after the other) and kept
    (the remaining bytes)."""
    kind = Kind(window, gram, _bytes, hot)
    base = anchored.chunked(docs)
    found = anchored.marks(base, kind, np.uint8, lambda shard: answer_shard(kind, shard))
    text = base.column("text")
    names = [f"c{i}" for i in range(len(base.columns))]
    schema = ", ".join(f"{n} {t}" for n, t in zip(names, base.types, strict=True))
    schema += ", n_bytes long, n_removed long, spans array<long>, kept binary"

    def lay(left: pa.Table, right: pa.Table) -> list[pa.RecordBatch]:
        runs = anchored.answered(right)
        return [_cut(part, s, runs, names, text, window)
                for part, s in anchored.parts_of(kind, [anchored.ordered(left)], text)]

    return anchored.laid_over(base, found, lay, schema, "suffix-dedup")


def _cut(part: pa.RecordBatch, s: anchored.Stretches, runs: np.ndarray, names: list[str], text: str,
         window: int) -> pa.RecordBatch:
    gone = anchored.covered(anchored.marked(s, runs), window)
    lost = np.concatenate([[0], np.cumsum(gone)])
    removed = lost[s.starts[1:]] - lost[s.starts[:-1]]
    kept, spans, texts = [], [], []
    for i in range(part.num_rows):
        a, b = int(s.starts[i]), int(s.starts[i + 1])
        own, g = s.symbols[a:b], gone[a:b]
        rest = (own[~g] if removed[i] else own).tobytes()
        kept.append(rest)
        spans.append(np.flatnonzero(np.diff(g.astype(np.int8), prepend=0, append=0)).tolist() if removed[i] else [])
        texts.append(rest.decode("utf-8", "ignore"))
    cols = [pa.array(texts, pa.string()) if n == text else part.column(n) for n in names]
    cols += [pa.array(np.diff(s.starts), pa.int64()), pa.array(removed, pa.int64()),
             pa.array(spans, pa.list_(pa.int64())), pa.array(kept, pa.binary())]
    return pa.record_batch(cols, [*names, "n_bytes", "n_removed", "spans", "kept"])
