"""Substring dedup by repeated-phrase automata: of every sequence of ``WINDOW``
words that occurs more than once, all occurrences but the first are removed.

Anchors (see ``anchored``) bring together the stretches in which a sequence may
recur. Each shard groups their windows by a hash and takes from these candidates
its passages: the longest sequences all of whose windows have the same
occurrences, so that every window lies in one passage. It compiles them into
Aho-Corasick automata (pyahocorasick, over word numbers) and streams the
stretches it was sent, which come from all documents, through them. What they
find decides: a passage that is found at two places or more recurs, and of its
occurrences the first stays, the one of the smallest ``doc_id``, then of the
smallest start. (Windows that a hash put together though their words differ are
not found under each other's passage; they get passages of their own.)

Defined cases: a null text has no words; a null ``doc_id`` comes before all
others; rows that share a ``doc_id`` come in the order of the table as stored
for the run; other columns are ignored; a chunk (or one text) of 2**28 words or
more is an error (``ValueError``). Words are told apart by 64-bit hashes of
their bytes. The windows of anchors that more than ``HOT_CHUNKS`` chunks share
meet no automaton: they are told apart by 128-bit hashes of their words' hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import anchored
from .anchored import Kind, Shard, spread
from .common import Rolling, mixed, text_bytes, words_of

WINDOW = 20
GRAM = 8
#: Words in one automaton, at most (or one passage): its size in memory.
AUTOMATON_WORDS = 400_000
FIRST, LATER = 2, 1


def _words(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    s, e, row = words_of(raw, starts)
    value = Rolling(raw).of(s, e) if len(s) else np.zeros(0, np.uint64)
    return value, value, np.searchsorted(row, np.arange(len(starts)))


def _sequence_hashes(symbols: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    h = np.zeros(len(at), np.uint64)
    for j in range(window):
        h = mixed(h + symbols[at + j].astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
    return h


def passages(kind: np.ndarray, weight: np.ndarray, item: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows, in order of stretch and place, with their candidate ``kind``, the
    number of copies of each and its stretch: the first window and the number of
    windows of each passage, among those that are ``alive`` and recur."""
    total = np.bincount(kind, weight * alive)
    use = alive & (total[kind] >= 2)
    count = np.bincount(kind[use], minlength=len(total))
    x = np.flatnonzero(use[:-1] & use[1:] & (item[:-1] == item[1:])) if len(kind) > 1 else np.zeros(0, np.int64)
    # two kinds are linked if neither ever stands without the other next to it
    pair, of, times = np.unique(kind[x] * len(total) + kind[x + 1], return_inverse=True, return_counts=True)
    linked = (times == count[pair // len(total)]) & (times == count[pair % len(total)])
    on = np.zeros(len(kind) + 1, bool)  # whether the window before belongs to the same passage
    on[x[linked[of]] + 1] = True
    heads = np.flatnonzero(use & ~on[:-1])
    _, one = np.unique(kind[heads], return_index=True)
    heads = heads[one]
    ends = np.flatnonzero(~on)  # where no passage goes on
    return heads, ends[np.searchsorted(ends, heads, "right")] - heads


def automata(patterns: list[tuple]) -> Iterator:
    """Automata that give the number of the pattern that ends at a place."""
    import ahocorasick

    lo = 0
    while lo < len(patterns):
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        words = 0
        while lo < len(patterns) and (not words or words + len(patterns[lo]) <= AUTOMATON_WORDS):
            automaton.add_word(patterns[lo], lo)
            words += len(patterns[lo])
            lo += 1
        automaton.make_automaton()
        yield automaton


def locate(patterns: list[tuple], texts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pattern, text, first place) of every occurrence of any pattern in the texts."""
    which, text, first = [], [], []
    for automaton in automata(patterns):
        for k, words in enumerate(texts):
            for end, found in automaton.iter(words):
                which.append(found)
                text.append(k)
                first.append(end + 1 - len(patterns[found]))
    return np.array(which, np.int64), np.array(text, np.int64), np.array(first, np.int64)


def _occurrences(shard: Shard, one: np.ndarray, which: np.ndarray, window: int) \
        -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(passage, distinct stretch, first window in it, number of windows) of all that
    the automata find; passages are numbered anew in each round."""
    meta = shard.meta
    size, begin = meta["windows"][one].astype(np.int64), shard.begin[one]
    copies = np.bincount(which, meta["copies"], len(one))
    item, step = spread(size)
    _, kind = np.unique(_sequence_hashes(shard.symbols, begin[item] + step, window), return_inverse=True)
    weight, offset = copies[item], np.cumsum(size) - size
    alive = np.bincount(kind, weight)[kind] >= 2
    held = np.unique(item[alive])  # stretches that hold a candidate
    _, numbers = np.unique(shard.symbols, return_inverse=True)
    texts = [tuple(numbers[a:a + n].tolist()) for a, n in zip(begin[held], size[held] + window - 1, strict=True)]
    while True:
        heads, length = passages(kind, weight, item, alive)
        if not len(heads):
            return
        at = begin[item[heads]] + step[heads]
        patterns = [tuple(numbers[a:a + n + window - 1].tolist()) for a, n in zip(at, length, strict=True)]
        passage, text, first = locate(patterns, texts)
        stretch, n = held[text], length[passage]
        yield passage, stretch, first, n
        unit, k = spread(n)
        alive[offset[stretch[unit]] + first[unit] + k] = False
        alive[heads] = False


def answer_shard(kind: Kind, shard: Shard) -> list[tuple]:
    out = []
    if len(shard.meta):
        meta = shard.meta
        _, one, which = np.unique(meta["stretch"], return_index=True, return_inverse=True)
        by_stretch = np.argsort(which, kind="stable")
        entries = np.bincount(which, minlength=len(one))
        start = np.cumsum(entries) - entries
        for passage, stretch, first, n in _occurrences(shard, one, which, kind.window):
            found, nth = spread(entries[stretch])  # of each occurrence, all entries with its stretch
            entry = by_stretch[start[stretch[found]] + nth]
            recurs, earliest = _earliest([passage[found]], meta["order"][entry], meta["row"][entry],
                                         meta["at"][entry] + first[found], shard.chunk[entry], meta["copies"][entry])
            found, entry, earliest = found[recurs], entry[recurs], earliest[recurs]
            unit, k = spread(n[found])
            out += anchored.bit_rows(shard.chunk[entry][unit], meta["stretch"][entry][unit], first[found][unit] + k,
                                     np.where(earliest, FIRST, LATER)[unit])
    if len(shard.singles):
        s = shard.singles
        recurs, first = _earliest([s["low"], s["high"]], s["order"], s["row"], s["at"], shard.single_chunk, s["copies"])
        out += anchored.bit_rows(shard.single_chunk[recurs], s["stretch"][recurs], s["k"][recurs],
                                 np.where(first[recurs], FIRST, LATER))
    return out


def _earliest(key: list[np.ndarray], order: np.ndarray, row: np.ndarray, at: np.ndarray, chunk: np.ndarray,
              copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of occurrences of what ``key`` names: whether it recurs, and whether this is
    its first occurrence."""
    by = np.lexsort((at, row, chunk, order, *key))
    new = np.concatenate([[True], np.any([k[by][1:] != k[by][:-1] for k in key], axis=0)]) if len(by) else \
        np.zeros(0, bool)
    group = np.cumsum(new) - 1
    recurs, first = np.zeros(len(by), bool), np.zeros(len(by), bool)
    recurs[by] = np.bincount(group, copies[by])[group] >= 2 if len(by) else False
    first[by] = new
    return recurs, first


def deduplicated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = anchored.HOT_CHUNKS) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept) for every row: spans are the start
    and end, in words, of each removed run, one after the other; kept is the
    remaining words joined by single blanks."""
    kind = Kind(window, gram, _words, hot)
    base = anchored.chunked(docs.select("doc_id", "text"))
    found = anchored.marks(base, kind, np.uint64, lambda shard: answer_shard(kind, shard), "doc_id")
    text = base.column("text")

    def lay(left: pa.Table, right: pa.Table) -> list[pa.RecordBatch]:
        runs = anchored.answered(right)
        batch = anchored.ordered(left)
        parts = list(anchored.parts_of(kind, [batch], text))
        firsts = _first_in_chunk(parts)
        return [_cut(part, s, runs, first, window, text) for (part, s), first in zip(parts, firsts, strict=True)]

    return anchored.laid_over(base, found, lay, "doc_id long, n_words long, n_removed long, spans array<long>, kept string",
                              "phrase-dedup")


def _first_in_chunk(parts: list) -> list[np.ndarray]:
    """Per part, which stretches are the earliest of their kind in the chunk."""
    h = np.concatenate([s.hashes() for _, s in parts])
    order, row, at, part = [], [], [], []
    for i, (batch, s) in enumerate(parts):
        own = s.rows()
        order.append(anchored.orders(batch, "c0")[own])
        row.append(batch.column("row").to_numpy()[own])
        at.append(s.first - s.starts[own])
        part.append(np.full(len(own), i))
    order, row, at, part = map(np.concatenate, (order, row, at, part))
    by = np.lexsort((at, row, order, h))
    first = np.zeros(len(by), bool)
    first[by] = np.concatenate([[True], h[by][1:] != h[by][:-1]]) if len(by) else False
    return [first[part == i] for i in range(len(parts))]


def _cut(part: pa.RecordBatch, s: anchored.Stretches, runs: np.ndarray, first: np.ndarray, window: int,
         text: str) -> pa.RecordBatch:
    gone = anchored.covered(anchored.marked(s, runs, first), window)
    raw, starts = text_bytes(part.column(text))
    kept, spans, removed = [], [], []
    for i in range(part.num_rows):
        a, b = int(s.starts[i]), int(s.starts[i + 1])
        g = gone[a:b]
        n = int(g.sum())
        words = raw[starts[i]:starts[i + 1]].tobytes().split()
        if n:
            words = [w for w, lost in zip(words, g.tolist(), strict=True) if not lost]
        kept.append(b" ".join(words).decode())
        spans.append(np.flatnonzero(np.diff(g.astype(np.int8), prepend=0, append=0)).tolist() if n else [])
        removed.append(n)
    return pa.record_batch([part.column("c0").cast(pa.int64()), pa.array(np.diff(s.starts), pa.int64()),
                            pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.int64())),
                            pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "spans", "kept"])
