"""Packing token sequences by vector bin packing.

Every sequence has room for so many tokens, segments and loss-bearing tokens
at once (``LIMITS``); the first tokens of a document, its prompt, bear no loss
(``prompt_of``). The limit on loss lies below that on tokens, so a sequence can't
be filled from the inside of long texts alone: prompts of others go with them. Open remainders wait in a pool; a sequence is filled by placing, of
all that fit, the one whose demand has the largest dot product with the room
left (both as shares of the limits), so long texts, many-segment sequences and
loss-heavy texts balance each other. When nothing fits whole, the best one is
cut to fill the sequence to the last token. What a document has in whole
sequences is cut off first. A sequence that must close early (no segments
left, or the input has ended) keeps the largest power of two of tokens, which
needs no padding, and gives the rest back to the pool.

Each input partition packs its own documents as they stream by: nothing is
shuffled, and a task holds only its pool. Packing has no global state, so a
lost task is simply run again.

Defined cases: a null text is empty (its one token is the end token); a null
``doc_id`` is kept; repeated rows are packed each for itself; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import loaded

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
          "`offset` long, loss_tokens long")
#: Remainders to choose from.
POOL = 512
#: Tokens (a power of two), segments and loss-bearing tokens of a sequence.
LIMITS = (4096, 256, 3840)


def prompt_of(tokens: int) -> int:
    """How many of a document's tokens are its prompt: a quarter, at most 256."""
    return min(tokens // 4, 256)


class Packer:
    """Packs items cut from documents. ``limits``: tokens (a power of two),
    segments and loss-bearing tokens of a sequence."""

    def __init__(self, limits: tuple[int, int, int], pool: int = POOL):
        self.limits = np.array(limits, float)
        self.tokens, self.segments, self.loss = limits
        self.pool = pool
        self.items: list[tuple] = []  # (document, start, length)
        self.need = np.zeros((pool * 2, 3))  # their tokens, 1, their loss-bearing tokens
        self.sequence = 0

    @staticmethod
    def _loss(doc: tuple, start: int, length: int) -> int:
        """Tokens of a piece that bear loss: those after the document's prompt."""
        return max(0, start + length - max(start, doc[2]))

    def _put(self, doc: tuple, start: int, length: int) -> None:
        if len(self.items) >= len(self.need):
            self.need = np.concatenate([self.need, np.zeros_like(self.need)])
        self.need[len(self.items)] = (length, 1, self._loss(doc, start, length))
        self.items.append((doc, start, length))

    def _take(self, i: int) -> tuple:
        item, last = self.items[i], self.items.pop()
        if i < len(self.items):
            self.items[i] = last
            self.need[i] = self.need[len(self.items)]
        return item

    def _shut(self, pieces: list[tuple]) -> Iterator[tuple]:
        at = 0
        for doc, start, length in pieces:
            yield doc, start, length, self.sequence, at, self._loss(doc, start, length)
            at += length
        self.sequence += 1

    def add(self, doc: tuple) -> Iterator[tuple]:
        """``doc``: (anything, its number of tokens, prompt tokens without loss). Yields
        pieces (doc, start, length, sequence, offset, loss tokens) that are settled."""
        _, n, _ = doc
        start = 0
        while n - start >= self.tokens and self._loss(doc, start, self.tokens) <= self.loss:
            yield from self._shut([(doc, start, self.tokens)])
            start += self.tokens
        if start < n:
            self._put(doc, start, n - start)
        while len(self.items) >= self.pool:
            yield from self._fill()

    def end(self) -> Iterator[tuple]:
        while self.items:
            yield from self._fill()

    def _fill(self) -> Iterator[tuple]:
        """One sequence from the pool."""
        room = self.limits.copy()
        pieces: list[tuple] = []
        while self.items and room[0] > 0 and room[1] > 0:
            need = self.need[:len(self.items)]
            fits = (need <= room).all(axis=1)
            worth = need @ (room / self.limits ** 2)
            if fits.any():
                i = int(np.argmax(np.where(fits, worth, -1)))
                doc, start, length = self._take(i)
            else:
                i = int(np.argmax(worth))
                doc, start, length = self.items[i]
                # as much of it as the tokens and the loss allow
                cut = int(min(room[0], length, max(start, doc[2]) - start + room[2]))
                if cut <= 0:
                    break
                self._take(i)
                if cut < length:
                    self._put(doc, start + cut, length - cut)
                length = cut
            pieces.append((doc, start, length))
            room -= (length, 1, self._loss(doc, start, length))
        total = sum(p[2] for p in pieces)
        keep = 1 << (total.bit_length() - 1)
        while total > keep:  # not a power of two: the rest goes back
            doc, start, length = pieces.pop()
            back = min(length, total - keep)
            self._put(doc, start + length - back, back)
            if back < length:
                pieces.append((doc, start, length - back))
            total -= back
        yield from self._shut(pieces)


def pack(docs: DataFrame, encode: Callable[[], Callable[[str], bytes]], limits: tuple[int, int, int] = LIMITS,
         prompt: Callable[[int], int] = prompt_of) -> DataFrame:
    """All of ``docs`` (doc_id, text) in sequences. ``encode()``, called once per
    task, gives a function from a text to its ids (little-endian unsigned 32-bit);
    the first ``prompt(n)`` tokens of a document of n bear no loss. Returns one row per
    piece, with its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids_of, packer = encode(), Packer(limits)
        base = TaskContext.get().partitionId() << 33
        out: list[tuple] = []
        size = 0

        def rows() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) or [()] * 8
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
            return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                   ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset",
                                    "loss_tokens"])

        def settle(pieces: Iterator[tuple]) -> None:
            nonlocal size
            for ((doc_id, ids), n, _), start, length, sequence, at, loss in pieces:
                out.append((doc_id, start, length, ids[4 * start:4 * (start + length)], n, base + sequence, at, loss))
                size += length

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = ids_of(text.as_py() or "")
                n = len(ids) // 4
                settle(packer.add(((doc_id, ids), n, prompt(n))))
                if size > 1 << 20:
                    yield rows()
                    out, size = [], 0
        settle(packer.end())
        yield rows()

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def bpe_with_end(path: str, end: int) -> Callable[[], Callable[[str], bytes]]:
    """Encoder for ``pack``: the file's ids of the whole text, then ``end``."""
    tail = struct.pack("<I", end)
    return lambda: lambda text: loaded(path).ids(text) + tail
