"""SentencePiece BPE encoding by a prefix table, and decoding.

For every prefix of a word the table stores the one token that the encoding of
that prefix ends with. An automaton over all pieces lists the pieces that end
at a position; of these, the right one is the one that is *compatible* with
the last token of the prefix before it: two tokens are compatible if BPE on
their joined spelling ends with just these two. The ids are then recovered
from the end of the word backwards.

Compatibility looks at the boundary only. Backwards in merge order, the later
of the two tokens' own last merges is undone, which leaves the part next to
the boundary; the two tokens are incompatible if at any step the parts next to
the boundary would themselves have merged before the merge just undone (on
equal merges the left one comes first, as in the library).

No piece has a blank after another character, so a text is cut before blanks.
Nor has any a Latin letter beside a digit, an ASCII sign or a line break, so a
text of these alone is cut there too (both are checked when a model is loaded).
Each distinct part is encoded once per worker process: the parts of a batch
that are new are encoded together, position by position, as arrays over all of
them (``PartTable``); other texts word by word.

Defined cases: a null text is empty and has no ids; a null ``doc_id`` is kept;
repeated rows each get a row; other columns are ignored. A model that changes
texts before it cuts them (other than blanks to their sign, with one in front)
is an error (``ValueError``).
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pieces as slices

BLANK = "▁"
BEFORE_BLANK = re.compile(f"(?<=[^{BLANK}])(?={BLANK})")
LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
PARTS = re.compile(f"{BLANK}?(?:[{LATIN}]+|[^{LATIN}{BLANK}]+)|{BLANK}")
PLAIN_TEXT = re.compile(f"[\n -~{LATIN}]*")
MIXED = re.compile(f"[{LATIN}][^{LATIN}]|[^{LATIN}{BLANK}][{LATIN}]|[^{BLANK}]{BLANK}")
#: Parts a process remembers in each of two generations: a full one becomes
#: the older, and a part found there moves on, so common parts are never lost.
REMEMBER = 300_000
#: Longer parts go through the table one by one and are not remembered.
LONG = 40
PAIRS = 1_000_000
#: Slots of the memory of pair verdicts, a power of two.
SLOTS = 1 << 20
SCHEMA = "doc_id long, ids array<int>, decoded string"

codecs.register_error("each-byte", lambda e: ("�", e.start + 1))


#: Pieces that a text of Latin letters and ASCII can hold.
PLAIN_PIECE = re.compile(f"[\\n -~{LATIN}{BLANK}]+")
#: Texts that a changing normaliser would change.
PROBES = ["ﬁ Ａ  é e\u0301 \u00a0x\u200b ", " a\tb\r\n  c ", "Ⅷ½ ＢＣ"]


def _plain_normalizer(sp) -> bool:
    """Whether encoding and decoding give a text back, as they do if the model only
    turns blanks into their sign and puts one in front."""
    return all(sp.decode(sp.encode(x)) == x for x in PROBES) and not sp.encode("")


class PrefixEncoder:
    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.spelling: list[str] = [sp.id_to_piece(i) for i in range(n)]
        self.raw: list[bytes] = []  # what an id stands for in a decoded text
        self.byte_id: dict[int, int] = {}
        pieces: dict[str, int] = {}
        for i, piece in enumerate(self.spelling):
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.raw.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_unknown(i):
                self.raw.append(" ⁇ ".encode())
                self.unknown = i
            elif sp.is_control(i):
                self.raw.append(b"")
            else:
                pieces[piece] = i
                self.raw.append(piece.replace(BLANK, " ").encode())
        self.pieces = pieces
        #: Merges are done from the best score down, equal ones from the left.
        scores = sorted({sp.get_score(i) for i in pieces.values()}, reverse=True)
        of_score = {score: k for k, score in enumerate(scores)}
        self.rank = {i: of_score[sp.get_score(i)] for i in pieces.values()}
        self.parts: dict[int, tuple[int, int]] = {}  # the two tokens a token was merged from
        self.fits: dict[int, bool] = {}
        if not _plain_normalizer(sp):
            raise ValueError(f"{path}: a model that changes texts before it cuts them")
        if any(BLANK in p.lstrip(BLANK) for p in pieces):
            raise ValueError(f"{path}: a piece has a blank after another character")
        self.cuts_at_signs = not any(MIXED.search(p) for p in pieces if PLAIN_PIECE.fullmatch(p))
        automaton = ahocorasick.Automaton()
        reached = 0
        for piece in sorted(pieces, key=len):
            if self._merged_from(piece):
                automaton.add_word(piece, (pieces[piece], len(piece)))
                reached += 1
        automaton.make_automaton()
        self.automaton = automaton
        self.unreached = len(pieces) - reached

    def _merged_from(self, piece: str) -> bool:
        """Finds the split of ``piece`` whose sides encode as themselves and are
        merged last; False if BPE never builds this piece."""
        t = self.pieces[piece]
        if len(piece) == 1:
            return True
        found = []
        for k in range(1, len(piece)):
            a, b = self.pieces.get(piece[:k]), self.pieces.get(piece[k:])
            if a is None or b is None or not (len(piece[:k]) == 1 or a in self.parts) \
                    or not (len(piece[k:]) == 1 or b in self.parts):
                continue
            if self.rank[a] > self.rank[t] and k > 1 or self.rank[b] > self.rank[t] and len(piece) - k > 1:
                continue
            if self._compatible(a, b, self.rank[t]):
                found.append((a, b))
        if len(found) > 1:
            raise ValueError(f"{piece!r} has two derivations")
        if found:
            self.parts[t] = found[0]
        return bool(found)

    def _compatible(self, a: int, b: int, limit: int | None = None) -> bool:
        """Whether nothing merges across the boundary of a and b before
        ``limit`` (None: ever)."""
        rank, parts, pieces, spelling = self.rank, self.parts, self.pieces, self.spelling
        limit = len(rank) + 1 if limit is None else limit
        while True:
            joined = pieces.get(spelling[a] + spelling[b])
            if joined is not None and rank[joined] < limit:
                return False
            left, right = parts.get(a), parts.get(b)
            if left is None and right is None:
                return True
            if right is None or left is not None and rank[a] > rank[b]:
                limit = rank[a]
                a = left[1]
            else:
                limit = rank[b] + 1
                b = right[0]

    def _pair(self, a: int, b: int) -> bool:
        key = a << 20 | b
        out = self.fits.get(key)
        if out is None:
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            out = self.fits[key] = self._compatible(a, b)
        return out

    def word(self, word: str) -> tuple[int, ...]:
        """Ids of a word (in the library's spelling, with its blank)."""
        last = [-1] * (len(word) + 1)  # the last token of each prefix; -1: a character without a piece
        for end, (token, length) in self.automaton.iter(word):
            start = end + 1 - length
            before = last[start]
            if before < 0 or self._pair(before, token):
                last[end + 1] = token
        out: list[int] = []
        at = len(word)
        while at:
            token = last[at]
            if token < 0:  # spelled in bytes, or unknown
                out += [self.byte_id.get(x, self.unknown) for x in reversed(word[at - 1].encode())] \
                    if self.byte_id else [self.unknown]
                at -= 1
            else:
                out.append(token)
                at -= len(self.spelling[token])
        return tuple(reversed(out))

    def encode(self, text: str) -> list[int]:
        """Ids of a text, word by word."""
        if not text:
            return []
        return list(chain.from_iterable(map(self.word, BEFORE_BLANK.split(BLANK + text.replace(" ", BLANK)))))

    def decode(self, ids: list[int]) -> str:
        """The text of ids: spellings with blanks, byte pieces joined to
        characters (each byte that is part of none becomes U+FFFD), without the
        blank that encoding put in front."""
        return self.shown(b"".join(map(self.raw.__getitem__, ids)), ids[:1])

    def shown(self, raw: bytes, first: list[int]) -> str:
        text = raw.decode("utf-8", "each-byte")
        return text[1:] if first and first[0] in self.rank and self.spelling[first[0]].startswith(BLANK) else text


class PartTable:
    """The prefix table of many parts at once, and what each part was encoded to.

    The automaton of the pieces over Latin letters, ASCII and the blank sign is
    laid out as an array of transitions; a state's matches are a chain, longest
    first. All parts go through it side by side, one position after the other."""

    def __init__(self, encoder: PrefixEncoder, remember: int = REMEMBER):
        self.encoder, self.remember = encoder, remember
        self.seen: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}
        alphabet = [BLANK, "\n", *map(chr, range(33, 127)), *[chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]]
        #: Character to column; the last column is that of characters in no piece.
        self.column = np.full(0x2600, len(alphabet), np.int32)
        self.column[[ord(c) for c in alphabet]] = range(len(alphabet))
        inside = set(alphabet)
        pieces = {p: i for p, i in encoder.pieces.items() if set(p) <= inside and (len(p) == 1 or i in encoder.parts)}
        self._automaton(pieces, len(alphabet) + 1)
        self.key = np.full(SLOTS, -1, np.int64)
        self.verdict = np.zeros(SLOTS, bool)
        n = len(encoder.spelling)
        self.rank = np.full(n, -1, np.int64)
        self.rank[list(encoder.rank)] = list(encoder.rank.values())
        self.inner = np.full((n, 2), -1, np.int64)  # right side of the left parts, left side of the right ones
        for t, (a, b) in encoder.parts.items():
            self.inner[t] = (b, a)
        split = [(encoder.pieces[p[:k]] * n + encoder.pieces[p[k:]], encoder.rank[i])
                 for p, i in encoder.pieces.items() for k in range(1, len(p))
                 if p[:k] in encoder.pieces and p[k:] in encoder.pieces]
        joined = np.array(sorted(split) or [(-1, 0)], np.int64)
        self.joined, self.joined_rank = joined[:, 0], joined[:, 1]

    def _automaton(self, pieces: dict[str, int], width: int) -> None:
        children: list[dict[str, int]] = [{}]
        ends = [-1]
        for piece, token in pieces.items():
            at = 0
            for c in piece:
                at = children[at].setdefault(c, len(children))
                if at == len(children):
                    children.append({})
                    ends.append(-1)
            ends[at] = token
        self.go = np.zeros((len(children), width), np.int32)
        fail = np.zeros(len(children), np.int32)
        self.match = np.full(len(children), -1, np.int32)  # the longest piece that ends in a state
        self.shorter = np.zeros(len(children), np.int32)   # the state of the next shorter one
        level = [0]
        while level:
            deeper = []
            for state in level:
                if state:
                    self.go[state] = self.go[fail[state]]
                    behind = fail[state]
                    self.shorter[state] = behind if self.match[behind] >= 0 else 0
                    self.match[state] = ends[state]
                    if ends[state] < 0:
                        self.match[state], self.shorter[state] = self.match[behind], self.shorter[behind]
                for c, child in children[state].items():
                    k = self.column[ord(c)]
                    fail[child] = self.go[state, k] if state else 0
                    self.go[state, k] = child
                    deeper.append(child)
            level = deeper
        self.length = np.zeros(len(self.encoder.spelling), np.int32)
        self.length[list(pieces.values())] = list(map(len, pieces))

    def _fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each pair of tokens is compatible."""
        key = a * len(self.rank) + b
        slot = ((key * 0x9E3779B1) >> 12) & (SLOTS - 1)
        new = np.flatnonzero(self.key[slot] != key)
        if len(new):
            fresh, where = np.unique(key[new], return_index=True)
            verdict = self._compatible(a[new][where], b[new][where])
            out = self.verdict[slot]
            out[new] = verdict[np.searchsorted(fresh, key[new])]
            self.key[slot[new]], self.verdict[slot[new]] = key[new], out[new]
            return out
        return self.verdict[slot]

    def _compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.ones(len(a), bool)
        limit = np.full(len(a), len(self.rank) + 1, np.int64)
        open_ = np.arange(len(a))
        while len(open_):
            x, y = a[open_], b[open_]
            key = x * len(self.rank) + y
            place = np.minimum(np.searchsorted(self.joined, key), len(self.joined) - 1)
            merged = (self.joined[place] == key) & (self.joined_rank[place] < limit[open_])
            out[open_[merged]] = False
            left, right = self.inner[x, 0], self.inner[y, 1]
            go_on = ~merged & ((left >= 0) | (right >= 0))
            undo_left = (right < 0) | (left >= 0) & (self.rank[x] > self.rank[y])
            take = go_on & undo_left
            a[open_[take]], limit[open_[take]] = left[take], self.rank[x[take]]
            take = go_on & ~undo_left
            b[open_[take]], limit[open_[take]] = right[take], self.rank[y[take]] + 1
            open_ = open_[go_on]
        return out

    def encode(self, parts: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids as little-endian 32-bit numbers, their decoded bytes) of distinct parts
        over Latin letters, ASCII and the blank sign."""
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        n, most = len(parts), int(sizes.max())
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        codes = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
        columns = self.column[codes]
        last = np.full((most + 1, n), -1, np.int32)
        state = np.zeros(n, np.int32)
        rows = np.argsort(-sizes, kind="stable")  # long parts first: those still open are a prefix
        ordered, first = sizes[rows], starts[rows]
        for i in range(most):
            alive = int(np.searchsorted(-ordered, -i, "left"))
            state[:alive] = self.go[state[:alive], columns[first[:alive] + i]]
            at, row = state[:alive], np.arange(alive)
            while True:
                has = self.match[at] >= 0
                at, row = at[has], row[has]
                if not len(at):
                    break
                token = self.match[at]
                start = i + 1 - self.length[token]
                before = last[start, row]
                fits = before < 0
                tested = np.flatnonzero(~fits)
                if len(tested):
                    fits[tested] = self._fits(before[tested].astype(np.int64), token[tested].astype(np.int64))
                last[i + 1, row[fits]] = token[fits]
                at, row = self.shorter[at[~fits]], row[~fits]
                at, row = at[at > 0], row[at > 0]
        return self._recovered(parts, last, rows, ordered)

    def _recovered(self, parts: list[str], last: np.ndarray, rows: np.ndarray, ordered: np.ndarray) \
            -> list[tuple[bytes, bytes]]:
        """From the end of each part backwards."""
        n = len(parts)
        found: list[np.ndarray] = []  # (rows still open, their tokens), last tokens first
        at, row = ordered.copy(), np.arange(n)
        whole = np.ones(n, bool)
        steps = []
        while len(row):
            token = last[at, row]
            whole[row[token < 0]] = False
            steps.append((row, token))
            at = at - np.where(token < 0, 1, self.length[np.maximum(token, 0)])
            row, at = row[at > 0], at[at > 0]
        count = np.zeros(n, np.int64)
        for row, _ in steps:
            count[row] += 1
        end = np.cumsum(count)
        ids = np.zeros(int(end[-1]) if n else 0, np.int32)
        for k, (row, token) in enumerate(steps):
            ids[end[row] - 1 - k] = token
        packed, size = ids.astype("<i4").tobytes(), (4 * end).tolist()
        raw, out = self.encoder.raw, [(b"", b"")] * n
        begin = 0
        for k, (r, stop, plain) in enumerate(zip(rows.tolist(), size, whole.tolist(), strict=True)):
            if plain:
                out[r] = packed[begin:stop], b"".join(map(raw.__getitem__, ids[begin // 4:stop // 4].tolist()))
            else:  # a character without a piece: in bytes
                out[r] = self._alone(parts[r])
            begin = stop
        return out

    def _alone(self, part: str) -> tuple[bytes, bytes]:
        ids = self.encoder.word(part)
        return np.array(ids, "<i4").tobytes(), b"".join(map(self.encoder.raw.__getitem__, ids))

    def texts(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids, decoded bytes) of each text; the new parts of all are encoded together."""
        if len(self.seen) >= self.remember:
            self.seen, self.older = {}, self.seen
        cut = [self._cut(t) for t in texts]
        coded = [list(map(self.seen.get, parts)) for parts in cut]
        missing: dict[str, tuple[bytes, bytes] | None] = {}
        for parts, known in zip(cut, coded, strict=True):
            if None in known:
                missing.update((parts[i], self.older.get(parts[i])) for i, c in enumerate(known) if c is None)
        new = [p for p, known in missing.items() if known is None]
        together = [p for p in new if len(p) <= LONG and ord(max(p)) < len(self.column)]
        if together:
            missing.update(zip(together, self.encode(together), strict=True))
        for part in new:
            missing[part] = missing[part] or self._alone(part)
        self.seen.update((p, c) for p, c in missing.items() if len(p) <= LONG)
        out = []
        for parts, known in zip(cut, coded, strict=True):
            if None in known:
                known = [missing[p] if c is None else c for p, c in zip(parts, known, strict=True)]
            out.append((b"".join([c[0] for c in known]), b"".join([c[1] for c in known])))
        return out

    def _cut(self, text: str) -> list[str]:
        if not text:
            return []
        spelled = BLANK + text.replace(" ", BLANK)
        if self.encoder.cuts_at_signs and BLANK + BLANK not in spelled and PLAIN_TEXT.fullmatch(text):
            return PARTS.findall(spelled)
        return BEFORE_BLANK.split(spelled)


_LOADED: dict[str, PartTable] = {}


def loaded(path: str) -> PartTable:
    if path not in _LOADED:
        _LOADED[path] = PartTable(PrefixEncoder(path))
    return _LOADED[path]


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded) for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = loaded(path)
        for b in slices(batches, "text", 1 << 20):
            coded = table.texts([t or "" for t in b.column("text").to_pylist()])
            ids = np.frombuffer(b"".join([c[0] for c in coded]), "<i4")
            ends = np.cumsum([0, *[len(c[0]) // 4 for c in coded]])
            shown = [table.encoder.shown(raw, np.frombuffer(packed[:4], "<i4").tolist()) for packed, raw in coded]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
                 pa.array(shown, pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
