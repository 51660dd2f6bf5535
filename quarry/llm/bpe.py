"""Token ids of whole texts as the ``tokenizers`` library gives them, at the
cost of the parts not met before.

The library's pre-tokenizer cuts a text into parts and encodes each for itself.
A text of plain letters, digits, punctuation and white space is cut here by the
same pattern, and each distinct part encoded once per worker process, by the
merges of the vocabulary file. Anything else goes through the library's whole
``encode``: word by word, where cutting at blanks is safe.

The merges run in ``tiktoken``: its vocabulary maps spellings to ranks, and the
ids of a BPE file are in merge order, so an id is a rank. An end-of-word suffix
becomes a byte that UTF-8 never has. A file whose ids are not in merge order
is left to the library.
"""

from __future__ import annotations

import json
import os
import re
import struct

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Printable ASCII and Latin-1 letters: stable under NFC, and each one's class is plain.
LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN = re.compile(f"[!-~{LETTER}]+")
PLAIN_TEXT = re.compile(f"[\t-\r -~{LETTER}]*")
# The pre-tokenizers' patterns, over plain characters.
PREFIXED = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[0-9]+| ?[^\\s{LETTER}0-9]+|\\s+(?!\\S)|\\s+")
LOWERED = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[0-9]|[^\\s{LETTER}0-9]+")
AT_BLANK = re.compile(r"(?<=\S)(?= \S)")
#: Parts a process remembers in each of two generations: a full one becomes
#: the older, and a part found there moves on, so common parts are never lost.
REMEMBER = 250_000
#: Longer parts go to the library and are not remembered.
LONG = 200
END = b"\xff"


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 bytes stand for themselves, the others follow from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


def merge_ranks(model: dict) -> dict[bytes, int] | None:
    """Spelling to id of a BPE vocabulary whose ids are in merge order, None of any other."""
    suffix = model.get("end_of_word_suffix") or ""
    if model.get("type") != "BPE" or model.get("continuing_subword_prefix") or model.get("dropout") \
            or model.get("unk_token") or model.get("ignore_merges"):
        return None
    value = {c: bytes([b]) for b, c in enumerate(byte_letters())}

    def spelled(token: str) -> bytes:
        body = token.removesuffix(suffix) if suffix else token
        return b"".join(value[c] for c in body) + (END if body != token else b"")

    vocab, last = model["vocab"], -1
    out = {}
    for merge in model["merges"]:
        a, b = merge if isinstance(merge, list) else merge.split(" ")
        rank = vocab[a + b]
        if rank <= last or rank < max(vocab[a], vocab[b]) or spelled(a + b) in out:
            return None
        out[spelled(a + b)] = last = rank
    first = min(out.values(), default=0)
    for letter, byte in value.items():
        for token in {letter, letter + suffix}:
            if not (byte == END and token != letter) and vocab.get(token, first) >= first:
                return None
            out[byte + (END if token != letter else b"")] = vocab[token]
    return out


class WordIds:
    """Ids of whole texts for one tokenizer file."""

    def __init__(self, path: str, remember: int = REMEMBER):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.remember = remember
        self.seen: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        pre = spec.get("pre_tokenizer") or {}
        norm = spec.get("normalizer") or {}
        ranks = merge_ranks(spec["model"])
        #: "prefixed": a blank belongs to the part after it; "lowered": white space is dropped.
        if ranks is None:
            self.kind = "whole"
        elif pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not norm:
            self.kind = "prefixed"
        elif [x.get("type") for x in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"] \
                and [x.get("type") for x in pre.get("pretokenizers", [])] == ["Split", "ByteLevel"]:
            self.kind = "lowered"
        else:
            self.kind = "whole"
        self.special = [t["content"][:2] for t in spec.get("added_tokens", [])]
        if self.kind != "whole":
            self.tail = END if spec["model"].get("end_of_word_suffix") else b""
            spare = max(ranks.values()) + 1  # the marker alone: never what is left of a part
            self.merged = tiktoken.Encoding(os.path.basename(path), pat_str=r"[\s\S]+", special_tokens={},
                                            mergeable_ranks={END: spare} | ranks)._encode_single_piece
            self.pattern = PREFIXED if self.kind == "prefixed" else LOWERED

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _part(self, part: str) -> bytes:
        found = self.seen.get(part)
        if found is None:
            found = self.older.get(part)
            if found is None:
                if len(part) > LONG:  # the library's merges take less than the square of its length
                    return self._whole(part)
                ids = self.merged(part.encode() + self.tail)
                found = struct.pack(f"<{len(ids)}I", *ids)
            self.seen[part] = found
        return found

    def _plain(self, text: str) -> bytes:
        if len(self.seen) >= self.remember:
            self.seen, self.older = {}, self.seen
        parts = self.pattern.findall(text.lower() if self.kind == "lowered" else text)
        found = list(map(self.seen.get, parts))
        if None in found:
            for i in [i for i, ids in enumerate(found) if ids is None]:
                found[i] = self._part(parts[i])
        return b"".join(found)

    def _is_plain(self, pattern: re.Pattern, text: str) -> bool:
        return pattern.fullmatch(text) is not None and not any(s in text for s in self.special)

    def _word(self, word: str) -> bytes:
        """What stands between two cuts; "prefixed": with its blank, if any."""
        bare = word[1:] if word[:1] == " " else word
        return self._plain(word) if self._is_plain(PLAIN, bare) else self._whole(word)

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if self.kind == "whole":
            return self._whole(text)
        if self._is_plain(PLAIN_TEXT, text):
            return self._plain(text)
        if self.kind == "lowered":  # cut at ASCII white space; the library decides on any other
            return b"".join(self._word(w.decode()) for w in text.encode().split())
        return b"".join(map(self._word, AT_BLANK.split(text)))


_LOADED: dict[str, WordIds] = {}


def loaded(path: str) -> WordIds:
    """One instance per process and file; workers that Spark reuses keep it."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]
