"""Token counts, SentencePiece and packing against the libraries themselves."""

import random
import struct
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.llm import packing, sentencepiece_prefix, token_counts
from quarry.llm.bpe import WordIds
from quarry.llm.queries import tokenizer
from quarry.session import fresh_dir

TRICKY = ["a  b   c \n\n d", "<|endoftext|>", "a <|endoftext|> b <|startoftext|>x", "don't 's  's 'S I'LL", "  lead",
          "trail  ", " x 　y\x1cz", "naïve é ́x İI ſ", "日本語 123 ²³ ½ 😀", "a\x00b", "t\ts\r\nx\x0by\x0cz\x85w", " ",
          "\n", "", "I'm''s x's", "▁a▁▁b", "<s>x</s> <unk> <0x0A>", "    " * 40, "=" * 300, "ha" * 50, "ﬁ ＡＢＣ"]


def texts_of(df):
    return [r["text"] or "" for r in df.select("text").collect()]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_word_ids_equal_the_library(documents, odd, name):
    from tokenizers import Tokenizer

    words, library = WordIds(tokenizer(name), remember=5000), Tokenizer.from_file(tokenizer(name))
    for text in TRICKY + texts_of(documents) + texts_of(odd):
        ids = words.ids(text)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == library.encode(text, add_special_tokens=False).ids


def test_sentencepiece_equals_the_library(documents, odd):
    import sentencepiece

    own = sentencepiece_prefix.PrefixEncoder(tokenizer("piece_bpe_32k.model"))
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    r = random.Random(1)
    letters = "abcdefgh the ing er on  \n▁=-éß日x01"
    fuzz = ["".join(r.choice(letters) for _ in range(r.randint(1, 40))) for _ in range(2000)]
    for text in TRICKY + fuzz + texts_of(documents) + texts_of(odd):
        ids = library.encode(text)
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids)
    broken = [own.byte_id[x] for x in (0xE6, 0x97, 0x41, 0xFF)]
    assert own.decode(broken) == library.decode(broken)


def test_parts_encoded_together_equal_the_library(documents, odd):
    """Also with a memory that overruns, parts too long for the table and characters outside it."""
    import sentencepiece

    path = tokenizer("piece_bpe_32k.model")
    table = sentencepiece_prefix.PartTable(sentencepiece_prefix.PrefixEncoder(path), remember=500)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    assert table.encoder.cuts_at_signs
    r = random.Random(2)
    bits = ["a", "B", " ", "  ", "\n", "é", "ß", "ał", "12", "!", "...", "\x1c", "😀", "▁", "ing", "the ", "tion", "×", "q" * 60]
    fuzz = ["".join(r.choice(bits) for _ in range(r.randrange(25))) for _ in range(1500)]
    texts = TRICKY + fuzz + texts_of(documents) + texts_of(odd)
    for at in range(0, len(texts), 97):
        for text, (packed, raw) in zip(texts[at:at + 97], table.texts(texts[at:at + 97])):
            ids = list(struct.unpack(f"<{len(packed) // 4}i", packed))
            assert ids == library.encode(text)
            assert table.encoder.shown(raw, ids[:1]) == library.decode(ids)


def test_encode_decode_keeps_every_row(odd, empty):
    out = sentencepiece_prefix.encode_decode(odd, tokenizer("piece_bpe_32k.model")).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r["doc_id"] for r in odd.collect())
    assert all(r["ids"] == [] and r["decoded"] == "" for r in out if r["doc_id"] in (5, 6, 8))
    assert sentencepiece_prefix.encode_decode(empty, tokenizer("piece_bpe_32k.model")).count() == 0


def test_counts_and_cache(spark, odd, empty):
    from tokenizers import Tokenizer

    path, library = tokenizer("byte_bpe_50k.json"), Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    cache = fresh_dir(spark, "cache")
    want = Counter((r["doc_id"], len((r["text"] or "").encode()),
                    len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in odd.collect())
    for _ in range(2):
        got = token_counts.count_tokens(odd, path, cache).collect()
        assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == want
    stored = spark.read.parquet(cache)
    distinct = len({r["text"] or "" for r in odd.collect()})
    assert stored.count() == distinct  # each text encoded once, in two calls
    more = odd.select("doc_id", "text").unionByName(spark.createDataFrame([(99, "new text")], "doc_id long, text string"))
    cached = stored.where(F.col("tokenizer_digest").isNotNull()).select("content_digest")
    assert token_counts.misses(more, cached).count() == 1
    assert token_counts.count_tokens(empty, path, cache).count() == 0


def check_packing(docs, rows, limits):
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append(r)
        by_doc[(r["doc_id"], r["doc_tokens"])].append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= limits[0] and at & (at - 1) == 0  # full, or a power of two: no padding
        assert len(pieces) <= limits[1] and sum(r["loss_tokens"] for r in pieces) <= limits[2]
    return by_doc


@pytest.mark.parametrize("limits", [packing.LIMITS, (4096, 256, 4096), (256, 3, 256), (256, 64, 100)])
def test_packing(odd, empty, limits):
    from tokenizers import Tokenizer

    path = tokenizer("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = packing.pack(odd, packing.bpe_with_end(path, 2), limits).collect()
    check_packing(odd, rows, limits)
    want = Counter()
    for r in odd.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        want.update((r["doc_id"], len(ids), at, i) for at, i in enumerate(ids))
    got = Counter()
    for r in rows:
        ids = struct.unpack(f"<{r['length']}I", r["ids"])
        got.update((r["doc_id"], r["doc_tokens"], r["start"] + at, i) for at, i in enumerate(ids))
    assert got == want
    assert packing.pack(empty, packing.bpe_with_end(path, 2)).count() == 0


@pytest.mark.parametrize("binding, sizes", [
    (0, [400 + i % 7 for i in range(300)]),
    (1, [1 + i % 3 for i in range(4000)]),
    (2, [1 + (i * 7919) % 97 ** (1 + i % 2) for i in range(4000)])])
def test_every_limit_binds(binding, sizes):
    """With the limits of the query, no sequence exceeds any, each stops some, and nothing is lost."""
    packer, full = packing.Packer(packing.LIMITS), defaultdict(lambda: [0, 0, 0])
    settled = [p for i, n in enumerate(sizes) for p in packer.add((i, n, packing.prompt_of(n)))] + list(packer.end())
    for _, _, length, sequence, _, loss in settled:
        full[sequence] = [a + b for a, b in zip(full[sequence], (length, 1, loss), strict=True)]
    assert all(a <= b for need in full.values() for a, b in zip(need, packing.LIMITS, strict=True))
    assert sum(need[0] for need in full.values()) == sum(sizes)
    assert any(need[binding] == packing.LIMITS[binding] for need in full.values())


def test_packing_prefers_what_balances():
    """Of two that fit, the one whose demand points along the room left."""
    packer = packing.Packer((8, 4, 4))
    for name, n, prompt in (("loss", 6, 2), ("plain", 6, 6)):
        list(packer.add((name, n, prompt)))
    first = next(iter(packer.end()))
    assert first[0][0] == "loss"
    assert zlib.crc32(b"") == 0
