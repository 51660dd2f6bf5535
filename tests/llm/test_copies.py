"""Exact, near and substring duplicates against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import anchored, bagminhash, common, exact_dedup, phrase_automata, suffix_dedup


def rows_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


# --- exact -------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 60_000])
def test_fuse_filter(n):
    r = np.random.default_rng(n)
    keys = np.unique(r.integers(0, 2**63, n, dtype=np.uint64))
    built = exact_dedup.build_filter(keys)
    assert exact_dedup.probe_filter(keys, *built).all()
    others = r.integers(2**63, 2**64 - 1, 200_000, dtype=np.uint64)
    assert exact_dedup.probe_filter(others, *built).mean() < 1e-3


def want_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    out = Counter()
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        kept = False
        for i in sorted(ids, key=lambda i: (i is not None, i), reverse=True):
            first = i == keep and not kept
            kept |= first
            out[(i, keep, len(ids), first)] += 1
    return out


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(odd, documents, weak):
    digest = (lambda t: F.substring(F.sha2(t, 256), 1, 1)) if weak else exact_dedup.digest_of
    for docs in (odd, documents):
        got = exact_dedup.dedup(exact_dedup.arrivals(docs), digest, shard_rows=20).collect()
        assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got) == want_exact(rows_of(docs))


def test_three_batches(documents):
    parts = [documents.where(F.col("doc_id") % 3 == k) for k in range(3)]
    got = exact_dedup.dedup(parts, shard_rows=30).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got) == want_exact(rows_of(documents))


def test_the_filters_decide(documents, monkeypatch):
    """Filters that reject every digest leave copies across batches apart; ones that
    let every digest through change nothing, as the buckets decide then."""
    want = want_exact(rows_of(documents))

    def groups():
        got = exact_dedup.dedup(exact_dedup.arrivals(documents), shard_rows=20).collect()
        return Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got)

    monkeypatch.setattr(exact_dedup, "probe_filter", lambda keys, *_: keys == keys)
    assert groups() == want
    monkeypatch.setattr(exact_dedup, "probe_filter", lambda keys, *_: keys != keys)
    assert groups() != want


def test_exact_kept_rows(odd, empty):
    kept = exact_dedup.kept_rows(odd)
    assert kept.columns == odd.columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert sorted(texts) == sorted({t for _, t in rows_of(odd)})
    assert exact_dedup.dedup(exact_dedup.arrivals(empty)).count() == 0


# --- near --------------------------------------------------------------------------------


def multiset(text):
    w = text.encode().split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def near_classes(rows):
    texts = sorted({t for _, t in rows})
    bags = [multiset(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(bags):
        for j in range(i):
            common = sum((a & bags[j]).values())
            if common and 5 * common >= 4 * (sum(a.values()) + sum(bags[j].values()) - common):
                parent[find(i)] = find(j)
    out = defaultdict(list)
    for d, t in rows:
        out[find(texts.index(t))].append(d)
    return Counter(tuple(sorted(ids, key=str)) for ids in out.values())


def test_signatures_estimate_weighted_jaccard():
    a, b = {x: 1 + x % 7 for x in range(300)}, {x: 1 + x % 5 for x in range(60, 330)}
    exact = sum(min(a[x], b[x]) for x in a.keys() & b) / sum(max(a.get(x, 0), b.get(x, 0)) for x in a.keys() | b)
    row = np.repeat([0, 1], [len(a), len(b)])
    key = bagminhash.mixed(np.array([*a, *b], np.uint64))
    sig = bagminhash.signatures(row, key, np.array([*a.values(), *b.values()]), 2, 4096)
    assert abs((sig[0] == sig[1]).mean() - exact) < 0.03


def test_near_duplicates(odd, documents, empty):
    for docs in (odd, documents):
        classes, _ = bagminhash.near_duplicates(docs)
        found = defaultdict(list)
        for r in classes.collect():
            found[r["label"]].append(r["doc_id"])
        assert Counter(tuple(sorted(ids, key=str)) for ids in found.values()) == near_classes(rows_of(docs))
    assert bagminhash.near_duplicates(empty)[0].count() == 0


def test_near_kept_rows(odd):
    kept = bagminhash.kept_rows(odd)
    assert kept.columns == odd.columns
    assert kept.count() == sum(near_classes(rows_of(odd)).values())


def test_chain_of_near_copies_is_one_class(spark):
    """Ends of the chain are below the threshold, and no member is like all others."""
    words = [f"x{i}" for i in range(400)]
    rows = []
    for k in range(12):
        rows.append((k, " ".join(words)))
        words = [*words[:30 * k], *[f"y{k}_{i}" for i in range(18)], *words[30 * k + 18:]]
    rows += [(100 + k, " ".join(f"z{k}_{i}" for i in range(50))) for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in bagminhash.near_duplicates(docs)[0].collect()}
    want = near_classes(rows)
    assert {got[k] for k in range(12)} == {0} and sum(want.values()) == 6
    assert all(got[100 + k] == 100 + k for k in range(5))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = {r["node"]: r["label"] for r in
           bagminhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


# --- substrings --------------------------------------------------------------------------


def cut_bytes(rows, window):
    raws = [t.encode() for _, t in rows]
    seen = Counter()
    for b in raws:
        seen.update(b[i:i + window] for i in range(len(b) - window + 1))
    out = Counter()
    for (d, _), b in zip(rows, raws, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if seen[b[i:i + window]] > 1:
                gone[i:i + window] = b"\1" * window
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[(d, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())] += 1
    return out


@pytest.mark.parametrize("window,gram,hot", [(200, 32, 500), (200, 32, 0), (50, 9, 500), (50, 9, 1)])
def test_suffix_dedup(odd, documents, window, gram, hot):
    for docs in (odd, documents) if window == 200 else (odd,):
        rows = [(d, t) for d, t in rows_of(docs) if len(t) < 50_000]
        part = docs.where(F.coalesce(F.length("text"), F.lit(0)) < 50_000)
        got = suffix_dedup.deduplicated(part, window, gram, hot).collect()
        assert Counter((r["c0"], r["n_bytes"], r["n_removed"], len(r["spans"]) // 2,
                        hashlib.sha256(r["kept"]).hexdigest()) for r in got) == cut_bytes(rows, window)


def test_suffix_dedup_carries_all_columns(odd, empty):
    out = suffix_dedup.deduplicated(odd)
    assert out.columns[:len(odd.columns)] == [f"c{i}" for i in range(len(odd.columns))]
    assert out.count() == odd.count()
    assert suffix_dedup.deduplicated(empty).count() == 0


def cut_words(rows, window):
    """rows in order: the first occurrence stays."""
    seen, out = set(), Counter()
    for d, t in rows:
        w = t.encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            if key in seen:
                gone[i:i + window] = [True] * window
            seen.add(key)
        out[(d, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())] += 1
    return out


@pytest.mark.parametrize("window,gram,hot", [(20, 8, 500), (20, 8, 0), (6, 3, 500)])
def test_phrase_automata(spark, odd, documents, empty, window, gram, hot):
    odd_ordered = sorted(rows_of(odd.dropDuplicates(["doc_id"])), key=lambda r: (r[0] is not None, r[0] or 0))
    unique = spark.createDataFrame(odd_ordered, "doc_id long, text string").repartition(3)
    for docs, rows in ((unique, odd_ordered), (documents, sorted(rows_of(documents)))):
        got = phrase_automata.deduplicated(docs, window, gram, hot).collect()
        assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got) == cut_words(rows, window)
    # rows that share an id: of equal texts exactly one keeps its words
    got = [r for r in phrase_automata.deduplicated(odd, window, gram, hot).collect() if r["n_words"] == 400]
    assert sorted(r["n_removed"] for r in got) == [0, 400, 400]
    assert phrase_automata.deduplicated(empty).count() == 0


def alike_words():
    """Two words that agree in the upper halves of their hashes."""
    words = [f"id{k}" for k in range(400_000)]
    raw = "".join(words).encode()
    end = np.cumsum([len(w) for w in words])
    value = common.Rolling(np.frombuffer(raw, np.uint8)).of(np.concatenate([[0], end[:-1]]), end) >> np.uint64(32)
    order = np.argsort(value, kind="stable")
    k = int(np.flatnonzero(value[order][1:] == value[order][:-1])[0])
    return words[order[k]], words[order[k + 1]]


@pytest.mark.parametrize("hot", [0, 500])
def test_windows_that_differ_in_one_word_stay(spark, hot):
    a, b = alike_words()
    frame = [f"word{k}" for k in range(19)]
    rows = [(1, " ".join([*frame[:9], a, *frame[9:]])), (2, " ".join([*frame[:9], b, *frame[9:]])),
            (3, " ".join(frame + ["x"])), (4, " ".join(frame + ["x"]))]
    got = phrase_automata.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), hot=hot).collect()
    assert {r["doc_id"]: r["n_removed"] for r in got} == {1: 0, 2: 0, 3: 0, 4: 20}


def shard_of(texts, window):
    """A shard as it would be received, one stretch for each text."""
    raw, starts = common.text_bytes(pa.array(texts))
    value, _, at = phrase_automata._words(raw, starts)
    meta = np.zeros(len(texts), anchored.META)
    meta["stretch"] = [hash(t) & (1 << 63) - 1 for t in texts]
    meta["symbols"] = np.diff(at)
    meta["windows"] = meta["symbols"] - window + 1
    meta["copies"], meta["order"] = 1, range(len(texts))
    return anchored.Shard(meta, np.arange(len(texts)), value, at[:-1], np.zeros(0, anchored.SINGLE), np.zeros(0, np.int64))


def test_automata_decide(monkeypatch):
    """Occurrences come from the automata alone; colliding hashes change nothing."""
    kind = anchored.Kind(4, 2, phrase_automata._words)
    texts = ["a b c d e f g", "x b c d e y", "b c d e f", "p q r s t", "p q r s t u", "z q r s t"]
    honest = phrase_automata.answer_shard(kind, shard_of(texts, 4))
    assert honest
    monkeypatch.setattr(phrase_automata, "_sequence_hashes", lambda symbols, at, window: np.zeros(len(at), np.uint64))
    blind = phrase_automata.answer_shard(kind, shard_of(texts, 4))
    unpacked = lambda rows: Counter((c, int(r["stretch"]), int(r["k"]) + j, int(r["state"])) for c, _, blob in rows
                                    for r in np.frombuffer(blob, anchored.RUN) for j in range(int(r["length"])))
    assert unpacked(blind) == unpacked(honest)
    monkeypatch.setattr(phrase_automata, "locate", lambda *_: (np.zeros(0, np.int64),) * 3)
    assert phrase_automata.answer_shard(kind, shard_of(texts, 4)) == []
