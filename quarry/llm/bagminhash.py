"""Near-duplicates by BagMinHash signatures of word-shingle multisets.

A text is the multiset of its sequences of ``SHINGLE`` words (all of its words,
if it has fewer). BagMinHash gives signatures whose slots agree with the
probability of the weighted Jaccard similarity: weights are cut at 1, 2, 4, 8
... into intervals; each shingle and interval has a Poisson process of points
(time, slot, position in the interval) drawn from their hash; a point counts
if its position lies below the weight; a slot takes its earliest point. Points
come in the order of time and stop at a time by which all slots are likely
filled (else it is doubled), so most shingles cost a single draw.

Signatures are cut into ``BANDS`` bands of ``ROWS`` slots; texts that agree in
a band are candidates, and a link is a pair whose exact multiset similarity is
``THRESHOLD`` or more. At that similarity a pair agrees in no band with a
probability of 3e-6. In buckets of up to ``SMALL`` members all pairs are
compared. In a larger one the member that meets most others in all its buckets
(the centre of a group of near copies) leads, and the others are compared with
it first. Links are joined to classes; then all pairs of a bucket that are not
of one class yet are compared, so every pair that shares a band is decided.

Most of those are told apart without their shingles: a text keeps, for each of
64 * ``BITS`` hash values, whether an odd number of its shingles has it. Two
texts differ in at least as many shingles as these bits differ; where that is
too many for the threshold, the pair can't be a link. What passes is verified.
Large buckets are dealt out in cells of two blocks of about ``BLOCK`` members.

Exact copies are one node from the start. Classes are found by alternating
large-star and small-star steps over tables in the shared folder.

Defined cases: a null text counts as empty; texts without words are alike only
if identical; a null ``doc_id`` is kept, and is the id of a class only if it has
no other; repeated rows are copies; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Rolling, content, mixed, pieces, stored, text_bytes, words_of
from .exact_dedup import rows_that_stay

SHINGLE = 5
BANDS = 24
ROWS = 4
THRESHOLD = (4, 5)  # similarity 4/5
#: In buckets of this size all pairs are compared at once: a constant times its members.
SMALL = 8
#: Words of 64 bits in the parity bits of a text.
BITS = 32
#: Members in a block of a large bucket, about.
BLOCK = 1024


def shingles(raw: np.ndarray, starts: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, count) of each distinct shingle, ordered by row."""
    s, e, row = words_of(raw, starts)
    if not len(s):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = Rolling(raw).of(s, e)
    first = np.searchsorted(row, np.arange(len(starts)))  # of each row's words
    n = np.diff(first)
    end = first[1:][row]
    h = np.zeros(len(word), np.uint64)
    for j in range(size):  # windows at the end of a row run out and are dropped, but for rows that are shorter
        at = np.arange(len(word)) + j
        have = at < end
        h = np.where(have, mixed(h + word[np.minimum(at, len(word) - 1)] + np.uint64(0x7F4A7C159E3779B9)), h)
    whole = (np.arange(len(word)) + size <= end) | ((n[row] < size) & (np.arange(len(word)) == first[:-1][row]))
    row, h = row[whole], h[whole]
    by = np.lexsort((h, row))
    row, h = row[by], h[by]
    new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])]))
    return row[new], h[new], np.diff(np.concatenate([new, [len(row)]]))


def _unit(h: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1]."""
    return ((h >> np.uint64(11)).astype(float) + 1) * 2.0 ** -53


def signatures(row: np.ndarray, shingle: np.ndarray, count: np.ndarray, rows: int, slots: int) -> np.ndarray:
    """The earliest point of each slot (rows x slots); rows without shingles stay at infinity."""
    out = np.full((rows, slots), np.inf)
    weight = np.bincount(row, count, rows)
    stop = (np.log(slots) + 2) / np.maximum(weight, 1)
    open_ = weight > 0
    levels = np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64) + 1  # intervals [0,1) [1,2) [2,4) ... below count
    of = np.repeat(np.arange(len(row)), levels)
    level = np.arange(len(of)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    width = np.where(level == 0, 1, low)
    covered = np.minimum((count[of] - low) / width, 1.0)
    seed = mixed(shingle[of] + level.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    of_row, width = row[of], width.astype(float)
    while open_.any():
        pick = np.flatnonzero(open_[of_row])
        out[open_] = np.inf
        time, step = np.zeros(len(pick)), 0
        while len(pick):
            step += 1
            h = mixed(seed[pick] + np.uint64((step * 0xD6E8FEB86659FD93) & (2**64 - 1)))
            time = time - np.log(_unit(h)) / (width[pick] * slots)
            go = time <= stop[of_row[pick]]
            pick, time, h = pick[go], time[go], mixed(h[go] ^ np.uint64(0xA0761D6478BD642F))
            slot = ((h >> np.uint64(32)) * np.uint64(slots)) >> np.uint64(32)
            below = _unit(mixed(h)) <= covered[pick]
            np.minimum.at(out, (of_row[pick][below], slot[below].astype(np.int64)), time[below])
        open_ &= np.isinf(out).any(axis=1)
        stop = np.where(open_, stop * 2, stop)
    return out


def band_keys(signature: np.ndarray, bands: int, size: int) -> np.ndarray:
    """(rows x bands) one 64-bit key per band."""
    bits = signature.view(np.uint64).reshape(len(signature), bands, size)
    h = np.broadcast_to(mixed(np.arange(1, bands + 1, dtype=np.uint64)), bits.shape[:2])
    for j in range(size):
        h = mixed(h ^ mixed(bits[:, :, j] + np.uint64(j + 1)))
    return h


def digest_of(text: Column) -> Column:
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def _rows(docs: DataFrame) -> DataFrame:
    text = content()
    return docs.select("doc_id", text.alias("text"), digest_of(text).alias("digest"))


def nodes_of(docs: DataFrame, bands: int = BANDS, size: int = ROWS) -> DataFrame:
    """One row per distinct text: node, digest, a document that has it, and its band keys."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text", 2 << 20):
            row, shingle, count = shingles(*text_bytes(part.column("text")))
            keys = band_keys(signatures(row, shingle, count, part.num_rows, bands * size), bands, size)
            total = np.bincount(row, count, part.num_rows).astype(np.int64)
            flat = pa.array(keys.view(np.int64).ravel())
            offsets = np.concatenate([[0], np.cumsum(np.where(total > 0, bands, 0))]).astype(np.int32)
            flat = flat.filter(pa.array(np.repeat(total > 0, bands)))
            yield pa.record_batch([part.column("digest"), part.column("doc_id").cast(pa.int64()),
                                   pa.ListArray.from_arrays(pa.array(offsets), flat), pa.array(total)],
                                  ["digest", "doc_id", "keys", "total"])

    signed = _rows(docs).select("digest", "doc_id", "text").mapInArrow(
        sign, "digest binary, doc_id long, keys array<long>, total long")
    distinct = signed.groupBy("digest").agg(F.min(F.struct("doc_id")).alias("one"), F.first("keys").alias("keys"),
                                            F.first("total").alias("total"))
    return stored(docs.sparkSession, distinct.select(F.monotonically_increasing_id().alias("node"), "digest",
                                                     F.col("one.doc_id").alias("one"), "keys", "total"), "nodes")


def members_of(nodes: DataFrame) -> DataFrame:
    """(key, node, total, n, pull) of the buckets with two members or more: n is the
    size of the bucket, pull how many members the node meets in all its buckets."""
    spark = nodes.sparkSession
    every = nodes.select(F.explode("keys").alias("key"), "node", "total")
    shared = every.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(spark, every.join(shared, "key"), "members")
    pull = members.groupBy("node").agg(F.sum(F.col("n") - 1).alias("pull"))
    return stored(spark, members.join(pull, "node"), "members")


def parity_bits(row: np.ndarray, values: np.ndarray, rows: int, words: int = BITS) -> np.ndarray:
    """(rows x words) 64 bits each: whether an odd number of the row's values falls on the bit."""
    out = np.zeros((rows, words), np.uint64)
    h = mixed(values ^ np.uint64(0x8EBC6AF09C88C6E3))
    word = ((h >> np.uint64(32)) * np.uint64(words)) >> np.uint64(32)
    np.bitwise_xor.at(out, (row, word.astype(np.int64)), np.uint64(1) << (h & np.uint64(63)))
    return out


def elements_of(docs: DataFrame, nodes: DataFrame, members: DataFrame) -> DataFrame:
    """(node, elements, bits) of the candidates: a sorted hash for each shingle and each of its
    occurrences, and the parity bits of these."""
    wanted = (nodes.join(members.select("node").distinct(), "node", "left_semi")
              .select("node", F.col("digest").alias("d"), F.col("one")))
    rows = _rows(docs)
    texts = rows.join(wanted, (F.col("digest") == F.col("d")) & F.col("doc_id").eqNullSafe(F.col("one")))

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text", 2 << 20):
            row, shingle, count = shingles(*text_bytes(part.column("text")))
            of = np.repeat(np.arange(len(row)), count)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            values = np.where(nth == 0, shingle[of], mixed(shingle[of] + nth.astype(np.uint64)))
            offsets = np.searchsorted(row[of], np.arange(part.num_rows + 1)).astype(np.int32)
            bits = parity_bits(row[of], values, part.num_rows)
            yield pa.record_batch([part.column("node"), pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(values.view(np.int64))), pa.ListArray.from_arrays(
                pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * BITS), pa.array(bits.view(np.int64).ravel()))],
                ["node", "elements", "bits"])

    found = texts.select("node", "text").mapInArrow(elements, "node long, elements array<long>, bits array<long>")
    return stored(docs.sparkSession, found.dropDuplicates(["node"]), "elements")


def verified(pairs: DataFrame, elements: DataFrame, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """The ``pairs`` (a, b) whose multiset similarity reaches the threshold, with the similarity."""
    p, q = threshold
    left = elements.select(F.col("node").alias("a"), F.col("elements").alias("ea"))
    right = elements.select(F.col("node").alias("b"), F.col("elements").alias("eb"))
    both = (pairs.join(right, "b").join(left, "a")
            .select("a", "b", F.size("ea").cast("long").alias("na"), F.size("eb").cast("long").alias("nb"),
                    F.size(F.array_intersect("ea", "eb")).cast("long").alias("common")))
    union = F.col("na") + F.col("nb") - F.col("common")
    return (both.where(q * F.col("common") >= p * union)
            .select("a", "b", (F.col("common") / union).alias("similarity")))


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node of ``edges`` (a, b) is either a centre, or the end of one edge."""
    ends = (edges.select(F.col("b").alias("node"), F.lit(1).alias("ends"), F.lit(0).alias("centre"))
            .unionByName(edges.select(F.col("a").alias("node"), F.lit(0).alias("ends"), F.lit(1).alias("centre"))))
    by_node = ends.groupBy("node").agg(F.sum("ends").alias("ends"), F.max("centre").alias("centre"))
    return by_node.where("ends > 1 OR (ends = 1 AND centre = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the undirected ``edges`` (a, b): label is the
    least node of its component."""
    spark = edges.sparkSession
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now = stored(spark, edges.where("a <> b").select(low.alias("a"), high.alias("b")).distinct(), "edges")
    while not _is_stars(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: larger neighbours to the least one
        star = now.join(least, "a").select(F.col("m").alias("a"), F.col("b"))
        # small star: smaller neighbours, and the node itself, to the least of them
        down = star.groupBy("b").agg(F.min("a").alias("m"))
        moved = star.join(down, "b").select(F.col("m").alias("a"), F.col("a").alias("b"))
        own = down.select(F.col("m").alias("a"), "b")
        now = stored(spark, moved.unionByName(own).where("a <> b").distinct(), "edges")
    centres = now.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct()
    return now.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(centres)


def _leaders(members: DataFrame) -> DataFrame:
    """The member of each bucket that meets most others."""
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("pull"), "node"))
    return members.withColumn("rank", rank).where("rank = 1").drop("rank")


def _compared(members: DataFrame, leading: DataFrame, elements: DataFrame) -> DataFrame:
    """Links between the members of each bucket and its leaders, of other classes than theirs."""
    p, q = THRESHOLD
    lead = leading.select("key", F.col("node").alias("lead"), F.col("label").alias("lead_label"),
                          F.col("total").alias("lead_total"))
    # a pair of too different sizes can't reach the threshold
    alike = q * F.least("total", "lead_total") >= p * F.greatest("total", "lead_total")
    pairs = (members.join(lead, "key").where(F.col("label") != F.col("lead_label")).where(alike)
             .select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct())
    return stored(members.sparkSession, verified(pairs, elements), "links")


def _possible(members: DataFrame, elements: DataFrame) -> DataFrame:
    """The pairs (a, b) of the buckets that have different labels and may reach the
    threshold by their sizes and parity bits."""
    p, q = THRESHOLD
    blocks = F.ceil(F.col("n") / BLOCK)
    cut = stored(members.sparkSession, members.join(elements.select("node", "bits"), "node").select(
        "key", "node", "label", "total", "bits", (blocks - 1).alias("last"),
        F.pmod(F.xxhash64("node"), blocks).alias("block")), "open")
    # each block meets itself and every other one in a cell (i, j) of its own
    left = cut.select("key", F.col("block").alias("i"), F.explode(F.sequence("block", "last")).alias("j"),
                      F.col("node").alias("a"), F.col("label").alias("la"), F.col("total").alias("ta"),
                      F.col("bits").alias("ba"))
    right = cut.select("key", F.explode(F.sequence(F.lit(0).cast("long"), "block")).alias("i"),
                       F.col("block").alias("j"), F.col("node").alias("b"), F.col("label").alias("lb"),
                       F.col("total").alias("tb"), F.col("bits").alias("bb"))
    once = (F.col("i") < F.col("j")) | (F.col("a") < F.col("b"))
    alike = q * F.least("ta", "tb") >= p * F.greatest("ta", "tb")
    differ = reduce(Column.__add__, [F.bit_count(F.get("ba", F.lit(k)).bitwiseXOR(F.get("bb", F.lit(k))))
                                     for k in range(BITS)])
    near = (q + p) * differ <= (q - p) * (F.col("ta") + F.col("tb"))
    pairs = left.join(right, ["key", "i", "j"]).where(once & (F.col("la") != F.col("lb")) & alike & near)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def link(members: DataFrame, elements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links, labels): verified pairs, and (node, label) of the nodes that have any."""
    spark = members.sparkSession
    start = members.withColumn("label", F.col("node"))
    small, large = start.where(F.col("n") <= SMALL), start.where(F.col("n") > SMALL)
    hubs = stored(spark, _leaders(large), "hubs")
    links = _compared(small, small, elements).unionByName(_compared(large, hubs, elements)).distinct()
    labels = stored(spark, components(links.select("a", "b")), "labels")
    # pairs with the hub are compared, pairs of one class have nothing to gain from it
    rest = (large.drop("label").join(hubs.select("key", F.col("node").alias("hub")), "key").where("node <> hub")
            .join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    open_keys = (rest.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
                 .where("lo <> hi").select("key"))
    found = stored(spark, verified(_possible(rest.join(open_keys, "key", "left_semi"), elements), elements), "links")
    if found.isEmpty():
        return links, labels
    joined = labels.select(F.col("label").alias("a"), F.col("node").alias("b")).unionByName(found.select("a", "b"))
    return links.unionByName(found), stored(spark, components(joined), "labels")


def near_duplicates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(classes, links). classes: doc_id, digest, node, label, class_id (the least
    doc_id of the class), class_size, kept (the row that stays of the class);
    links: verified pairs of nodes with their similarity."""
    nodes = nodes_of(docs)
    members = members_of(nodes)
    links, labels = link(members, elements_of(docs, nodes, members))
    named = (nodes.select("node", "digest").join(labels, "node", "left")
             .select("node", "digest", F.coalesce("label", "node").alias("label")))
    rows = _rows(docs).select("doc_id", "digest").join(named, "digest")
    rows = stored(docs.sparkSession, rows, "classes")
    classes = rows.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"),
                                        F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "digest"))
                                        .alias("first"))
    out = rows.join(classes, "label")
    kept: Column = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("digest") == F.col("first.digest"))
    return out.select("doc_id", "digest", "node", "label", "class_id", "class_size", kept.alias("kept")), links


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one per class, with all their columns."""
    classes, _ = near_duplicates(docs)
    return rows_that_stay(docs, classes.where("kept"), digest_of)
