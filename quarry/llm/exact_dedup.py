"""Exact dedup of arriving batches against immutable snapshots.

A snapshot holds the distinct texts that a batch brought: *exact buckets*
(shard, digest, text) and one static binary-fuse filter per shard over the
digests, both written once and never changed. Of an arriving batch, digests
are grouped among themselves first; each distinct one is then screened by the
filter of its shard, snapshot by snapshot. What a filter rejects is new to that
snapshot for certain, and is looked for no further there; what it lets through
(true copies, and about 2**-16 of the others) joins the exact buckets, and those
found there extend the group of that snapshot. The others start groups of their
own. Texts under one digest are then compared byte by byte, within the batch
and against the buckets; should two differ, their rows are grouped by text
instead.

Defined cases: a null text counts as empty; nothing else is normalised. Of
equal texts the row with the largest ``doc_id`` stays (null sorts lowest); if
that very row is repeated, one of the repeats stays. Empty tables give empty
results; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import content, mixed, stored

#: Digests in one filter, at most about this many; a shard is built and probed in one task.
SHARD_ROWS = 1 << 16


# --- static binary-fuse filter (three-wise, 16-bit fingerprints) ---------------------------


def _slots(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The three slots of each key, in three neighbouring segments, and its fingerprint."""
    h = mixed(keys + np.uint64(seed))
    first = ((h >> np.uint64(32)) * np.uint64(segments * segment)) >> np.uint64(32)
    mask = np.uint64(segment - 1)
    second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * segment)) ^ (h & mask)
    return np.stack([first, second, third]).astype(np.int64), (h ^ (h >> np.uint64(32))).astype(np.uint16)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segments, fingerprints) for distinct 64-bit keys:
    slots with a single key left are peeled off round by round; walking back,
    each key's own slot is set so that its three slots xor to its fingerprint."""
    n = max(len(keys), 2)
    segment = 1 << max(2, min(18, int(np.floor(np.log(n) / np.log(3.33) + 2.25))))
    room = int(n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(n)))
    segments = max(1, -(-room // segment) - 2)
    for seed in range(1, 1000):
        at, prints = _slots(keys, seed * 0x9E3779B9, segment, segments)
        held = np.zeros((segments + 2) * segment, np.int64)
        total = np.zeros_like(held)  # of the numbers of the keys in the slot
        number = np.arange(len(keys))
        for row in at:
            np.add.at(held, row, 1)
            np.add.at(total, row, number)
        peeled, edge = [], np.flatnonzero(held == 1)
        while len(edge):
            key, where = np.unique(total[edge], return_index=True)
            peeled.append((key, edge[where]))
            gone = at[:, key]
            np.subtract.at(held, gone, 1)
            np.subtract.at(total, gone, np.broadcast_to(key, gone.shape))
            edge = np.unique(gone)
            edge = edge[held[edge] == 1]
        if sum(len(key) for key, _ in peeled) == len(keys):
            table = np.zeros(len(held), np.uint16)
            for key, own in reversed(peeled):
                a, b, c = at[:, key]
                table[own] = prints[key] ^ table[a] ^ table[b] ^ table[c]
            return seed * 0x9E3779B9, segment, segments, table.tobytes()
    raise ValueError("no seed peels these keys; are they distinct?")


def probe_filter(keys: np.ndarray, seed: int, segment: int, segments: int, table: bytes) -> np.ndarray:
    """True for every key the filter was built from, and for about 2**-16 of all others."""
    at, prints = _slots(keys, seed, segment, segments)
    t = np.frombuffer(table, np.uint16)
    return (t[at[0]] ^ t[at[1]] ^ t[at[2]]) == prints


# --- rows, groups, snapshots ---------------------------------------------------------------


def digest_of(text: Column) -> Column:
    return F.sha2(text, 256)


def rows_of(docs: DataFrame, digest=digest_of) -> DataFrame:
    text = content()
    return docs.select("doc_id", text.alias("text"), digest(text).alias("digest"))


def pairs_of(rows: DataFrame) -> DataFrame:
    """One row per (digest, doc_id) with the number of its repeats."""
    return rows.groupBy("digest", "doc_id").agg(F.count("*").alias("repeats"))


def groups_of(pairs: DataFrame, *more: str) -> DataFrame:
    """One row per digest: the row that stays and how many rows there are."""
    return pairs.groupBy("digest", *more).agg(F.max("doc_id").alias("keep_id"), F.sum("repeats").alias("group_size"))


def shard_of(n: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(n)).cast("int")


class Snapshot:
    """Exact buckets and filters of one immutable set of texts."""

    def __init__(self, buckets: DataFrame, filters: DataFrame, shards: int):
        self.buckets, self.filters, self.shards = buckets, filters, shards


def snapshot(rows: DataFrame, groups: DataFrame, shard_rows: int = SHARD_ROWS) -> Snapshot:
    """Writes the buckets (the text of the row that stays of each group) and the filters."""
    spark = rows.sparkSession
    shards = max(1, -(-groups.count() // shard_rows))
    staying = groups.select(F.col("digest").alias("d"), F.col("keep_id").alias("k"))
    buckets = stored(spark, rows.join(staying, (F.col("digest") == F.col("d"))
                                      & F.col("doc_id").eqNullSafe(F.col("k")), "left_semi")
                     .select(shard_of(shards).alias("shard"), "digest", "text"), "buckets")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        seed, segment, segments, table = build_filter(pdf["key"].to_numpy().view(np.uint64))
        return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "seed": seed, "segment": segment,
                             "segments": segments, "prints": [table]})

    filters = stored(spark, buckets.select("shard", F.xxhash64("digest", F.lit(1)).alias("key")).distinct()
                     .groupBy("shard").applyInPandas(build, "shard int, seed long, segment long, segments long, "
                                                            "prints binary"), "filters")
    return Snapshot(buckets, filters, shards)


def screen(groups: DataFrame, snap: Snapshot, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``groups`` (one row per digest), each with ``passed``: whether the filters of
    ``snap`` let its digest through. A shard's digests are dealt over as many tasks
    as their number asks for."""
    parts = max(1, -(-groups.count() // (snap.shards * shard_rows)))
    arriving = groups.select("digest", "keep_id", "group_size", shard_of(snap.shards).alias("shard"),
                             F.pmod(F.xxhash64("digest", F.lit(2)), F.lit(parts)).cast("int").alias("part"),
                             F.xxhash64("digest", F.lit(1)).alias("key"))
    filters = snap.filters.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        keys = left["key"].to_numpy().view(np.uint64)
        if right.num_rows and left.num_rows:
            f = right.to_pylist()[0]
            passed = probe_filter(keys, f["seed"], f["segment"], f["segments"], f["prints"])
        else:  # the snapshot has nothing in this shard
            passed = np.zeros(len(keys), bool)
        return left.select(["digest", "keep_id", "group_size"]).append_column("passed", pa.array(passed, pa.bool_()))

    kind = groups.schema["keep_id"].dataType.simpleString()
    return (arriving.groupBy("shard", "part").cogroup(filters.groupBy("shard", "part"))
            .applyInArrow(probe, f"digest string, keep_id {kind}, group_size long, passed boolean"))


def homes(groups: DataFrame, snaps: list[Snapshot], own: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``groups`` with ``home``: the number of the snapshot whose buckets hold the
    digest, else ``own``. Only what a filter lets through is joined to buckets."""
    found, left = [], groups
    for number, snap in enumerate(snaps):
        seen = stored(groups.sparkSession, screen(left, snap, shard_rows), "screened")
        let_through = seen.where("passed").drop("passed")
        held = let_through.join(snap.buckets.select("digest", F.lit(number).alias("home")), "digest", "left")
        found.append(held.where("home IS NOT NULL"))
        left = seen.where("NOT passed").drop("passed").unionByName(held.where("home IS NULL").drop("home"))
    out = left.withColumn("home", F.lit(own))
    for one in found:  # false positives have ended here
        out = out.unionByName(one)
    return stored(groups.sparkSession, out, "homes")


def dedup(batches: list[DataFrame], digest=digest_of, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) for every row of the batches,
    which arrive one after the other; after each but the last, what it brought is
    frozen as a snapshot."""
    spark = batches[0].sparkSession
    snaps: list[Snapshot] = []
    pairs, members, texts = [], [], []
    for k, batch in enumerate(batches):
        rows = rows_of(batch, digest)
        own = stored(spark, pairs_of(rows), "pairs")
        placed = homes(groups_of(own), snaps, k, shard_rows)
        # rows whose digest others share, here or in a snapshot: their bytes are compared
        shared = placed.where((F.col("group_size") > 1) | (F.col("home") < k)).select("digest")
        texts.append(rows.join(shared, "digest", "left_semi").select("digest", "text"))
        for number, snap in enumerate(snaps):
            hit = placed.where(F.col("home") == number).select("digest")
            texts.append(snap.buckets.join(hit, "digest", "left_semi").select("digest", "text"))
        pairs.append(own.withColumn("batch", F.lit(k)))
        members.append(placed.withColumn("batch", F.lit(k)))
        if k < len(batches) - 1:
            snaps.append(snapshot(rows, placed.where(F.col("home") == k), shard_rows))
    every, member, text = (reduce(DataFrame.unionByName, x) for x in (pairs, members, texts))
    # a digest whose smallest and largest text differ stands for more than one text
    mixed_up = stored(spark, text.groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high"))
                      .where("low <> high").select("digest"), "mixed")
    out = ["doc_id", "keep_id", "group_size", "kept", "digest"]
    if mixed_up.isEmpty():
        return _decided(every, member).select(out)
    plain = _decided(every.join(mixed_up, "digest", "left_anti"), member).select(out)
    again = reduce(DataFrame.unionByName, [rows_of(b, digest) for b in batches])
    again = (again.join(mixed_up, "digest", "left_semi")
             .groupBy("digest", "text", "doc_id").agg(F.count("*").alias("repeats")))
    return plain.unionByName(_laid_out(again.join(groups_of(again, "text"), ["digest", "text"])).select(out))


def _decided(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Every row with its group: what each batch has of a digest, added up by the
    snapshot that the digest is at home in."""
    whole = members.groupBy("home", "digest").agg(F.max("keep_id").alias("keep_id"),
                                                  F.sum("group_size").alias("group_size"))
    groups = members.select("batch", "home", "digest").join(whole, ["home", "digest"])
    return _laid_out(pairs.join(groups.drop("home"), ["batch", "digest"]))


def _laid_out(pairs: DataFrame) -> DataFrame:
    """A row for each repeat; of the repeats of the row that stays, the first is kept."""
    copies = pairs.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats"))))
    return copies.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1))


def arrivals(docs: DataFrame) -> list[DataFrame]:
    """``docs`` as two arriving batches, the older half of the id range and the
    newer (ids are given in order of arrival); null ids arrive first."""
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = 0 if low is None else (low + high) // 2
    older = F.coalesce(F.col("doc_id") <= F.lit(middle), F.lit(True))
    return [docs.where(older), docs.where(~older)]


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    decided = dedup(arrivals(docs)).where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return rows_that_stay(docs, decided, digest_of)


def rows_that_stay(docs: DataFrame, staying: DataFrame, digest) -> DataFrame:
    """The rows of ``docs`` named by (doc_id, digest) in ``staying``, which has one
    row for each copy of them; of repeats of one row, one. Whether there are any
    is told from ``staying``, without moving texts."""
    keys = stored(docs.sparkSession, staying.groupBy("doc_id", "digest").agg(F.count("*").alias("n")), "staying")
    rows = (docs.withColumn("__digest", digest(content()))
            .join(keys.select(F.col("digest").alias("__d"), F.col("doc_id").alias("__i"), F.col("n").alias("__n")),
                  (F.col("__digest") == F.col("__d")) & F.col("doc_id").eqNullSafe(F.col("__i"))))
    if keys.where("n > 1").isEmpty():
        return rows.select(docs.columns)
    again = rows.where("__n > 1").dropDuplicates(["__digest", "doc_id"])
    return rows.where("__n = 1").select(docs.columns).unionByName(again.select(docs.columns))
