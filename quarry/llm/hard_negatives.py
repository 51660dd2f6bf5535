"""Hard negatives by a secondary-sort shuffle.

Every anchor is scored against every row, block against block: rows and anchors
are packed into blocks of bounded size, and a grid of cells pairs each block of
anchors with each block of rows. A cell keeps, of each anchor, the pairs that
can still count (a map-side combine: the best of the same label, and the best
within each positive's window). What is left is packed into keys (anchor,
descending score, positives first, id), shuffled and sorted by
``repartitionAndSortWithinPartitions``, and read as a stream: a positive opens
its window, a negative goes to every open window that has room. No anchor's
pairs are held together anywhere.

Scores are integer inner products of ``floor(256 * x)``, exact. Defined cases:
a row with a null id, label or vector, or a null or non-finite component, takes
no part; components that a shorter vector lacks count as zero; "other" rows are
those of another id; repeated rows take part as often as they occur, so an
anchor that occurs twice gets its result twice; ties go to the smaller id; an
empty table gives an empty result; other columns are ignored. A score of 2**50
or more is an error (``ArithmeticError``).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 50, 95
ROWS_PER_BLOCK = 2048
ANCHORS_PER_BLOCK = 1024
RANK = 1 << 12  # more than a block has rows; a score and a rank within the block are one number
LIMIT = 1 << 50
NONE = np.iinfo(np.int64).min

PACKED = "block long, n int, width int, ids binary, labels binary, vectors binary"
PAIRS = "block long, at int, score long, kind int, id long"
RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def taking_part(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, vector of whole numbers as double) of the rows that take part."""
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                        vector.alias("vector"))
            .where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite))


def packed(rows: DataFrame, most: int) -> DataFrame:
    """Blocks of at most ``most`` rows, each within one partition, numbered by
    partition and by order in it."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        k, held, n = 0, [], 0

        def block(rest: pa.Table) -> pa.RecordBatch:
            lists = rest.column("vector").combine_chunks()
            sizes = np.asarray(lists.value_lengths(), dtype=np.int64)
            width = int(sizes.max(initial=0))
            matrix = np.zeros((len(sizes), width))
            flat = np.asarray(lists.flatten(), dtype=np.float64)
            matrix[np.arange(width)[None, :] < sizes[:, None]] = np.floor(flat * SCALE)
            ids = np.asarray(rest.column("id").combine_chunks(), dtype=np.int64)
            labels = np.asarray(rest.column("label").combine_chunks(), dtype=np.int64)
            order = np.lexsort((labels, ids))
            narrow = matrix[order]
            return pa.RecordBatch.from_pydict({
                "block": pa.array([(part << 32) + k], pa.int64()), "n": pa.array([len(ids)], pa.int32()),
                "width": pa.array([width], pa.int32()), "ids": pa.array([ids[order].tobytes()], pa.binary()),
                "labels": pa.array([labels[order].tobytes()], pa.binary()),
                "vectors": pa.array([narrow.tobytes()], pa.binary())})

        for b in batches:
            held.append(b)
            n += b.num_rows
            while n >= most:
                whole = pa.Table.from_batches(held)
                yield block(whole.slice(0, most))
                k += 1
                held, n = whole.slice(most).to_batches(), n - most
        if n:
            yield block(pa.Table.from_batches(held))

    return rows.mapInArrow(pack, PACKED)


class Block:
    """A packed block as arrays; rows stand in order of their ids."""

    def __init__(self, n: int, ids: bytes, labels: bytes, vectors: bytes, width: int):
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        self.vectors = np.frombuffer(vectors, np.float64).reshape(n, width)

    def scores(self, rows: Block, part: slice) -> np.ndarray:
        """Score and rank of (some anchors, rows) as one number: more is better."""
        width = min(self.vectors.shape[1], rows.vectors.shape[1])
        a, b = self.vectors[part, :width], rows.vectors[:, :width]
        most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(width, 1)
        if most < 1 << 53:
            product = (a @ b.T).astype(np.int64)
        else:  # exact, if seldom needed
            product = a.astype(np.int64).astype(object) @ b.astype(np.int64).astype(object).T
            if np.abs(product).max(initial=0) >= LIMIT:
                raise ArithmeticError("a score of 2**50 or more: scale the vectors down")
            product = product.astype(np.int64)
        if np.abs(product).max(initial=0) >= LIMIT:
            raise ArithmeticError("a score of 2**50 or more: scale the vectors down")
        return product * RANK + (RANK - 1 - np.arange(len(rows.ids)))[None, :]


def best_of_label(anchors: Block, rows: Block) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor, score, id) of each anchor's best rows of the same label and another id."""
    for label in np.intersect1d(anchors.labels, rows.labels):
        own = np.flatnonzero(anchors.labels == label)
        theirs = np.flatnonzero(rows.labels == label)
        found = anchors.scores(rows, own)[:, theirs]
        found[anchors.ids[own][:, None] == rows.ids[theirs][None, :]] = NONE
        if found.shape[1] > POSITIVES:
            found = np.partition(found, found.shape[1] - POSITIVES, axis=1)[:, -POSITIVES:]
        at, k = np.nonzero(found != NONE)
        yield own[at], found[at, k] // RANK, rows.ids[RANK - 1 - found[at, k] % RANK]


def best_in_windows(anchors: Block, positives: list[np.ndarray], rows: Block) \
        -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor, score, id) of the best rows of other labels within the window of
    any of the anchor's positives (``positives``: their scores, by anchor)."""
    for first in range(0, len(anchors.ids), 128):
        part = slice(first, min(first + 128, len(anchors.ids)))
        found = anchors.scores(rows, part)
        found[anchors.labels[part][:, None] == rows.labels[None, :]] = NONE
        found.sort(axis=1)
        for k in range(found.shape[0]):
            if not len(scores := positives[first + k]):
                continue
            high = np.searchsorted(found[k], HIGH * scores // 100 * RANK + RANK - 1, "right")
            low = np.searchsorted(found[k], -(-LOW * scores // 100) * RANK, "left")
            low = np.maximum(low, high - NEGATIVES)
            spans = [np.arange(a, b) for a, b in zip(low, high, strict=True) if a < b]
            if spans:
                best = found[k][np.unique(np.concatenate(spans))]
                yield np.full(len(best), first + k), best // RANK, rows.ids[RANK - 1 - best % RANK]


def _pairs(cell: dict, found: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], kind: int) -> pa.RecordBatch:
    parts = list(found)
    at, score, ids = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(3))
    n = len(at)
    return pa.RecordBatch.from_pydict({
        "block": pa.array(np.full(n, cell["block"]), pa.int64()), "at": pa.array(at, pa.int32()),
        "score": pa.array(score, pa.int64()), "kind": pa.array(np.full(n, kind), pa.int32()),
        "id": pa.array(ids, pa.int64())})


def _blocks(cell: dict) -> tuple[Block, Block]:
    return (Block(cell["n"], cell["ids"], cell["labels"], cell["vectors"], cell["width"]),
            Block(cell["r_n"], cell["r_ids"], cell["r_labels"], cell["r_vectors"], cell["r_width"]))


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for k in range(b.num_rows):
            yield b.slice(k, 1).to_pylist()[0]


def positive_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for cell in _cells(batches):
        yield _pairs(cell, best_of_label(*_blocks(cell)), 0)


def negative_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for cell in _cells(batches):
        anchors, rows = _blocks(cell)
        scores: list = [[] for _ in range(cell["n"])]
        for p in cell["positives"]:
            scores[p["at"]].append(p["score"])
        yield _pairs(cell, best_in_windows(anchors, [np.unique(np.array(s, np.int64)) for s in scores], rows), 1)


def sort_key(block: int, at: int, score: int, kind: int, other: int) -> bytes:
    """Bytes that sort by anchor, falling score, positives first, rising id."""
    return struct.pack(">qiqbQ", block, at, LIMIT - score, kind, other + (1 << 63))


def by_anchor(key: bytes) -> int:
    return zlib.crc32(key[:12])


def windows(sorted_pairs: Iterator[tuple[bytes, None]]) -> Iterator[tuple]:
    """Reads pairs in key order; of each anchor it holds the open windows alone."""
    anchor, opened = None, []
    for key, _ in sorted_pairs:
        block, at, down, kind, other = struct.unpack(">qiqbQ", key)
        score, other = LIMIT - down, other - (1 << 63)
        if key[:12] != anchor:
            anchor, opened = key[:12], []
        if not kind:
            if len(opened) < POSITIVES:
                opened.append([other, score, 0])
            continue
        for window in opened:
            positive, best, given = window
            if given < NEGATIVES and LOW * best <= 100 * score <= HIGH * best:
                window[2] += 1
                yield block, at, positive, window[2], other, best, score


def mined(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
          anchor: str = "id % 50 = 0", relabel: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).
    ``anchor``: which rows are anchors; ``relabel``: the label to go by; both SQL
    over ``id`` and ``label``."""
    spark = rows.sparkSession
    part = taking_part(rows, id_col, vector_col, label_col).withColumn("label", F.expr(relabel).cast("long"))
    row_blocks = stored(spark, packed(part, ROWS_PER_BLOCK), "negatives-rows")
    of_anchors = part.where(anchor)
    parts = max(1, -(-of_anchors.count() // ANCHORS_PER_BLOCK))
    anchor_blocks = stored(spark, packed(of_anchors.repartition(parts), 2 * ANCHORS_PER_BLOCK), "negatives-anchors")
    # the grid: blocks of rows stand in `slices` columns, each beside every block of anchors
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slices = max(1, -(-4 * parallel // parts))
    right = (row_blocks.select(*[F.col(c).alias(f"r_{c}") for c in row_blocks.columns])
             .withColumn("slice", F.pmod(F.xxhash64("r_block"), F.lit(slices)).cast("int"))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))))
    left = (anchor_blocks.withColumn("part", F.shiftright("block", 32).cast("int"))
            .withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))))
    columns = [*anchor_blocks.columns, *[c for c in right.columns if c.startswith("r_")]]
    # laid out over the grid either side is larger than Spark's estimate of it, so neither is broadcast
    left = left.hint("merge")
    cells = left.join(right, ["part", "slice"])
    positives = stored(spark, _first_of_anchor(cells.select(columns).mapInArrow(positive_pairs, PAIRS)),
                       "negatives-positives")
    by_block = positives.groupBy("block").agg(F.collect_list(F.struct("at", "score")).alias("positives"))
    negatives = (left.join(by_block, "block").hint("merge").join(right, ["part", "slice"]).select(*columns, "positives")
                 .mapInArrow(negative_pairs, PAIRS))
    keys = positives.unionByName(negatives).rdd.map(lambda p: (sort_key(*p), None))
    found = keys.repartitionAndSortWithinPartitions(parallel, by_anchor).mapPartitions(windows)
    out = spark.createDataFrame(found, "block long, at int, positive_id long, rank int, negative_id long, "
                                       "positive_score long, negative_score long", verifySchema=False)
    return out.join(_anchor_ids(anchor_blocks), ["block", "at"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _first_of_anchor(pairs: DataFrame) -> DataFrame:
    """The first pairs of each anchor: at most ``POSITIVES`` of a block of rows
    come in, so that no anchor is large."""
    from pyspark.sql import Window

    order = Window.partitionBy("block", "at").orderBy(F.desc("score"), "id")
    return pairs.withColumn("place", F.row_number().over(order)).where(F.col("place") <= POSITIVES).drop("place")


def _anchor_ids(anchor_blocks: DataFrame) -> DataFrame:
    """(block, at, anchor_id)"""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches):
            ids = np.frombuffer(cell["ids"], np.int64)
            yield pa.RecordBatch.from_pydict({
                "block": pa.array(np.full(len(ids), cell["block"]), pa.int64()),
                "at": pa.array(np.arange(len(ids)), pa.int32()), "anchor_id": pa.array(ids, pa.int64())})

    return anchor_blocks.select("block", "ids").mapInArrow(unpack, "block long, at int, anchor_id long")


def duckdb_sql() -> str:
    return f"""
        WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
                   FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.id AS anchor_id, b.id AS other, a.label = b.label AS same,
                     CAST(list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
              FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 50 = 0),
        p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {POSITIVES}),
        n AS (SELECT p.*, other AS negative_id, score AS negative_score,
                     row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS r
              FROM p JOIN s USING (anchor_id) WHERE NOT same
              AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score)
        SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score
        FROM n WHERE r <= {NEGATIVES}"""
