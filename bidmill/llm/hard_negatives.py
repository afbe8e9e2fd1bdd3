"""Hard negatives of anchors: different-label rows that score nearly as high as
a positive.

1. Anchors are dealt to blocks of about ``ANCHORS`` rows. A task holds one block
   and reads its share of the candidates in tiles of ``CANDIDATES`` rows.
2. A tile is multiplied by Strassen's recursion: both sides are padded with
   zeros to even halves, seven products of halves replace eight, and all sums
   are exact integer sums (modulo 2**64, where the result still fits 64 bits).
3. First pass, rows of one label together: a heap of the best ``positives`` rows
   for each anchor. Small labels share a task, a hot label is dealt to many.
4. Second pass, all rows: for each anchor and positive a heap of the best
   ``negatives`` different-label rows inside the window that the positive's
   score sets.

Heaps merge by keeping the best of both: a task merges those of its tiles, and
the tasks' heaps of an anchor meet in a window of a few rows each. A block of
anchors is copied to the tasks that share the candidates, a candidate to each
block of anchors; memory is bounded by the block sizes, whatever the table.

Defined cases: rows with a NULL id, label or vector, or a NULL or non-finite
component take no part; shorter vectors count as padded with zeros, an empty
one is all zeros; components beyond 64 bits are cut to the largest, and so are
products; very long vectors shrink the blocks (``BLOCK_VALUES``); ties go to
the smaller id; rows that repeat an id are rows of their own, and so are their
results; fewer rows than asked for: all; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidmill.joins import broadcast_if_small
from bidmill.llm.store import discard, stored

ANCHORS, CANDIDATES = 4096, 2048
BLOCK_VALUES = 1 << 22     # components of a block
SHARE = 8                  # tiles of a task, where more tasks aren't needed
LEAF = 16                  # sides that are multiplied plainly
SCALE = 256
NONE = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b of integer matrices, by seven products of halves."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= LEAF:
        return a @ b
    if m % 2 or k % 2 or n % 2:      # zero padding to even sides
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    r, s, t = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :s], a[:r, s:], a[r:, :s], a[r:, s:]
    b11, b12, b21, b22 = b[:s, :t], b[:s, t:], b[s:, :t], b[s:, t:]
    out = np.empty((2 * r, 2 * t), dtype=a.dtype)
    p = strassen(a11 + a22, b11 + b22)
    out[:r, :t] = p
    out[r:, t:] = p
    p = strassen(a21 + a22, b11)
    out[r:, :t] = p
    out[r:, t:] -= p
    p = strassen(a11, b12 - b22)
    out[:r, t:] = p
    out[r:, t:] += p
    p = strassen(a22, b21 - b11)
    out[:r, :t] += p
    out[r:, :t] += p
    p = strassen(a11 + a12, b22)
    out[:r, :t] -= p
    out[:r, t:] += p
    out[r:, t:] += strassen(a21 - a11, b11 + b12)
    out[:r, :t] += strassen(a12 - a22, b21 + b22)
    return out[:m, :n]


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of a and b."""
    def longest(x):
        return math.sqrt((x.astype(np.float64) ** 2).sum(1).max(initial=0))
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), dtype=np.int64)
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    if longest(a) * longest(b) < 2 ** 62:
        return strassen(a, np.ascontiguousarray(b.T))
    wide = strassen(a.astype(object), b.T.astype(object))
    return np.clip(wide, NONE + 1, -(NONE + 1)).astype(np.int64)


def _matrix(column) -> np.ndarray:
    """Rows of an integer list column, padded with zeros to equal length."""
    size = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(size), int(size.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = column.flatten().to_numpy()
    return out


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    width = max(p.shape[1] for p in parts)
    return np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts])


class _Rows:
    """Rows of a task: row number, id, label and vector as arrays."""

    def __init__(self, batches: list[pa.RecordBatch]):
        self.row, self.id, self.label = (
            np.concatenate([b.column(c).to_numpy() for b in batches])
            for c in ("row", "id", "label"))
        self.x = _joined([_matrix(b.column("v")) for b in batches])


def _ranked(score: np.ndarray, *others: np.ndarray, keep: int):
    """The best ``keep`` along the last axis by score, then by the smaller
    value of the first other array."""
    order = np.lexsort((others[0], ~score), axis=-1)[..., :keep]
    return [np.take_along_axis(a, order, axis=-1) for a in (score, *others)]


class Positives:
    """Heaps of each anchor's best same-label rows."""

    names = ["row", "id", "positive_row", "positive_id", "positive_score"]

    def __init__(self, anchors: _Rows, batches: list, keep: int):
        self.anchors, self.keep = anchors, keep
        self.heap = [np.full((len(anchors.id), 0), v, dtype=np.int64) for v in (NONE, 0, 0)]

    def add(self, tile: _Rows, found: np.ndarray) -> None:
        fit = ((self.anchors.label[:, None] == tile.label[None, :])
               & (self.anchors.row[:, None] != tile.row[None, :]))
        found = np.where(fit, found, NONE)
        # by ascending score; tiles come by descending id
        at = np.argsort(found, axis=1, kind="stable")[:, -self.keep:]
        best = [np.take_along_axis(found, at, axis=1), tile.id[at], tile.row[at]]
        both = [np.concatenate(pair, axis=1) for pair in zip(self.heap, best)]
        self.heap = _ranked(*both, keep=self.keep)

    def rows(self) -> list[np.ndarray]:
        score, ids, rows = self.heap
        a, j = np.nonzero(score != NONE)
        return [self.anchors.row[a], self.anchors.id[a], rows[a, j], ids[a, j], score[a, j]]


class Windows:
    """Heaps of each anchor's and positive's best different-label rows."""

    names = ["row", "id", "positive_row", "positive_id", "positive_score", "negative_id",
             "negative_score"]

    def __init__(self, anchors: _Rows, batches: list, keep: int):
        self.anchors, self.keep = anchors, keep
        self.positive = [_joined([_matrix(b.column(c)) for b in batches])
                         for c in ("positive_row", "positive_id", "positive_score")]
        size = np.concatenate([np.diff(b.column("positive_id").offsets.to_numpy())
                               for b in batches])
        score = self.positive[2]
        self.given = np.arange(score.shape[1]) < size[:, None]
        # 50 p <= 100 s <= 95 p in whole numbers, without products
        self.low = -(-score // 2)
        self.high = score + (-score // 20)
        self.heap = [np.full((*score.shape, 0), v, dtype=np.int64) for v in (NONE, 0)]

    def add(self, tile: _Rows, found: np.ndarray) -> None:
        if not self.given.any():
            return
        found = np.where(self.anchors.label[:, None] != tile.label[None, :], found, NONE)
        order = np.argsort(found, axis=1, kind="stable")
        found = np.take_along_axis(found, order, axis=1)
        end = np.stack([np.searchsorted(f, h, side="right") for f, h in zip(found, self.high)])
        at = end[:, :, None] - 1 - np.arange(self.keep)
        a = np.arange(len(found))[:, None, None]
        score = found[a, np.maximum(at, 0)]
        fit = (at >= 0) & (score >= self.low[:, :, None]) & (score != NONE) & self.given[:, :, None]
        best = [np.where(fit, score, NONE), tile.id[order[a, np.maximum(at, 0)]]]
        both = [np.concatenate(pair, axis=2) for pair in zip(self.heap, best)]
        self.heap = _ranked(*both, keep=self.keep)

    def rows(self) -> list[np.ndarray]:
        score, ids = self.heap
        a, j, k = np.nonzero(score != NONE)
        return [self.anchors.row[a], self.anchors.id[a], *(p[a, j] for p in self.positive),
                ids[a, j, k], score[a, j, k]]


def _mining(heaps, keep: int, tile_rows: int):
    """Rows come by (grp, block, part, side): a block's anchors, candidates."""
    def run(batches):
        whose, first, heap, waiting = None, [], None, []

        def multiplied(tile):
            order = np.argsort(~tile.id, kind="stable")
            tile.row, tile.id, tile.label, tile.x = (
                v[order] for v in (tile.row, tile.id, tile.label, tile.x))
            heap.add(tile, scores(heap.anchors.x, tile.x))

        def ended():
            if waiting:
                multiplied(_Rows(waiting))
            if heap is not None:
                out = heap.rows()
                if len(out[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                                     names=heaps.names)

        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in ("grp", "block", "part", "side")])
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
                if lo == hi:
                    continue
                group = tuple(key[:3, lo])
                if group != whose:
                    yield from ended()
                    whose, first, heap, waiting = group, [], None, []
                if not key[3, lo]:
                    first.append(batch.slice(lo, hi - lo))
                    continue
                if not first:       # no anchors in this block
                    continue
                if heap is None:
                    heap = heaps(_Rows(first), first, keep)
                while lo < hi:
                    room = tile_rows - sum(map(len, waiting))
                    waiting.append(batch.slice(lo, min(room, hi - lo)))
                    lo += min(room, hi - lo)
                    if sum(map(len, waiting)) >= tile_rows:
                        multiplied(_Rows(waiting))
                        waiting = []
        yield from ended()
    return run


def _heaps(anchors: DataFrame, candidates: DataFrame, heaps, keep: int, tile_rows: int,
           name: str) -> DataFrame:
    """anchors: grp, block, parts, row, id, label, v and what ``heaps`` reads;
    candidates: grp, blocks, parts, row, id, label, v."""
    extra = [c for c in anchors.columns if c not in (*candidates.columns, "block")]
    held = anchors.select("grp", "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
                          .alias("part"), F.lit(0).alias("side"), "row", "id", "label", "v", *extra)
    read = candidates.select(
        "grp", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("row", F.lit(name)), F.col("parts")).cast("int").alias("part"),
        F.lit(1).alias("side"), "row", "id", "label", "v",
        *[F.lit(None).cast(anchors.schema[c].dataType).alias(c) for c in extra])
    return stored(
        held.unionByName(read).repartition("grp", "block", "part")
        .sortWithinPartitions("grp", "block", "part", "side")
        .mapInArrow(_mining(heaps, keep, tile_rows), ", ".join(f"{c} long" for c in heaps.names)),
        name)


def _block(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("row"), blocks).cast("int")


def _count(rows: Column, size: int) -> Column:
    return F.greatest(F.ceil(rows / F.lit(size)), F.lit(1)).cast("int")


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3,
         id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
         anchor_rows: int = ANCHORS, tile_rows: int = CANDIDATES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    raw = F.col(vector_col)
    finite = F.forall(raw, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                      & (F.abs(c.cast("double")) < float("inf")))
    rows = stored(
        vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()
                      & F.coalesce(finite, F.lit(False)))
        .select(F.monotonically_increasing_id().alias("row"),
                F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                F.transform(raw, lambda c: F.floor(c.cast("double") * SCALE)).alias("v"),
                F.coalesce(is_anchor, F.lit(False)).alias("is_anchor")), "mining-rows")
    all_of = rows.agg(F.count("*").alias("n"), F.count_if("is_anchor").alias("asked"),
                      F.max(F.size("v")).alias("width")).first()
    room = max(1, BLOCK_VALUES // max(all_of["width"] or 1, 1))
    anchor_rows, tile_rows = min(anchor_rows, room), min(tile_rows, room)
    share = SHARE * tile_rows

    # labels that fill no share are put together
    labels = stored(rows.groupBy("label").agg(F.count("*").alias("n"),
                                              F.count_if("is_anchor").alias("asked"))
                    .where("asked > 0"), "mining-labels")
    bins = max(1, -(-(labels.where(F.col("n") < share).agg(F.sum("n")).first()[0] or 0) // share))
    small = F.col("n") < share
    dealt = labels.select(
        "label", F.when(small, F.pmod(F.xxhash64("label"), F.lit(bins))).otherwise(F.col("label"))
        .alias("value"), small.alias("small"),
        F.when(small, 1).otherwise(_count(F.col("asked"), anchor_rows)).alias("blocks"),
        F.when(small, 1).otherwise(_count(F.col("n"), share)).alias("parts"))
    dealt = dealt.withColumn("grp", F.xxhash64("small", "value")).drop("small", "value")
    placed = rows.join(broadcast_if_small(dealt), "label")
    best = _heaps(
        placed.where("is_anchor").select("grp", _block(F.col("blocks")).alias("block"), "parts",
                                         "row", "id", "label", "v"),
        placed.select("grp", "blocks", "parts", "row", "id", "label", "v"),
        Positives, positives, tile_rows, "mining-positives")
    order = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id")
    chosen = (best.withColumn("_rank", F.row_number().over(order))
              .where(F.col("_rank") <= positives).groupBy("row").agg(F.sort_array(F.collect_list(
                  F.struct("_rank", "positive_row", "positive_id", "positive_score"))).alias("p"))
              .select("row", *[F.col(f"p.{c}").alias(c) for c in (
                  "positive_row", "positive_id", "positive_score")]))

    # tasks enough for the cluster, or shares of candidates
    blocks = max(1, -(-all_of["asked"] // anchor_rows))
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-all_of["n"] // share), min(-(-3 * cores // blocks), all_of["n"] // 256))
    found = _heaps(
        rows.where("is_anchor").join(chosen, "row").select(
            F.lit(0).cast("long").alias("grp"), _block(F.lit(blocks)).alias("block"),
            F.lit(parts).alias("parts"), "row", "id", "label", "v", "positive_row", "positive_id",
            "positive_score"),
        rows.select(F.lit(0).cast("long").alias("grp"), F.lit(blocks).alias("blocks"),
                    F.lit(parts).alias("parts"), "row", "id", "label", "v"),
        Windows, negatives, tile_rows, "mining-negatives")
    discard(rows, labels, best)
    order = Window.partitionBy("row", "positive_row").orderBy(F.desc("negative_score"),
                                                              "negative_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
            .select(F.col("id").alias("anchor_id"), "positive_id", "rank", "negative_id",
                    "positive_score", "negative_score"))
