"""Exact top-k inner-product search by norm buckets.

1. Vectors are dealt to buckets of about ``BUCKET`` rows by descending length
   (range partitioning on length, then a hash, so many equal vectors split).
2. Each query gets a first threshold: its k-th best product in the bucket of
   the longest vectors (one bucket, of bounded size, shipped with the tasks).
3. A query goes to the buckets whose longest vector could still reach its
   threshold. There its local cosine threshold t = threshold / (|q| longest)
   chooses the pruning: above 1 nothing fits; from ``COORDINATE_FROM`` on,
   coordinate pruning (on the query's largest coordinates, a unit vector with
   cosine >= t lies in a known interval); below that, length pruning.
4. Candidates' integer products are verified exactly, the best k of each bucket
   are kept, and a query's buckets are merged by rank.

A bucket's vectors are held by one task, queries stream past them in batches;
with many queries a bucket is copied to several tasks. The summary that the
driver reads is one row for each bucket.

Defined cases: vectors that are NULL, empty, or hold a NULL or non-finite
component take no part; shorter vectors count as padded with zeros; products
beyond 64 bits are cut to the largest; ties go to the smaller id; rows that
repeat an id are rows of their own; fewer than k other rows: all of them; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidmill.llm.store import discard, stored

BUCKET = 4096
QUERIES_PER_TASK = 1 << 16
COORDINATE_FROM, FOCUS = 0.6, 3
SCALE = 256
SLACK = 1e-9


def _matrix(column) -> np.ndarray:
    """Rows of an integer list column, padded with zeros to equal length."""
    off, values = column.offsets.to_numpy().astype(np.int64), column.values.to_numpy()
    size = np.diff(off)
    width = int(size.max(initial=0))
    if (size == width).all():
        return values[off[0]:off[-1]].reshape(len(size), width)
    out = np.zeros((len(size), width), dtype=np.int64)
    out[np.arange(width) < size[:, None]] = values[off[0]:off[-1]]
    return out


def _padded(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] == width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer products q (m, d) by x (n, d). Sums of absolute terms are
    at most the product of the lengths, which decides how they are computed."""
    if not len(q) or not len(x):
        return np.zeros((len(q), len(x)), dtype=np.int64)
    bound = np.sqrt((q.astype(np.float64) ** 2).sum(1).max()) * np.sqrt(
        (x.astype(np.float64) ** 2).sum(1).max())
    if bound < 2 ** 24:
        return (q.astype(np.float32) @ x.astype(np.float32).T).astype(np.int64)
    if bound < 2 ** 53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    if bound < 2 ** 62:
        return q @ x.T
    exact = q.astype(object) @ x.astype(object).T
    return np.clip(exact, -2 ** 63, 2 ** 63 - 1).astype(np.int64)


def _thresholds(seed: np.ndarray, seed_rows: np.ndarray, longest: list[tuple[int, float]], k: int):
    """A row for each query and bucket that may hold one of its best k."""
    buckets = np.array([b for b, _ in longest], dtype=np.int64)
    reach = np.array([r for _, r in longest])

    def run(batches):
        for batch in batches:
            q = _matrix(batch.column("v"))
            width = max(q.shape[1], seed.shape[1])
            found = products(_padded(q, width), _padded(seed, width)).astype(np.float64)
            rows, norm = batch.column("row").to_numpy(), batch.column("norm").to_numpy()
            found[rows[:, None] == seed_rows[None, :]] = -np.inf
            if found.shape[1] >= k:
                least = np.partition(found, found.shape[1] - k, axis=1)[:, found.shape[1] - k]
            else:
                least = np.full(len(q), -np.inf)
            # with a positive threshold, a bucket must be able to reach it
            can = (least[:, None] <= 0) | (norm[:, None] * reach[None, :]
                                           >= least[:, None] * (1 - SLACK))
            which, to = np.nonzero(can)
            picked = batch.take(pa.array(which))
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets[to]), *(picked.column(c) for c in ("row", "id", "v", "norm")),
                 pa.array(least[which])],
                names=["bucket", "row", "id", "v", "norm", "least"])
    return run


class _Bucket:
    def __init__(self, batches: list, width: int):
        self.rows = np.concatenate([b.column("row").to_numpy() for b in batches])
        self.ids = np.concatenate([b.column("id").to_numpy() for b in batches])
        norms = np.concatenate([b.column("norm").to_numpy() for b in batches])
        x = [_matrix(b.column("v")) for b in batches]
        width = max([width, *(m.shape[1] for m in x)])
        x = np.concatenate([_padded(m, width) for m in x])
        order = np.argsort(-norms, kind="stable")
        self.x, self.norms = x[order], norms[order]
        self.rows, self.ids = self.rows[order], self.ids[order]
        unit = self.x / np.where(self.norms > 0, self.norms, 1)[:, None]
        self.order = np.argsort(unit, axis=0)
        self.sorted = np.take_along_axis(unit, self.order, axis=0)

    def near(self, q: np.ndarray, norm: float, t: float) -> np.ndarray:
        """Coordinate pruning: vectors in the feasible interval of each of the
        query's largest coordinates."""
        unit = q / norm
        hits = np.zeros(len(self.x), dtype=np.int8)
        focus = np.argsort(-np.abs(unit))[:FOCUS]
        for f in focus:
            width = np.sqrt(max(0.0, (1 - t * t) * (1 - unit[f] ** 2)))
            lo, hi = unit[f] * t - width - SLACK, unit[f] * t + width + SLACK
            # the interval reaches the end where the coordinate alone is enough
            lo = -1 if -unit[f] >= t else lo
            hi = 1 if unit[f] >= t else hi
            a, b = np.searchsorted(self.sorted[:, f], (lo, hi + SLACK))
            hits[self.order[a:b, f]] += 1
        return np.flatnonzero(hits == len(focus))

    def best(self, q, rows, ids, norms, least, k):
        """(query row, query id, id, score) of the best k of each query here."""
        width = max(q.shape[1], self.x.shape[1])
        q, x = _padded(q, width), _padded(self.x, width)
        reach = norms * self.norms[0]
        t = np.where(reach > 0, least / np.where(reach > 0, reach, 1), np.where(least > 0, 2, 0))
        t *= 1 - SLACK
        close = (t >= COORDINATE_FROM) & (t <= 1)
        out = []

        def keep(i, at, score):
            fit = (self.rows[at] != rows[i]) & (score >= least[i])
            at, score = at[fit], score[fit]
            if len(score) > k:
                # everything that ties with the k-th best, then by id
                edge = np.partition(score, len(score) - k)[len(score) - k]
                at, score = at[score >= edge], score[score >= edge]
            first = np.lexsort((self.ids[at], -score))[:k]
            out.append((np.full(len(first), rows[i]), np.full(len(first), ids[i]),
                        self.ids[at[first]], score[first]))

        for i in np.flatnonzero(close):
            at = self.near(q[i], norms[i], t[i])
            if len(at):
                keep(i, at, products(q[i:i + 1], x[at])[0])
        wide = np.flatnonzero(t < COORDINATE_FROM)
        if len(wide):
            # length pruning: vectors come by descending length
            floor = np.where((least[wide] > 0) & (norms[wide] > 0),
                             least[wide] * (1 - SLACK) / np.maximum(norms[wide], 1e-300), 0)
            count = np.searchsorted(-self.norms, -floor, side="right")
            order = np.argsort(-count, kind="stable")
            for lo in range(0, len(order), 256):
                part = order[lo:lo + 256]
                most = int(count[part].max())
                found = products(q[wide[part]], x[:most])
                for j, p in enumerate(part):
                    n = int(count[p])
                    keep(wide[p], np.arange(n), found[j, :n])
        return [np.concatenate(c) for c in zip(*out)] if out else None


def _searching(k: int):
    """Rows come sorted by (bucket, part, query): vectors, then the queries."""
    def run(batches):
        held, bucket, whose = [], None, None
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in ("bucket", "part", "query")])
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
                if lo == hi:
                    continue
                part, group = batch.slice(lo, hi - lo), tuple(key[:2, lo])
                if group != whose:
                    held, bucket, whose = [], None, group
                if not key[2, lo]:
                    held.append(part)
                    continue
                q = _matrix(part.column("v"))
                if bucket is None:
                    bucket, held = _Bucket(held, q.shape[1]), []
                found = bucket.best(q, *(part.column(c).to_numpy() for c in (
                    "row", "id", "norm", "least")), k)
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in found],
                        names=["row", "query_id", "vec_id", "score"])
    return run


def scaled(vector: Column) -> Column:
    """floor(256 * x) of each component as double."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
          vector_col: str = "embedding", bucket_rows: int = BUCKET) -> DataFrame:
    """query_id, rank, vec_id, score."""
    raw = F.col(vector_col)
    usable = (F.size(raw) > 0) & F.forall(raw, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                                          & (F.abs(c.cast("double")) < float("inf")))
    ok = vectors.where(F.coalesce(usable, F.lit(False)) & F.col(id_col).isNotNull())
    rows = ok.select(F.col(id_col).cast("long").alias("id"), scaled(raw).alias("v"),
                     F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = rows.withColumn("norm", F.sqrt(F.aggregate(
        "v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))))
    n = rows.count()
    placed = stored(rows.repartitionByRange(max(1, -(-n // bucket_rows)), F.desc("norm"),
                                            F.xxhash64("id"), "id")
                    .withColumn("bucket", F.spark_partition_id().cast("long"))
                    .withColumn("row", F.monotonically_increasing_id()), "vector-buckets")
    # one row for each bucket
    longest = [(r["bucket"], r["norm"]) for r in placed.groupBy("bucket").agg(
        F.max("norm").alias("norm")).collect()]
    longest.sort(key=lambda b: (-b[1], b[0]))
    first = longest[0][0] if longest else -1
    seed = placed.where(F.col("bucket") == first).select("row", "v").limit(4 * bucket_rows).collect()
    width = max((len(r["v"]) for r in seed), default=0)
    seed_x = np.array([list(r["v"]) + [0] * (width - len(r["v"])) for r in seed],
                      dtype=np.int64).reshape(len(seed), width)
    seed_rows = np.array([r["row"] for r in seed], dtype=np.int64)
    asked = placed.where("is_query").select("row", "id", "v", "norm")
    schema = "bucket long, row long, id long, v array<bigint>, norm double, least double"
    queries = stored(asked.mapInArrow(_thresholds(seed_x, seed_rows, longest, k), schema),
                     "vector-queries")
    parts = queries.groupBy("bucket").agg(F.ceil(F.count("*") / QUERIES_PER_TASK).alias("parts"))
    parts = stored(parts, "vector-parts")
    sides = parts.join(placed, "bucket").select(
        "bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
        F.lit(0).alias("query"), "row", "id", "v", "norm", F.lit(0.0).alias("least"))
    turns = queries.join(parts, "bucket").select(
        "bucket", F.pmod(F.xxhash64("row"), F.col("parts")).alias("part"), F.lit(1).alias("query"),
        "row", "id", "v", "norm", "least")
    found = (sides.unionByName(turns).repartition("bucket", "part")
             .sortWithinPartitions("bucket", "part", "query")
             .mapInArrow(_searching(k), "row long, query_id long, vec_id long, score long"))
    found = stored(found, "vector-best")
    discard(queries, parts)
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
