"""MinHash near-dedup with sequential Bayesian verification.

1. Each document's set of ``shingle``-word shingles (64-bit hashes) gets
   ``bands * rows`` minima. Documents with equal sets form one class; only the
   smallest id of a class goes on.
2. Classes that share a band of ``rows`` minima meet in a bucket. Each bucket
   is first compared with its smallest member only (a star), and links found
   are joined into components, so thousands of close copies cost their number.
   Only buckets that still hold several components are looked at again. Their
   members are dealt to blocks, and a task compares two blocks at a time in
   memory: pairs of one component, or that met in an earlier band, are passed
   over, and only links leave the task, never pairs. A bucket of more than
   ``LARGE_BUCKET`` members first gets ``ROUNDS`` more leaders from outside its
   largest component, and is then split on a second and third band (pairs that
   share these bands as well), which only joins more components: if it still
   holds several at last, it is dealt to blocks as the others are. Of a bucket
   of several blocks the largest component's members meet only the others.
3. A candidate pair's signatures are compared batch by batch; the pair is
   dropped once the posterior probability of a similarity of ``threshold`` or
   more (uniform prior) is below ``miss``. Survivors are confirmed on their
   full shingle sets.

A pair at the threshold meets in no band with probability
(1 - threshold**rows)**bands, 5e-6 for the defaults.

Defined cases: a NULL or wordless text has an empty set and is linked with
nothing; with fewer words than a shingle the whole sequence is one shingle.
Rows of one doc_id and different texts are documents of their own, ordered by
the hash of the text: each is linked and kept or dropped by its own text. Rows
equal in doc_id and text are one document, and each returns its result
(``first_rows`` keeps one of them). A NULL doc_id counts as the smallest id and
is returned as NULL. A very long text is shingled whole, in a block of its own.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidmill.llm import textscan as ts
from bidmill.llm.graph import components
from bidmill.llm.store import NO_ID, discard, id_of, running_total, stored, text_of
from bidmill.session import bound_batches

SHINGLE = 5
BANDS, ROWS = 32, 4
THRESHOLD = 75          # percent
MISS = 1e-6
BATCH = 16
LARGE_BUCKET, BLOCK = 8192, 1024
ROUNDS, SPLIT_LEVELS = 3, 2


def shingle_sets(buf: np.ndarray, off: np.ndarray, shingle: int):
    """Hashes of all rows' shingles and each row's first one (rows + 1);
    repeats included."""
    buf = ts.lowered(buf)
    starts, ends, first = ts.words(buf, off)
    tokens = ts.span_hashes(buf, starts, ends)
    runs = ts.run_hashes(tokens, shingle)
    counts = np.diff(first)
    n = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    bounds = np.concatenate(([0], np.cumsum(n)))
    out = runs[np.minimum(ts.ranges(first[:-1], n), max(len(runs) - 1, 0))] if len(runs) \
        else np.zeros(int(n.sum()), dtype=np.uint64)
    for d in np.flatnonzero((counts > 0) & (counts < shingle)):
        whole = ts.run_hashes(tokens[first[d]:first[d + 1]], int(counts[d]))
        out[bounds[d]] = ts.mix(whole + np.uint64(counts[d]))[0]
    return out, bounds


def _signatures(shingle: int, width: int):
    rng = np.random.Generator(np.random.PCG64(7))
    mult = rng.integers(0, 2 ** 63, size=width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 2 ** 64, size=width, dtype=np.uint64)

    def run(batches):
        for batch in batches:
            n_out, one, two, sigs = [], [], [], []
            for _, buf, off in ts.blocks(batch.column("_text"), 1 << 18):
                hashes, bounds = shingle_sets(buf, off, shingle)
                filled = np.flatnonzero(np.diff(bounds))
                n = len(off) - 1
                size, a, b = (np.zeros(n, dtype=np.int64) for _ in range(3))
                sig = np.zeros((n, width), dtype=np.uint32)
                if len(filled):
                    # distinct shingles of each row
                    uniq = [np.unique(hashes[bounds[d]:bounds[d + 1]]) for d in filled]
                    size[filled] = [len(u) for u in uniq]
                    flat = np.concatenate(uniq)
                    begin = np.concatenate(([0], np.cumsum(size[filled])[:-1]))
                    a[filled] = np.add.reduceat(flat, begin).view(np.int64)
                    b[filled] = np.add.reduceat(ts.mix(flat), begin).view(np.int64)
                    for k in range(width):
                        value = ((flat * mult[k] + add[k]) >> np.uint64(32)).astype(np.uint32)
                        sig[filled, k] = np.minimum.reduceat(value, begin)
                n_out.append(size)
                one.append(a)
                two.append(b)
                sigs.append(sig)
            if n_out:
                raw = np.concatenate(sigs)
                step = width * 4
                blob = pa.Array.from_buffers(pa.binary(), len(raw), [
                    None, pa.py_buffer(np.arange(len(raw) + 1, dtype=np.int32) * np.int32(step)),
                    pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id"), batch.column("_h"), pa.array(np.concatenate(n_out)),
                     pa.array(np.concatenate(one)), pa.array(np.concatenate(two)), blob],
                    names=["_id", "_h", "n", "s1", "s2", "sig"])
    return run


def least_matches(width: int, batch: int, threshold: float, miss: float) -> list[int]:
    """After each batch: the fewest matches with which the posterior
    probability of a similarity >= threshold still reaches ``miss``. With a
    uniform prior that probability is P(Binomial(n + 1, threshold) <= m)."""
    out = []
    for n in range(batch, width + 1, batch):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def _survivors(width: int, batch: int, threshold: float, miss: float):
    need = least_matches(width, batch, threshold, miss)

    def run(batches):
        for rows in batches:
            if not rows.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(rows.column(c).to_pylist()),
                                         dtype=np.uint32).reshape(-1, width)
                           for c in ("sig_a", "sig_b"))
            alive, seen = np.arange(len(left)), np.zeros(len(left), dtype=np.int64)
            for k, fewest in enumerate(need):
                part = slice(k * batch, (k + 1) * batch)
                seen[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
                alive = alive[seen[alive] >= fewest]
            keep = pa.array(alive)
            yield pa.RecordBatch.from_arrays(
                [rows.column("a").take(keep), rows.column("b").take(keep)], names=["a", "b"])
    return run


def _distinct_sets(column, shingle: int):
    for _, buf, off in ts.blocks(column, 1 << 18):
        hashes, bounds = shingle_sets(buf, off, shingle)
        for d in range(len(off) - 1):
            yield np.unique(hashes[bounds[d]:bounds[d + 1]])


def _linked(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(two) - both)


def _confirmed(shingle: int, percent: int):
    """Rows come sorted by (a, part, side): the text of ``a``, then its partners'."""
    def run(batches):
        lead, whose = None, None
        for rows in batches:
            found_a, found_b = [], []
            a, b, part = (rows.column(c).to_pylist() for c in ("a", "b", "part"))
            for i, own in enumerate(_distinct_sets(rows.column("_text"), shingle)):
                if b[i] is None:
                    lead, whose = own, (a[i], part[i])
                    continue
                assert whose == (a[i], part[i]), "a partner came without its leader"
                if _linked(lead, own, percent):
                    found_a.append(a[i])
                    found_b.append(b[i])
            yield pa.RecordBatch.from_arrays(
                [pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"])
    return run


def _block_links(shingle: int, percent: int, miss: float, bands: int, rows_: int, first: bool):
    """Rows come sorted by (key, i, j): the members of two blocks of a bucket
    (of one, if i = j). Emits the links between different components."""
    width = bands * rows_
    need = np.array(least_matches(width, BATCH, percent / 100, miss))

    def links(group: pa.Table):
        group = group.combine_chunks()
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        ids, labels, block, sizes, band = (group.column(c).to_numpy() for c in (
            "_id", "label", "block", "n", "band"))
        sig = np.frombuffer(b"".join(group.column("sig").to_pylist()),
                            dtype=np.uint32).reshape(-1, width)
        sets = list(_distinct_sets(group.column("_text").combine_chunks(), shingle))
        root = {}

        def find(x):
            while root.get(x, x) != x:
                x = root[x]
            return x

        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        for n, x in enumerate(left):
            others = left[n + 1:] if i == j else right
            others = others[(labels[others] != labels[x])
                            & (100 * np.minimum(sizes[others], sizes[x])
                               >= percent * np.maximum(sizes[others], sizes[x]))]
            if not len(others):
                continue
            same = sig[others] == sig[x]
            seen = same.reshape(-1, len(need), BATCH).sum(axis=2).cumsum(axis=1)
            good = (seen >= need).all(axis=1)
            if first:
                meet = same.reshape(-1, bands, rows_).all(axis=2)
                good &= meet.argmax(axis=1) == band[x]
            for y in others[good]:
                a, b = find(labels[x]), find(labels[y])
                if a != b and _linked(sets[x], sets[y], percent):
                    root[max(a, b)] = min(a, b)
                    yield int(ids[x]), int(ids[y])

    def run(batches):
        held, whose = [], None

        def done():
            found = list(links(pa.Table.from_batches(held))) if held else []
            return pa.RecordBatch.from_arrays(
                [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["u", "v"])

        for batch in batches:
            at = np.stack([batch.column(c).to_numpy() for c in ("key", "i", "j")])
            cuts = np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
                if lo == hi:
                    continue
                if tuple(at[:, lo]) != whose:
                    yield done()
                    held, whose = [], tuple(at[:, lo])
                held.append(batch.slice(lo, hi - lo))
        yield done()
    return run


class _Search:
    """Links between classes, found bucket by bucket."""

    def __init__(self, texts, classes, shingle, bands, rows, percent, miss):
        self.texts, self.classes = texts, classes
        self.shingle, self.bands, self.rows = shingle, bands, rows
        self.percent, self.miss = percent, miss
        self.labels = None

    def band_keys(self) -> DataFrame:
        step = self.rows * 4
        hashes = F.transform(F.sequence(F.lit(0), F.lit(self.bands - 1)), lambda i: F.xxhash64(
            i, F.substring(F.col("sig"), i * step + 1, F.lit(step))))
        return self.classes.select("_id", F.posexplode(hashes).alias("band", "key"))

    def label(self, keyed: DataFrame) -> DataFrame:
        if self.labels is None:
            return keyed.withColumn("label", F.col("_id"))
        return (keyed.join(self.labels, keyed["_id"] == self.labels["node"], "left")
                .withColumn("label", F.coalesce("component", "_id")).drop("node", "component"))

    def add(self, pairs: DataFrame) -> None:
        """Verify candidate pairs (a < b) and update the components."""
        pairs = stored(pairs.distinct(), "candidates")
        sig = self.classes.select("_id", "n", "sig")
        width = self.bands * self.rows
        survivors = stored(
            pairs.join(sig.toDF("a", "m", "sig_a"), "a").join(sig.toDF("b", "n", "sig_b"), "b")
            # sets of very unlike sizes can't reach the threshold
            .where(100 * F.least("n", "m") >= self.percent * F.greatest("n", "m"))
            .select("a", "b", "sig_a", "sig_b")
            .mapInArrow(_survivors(width, BATCH, self.percent / 100, self.miss), "a long, b long"),
            "survivors")
        # a leader's text goes once to each part of up to about 64 partners
        counts = survivors.groupBy("a").agg(F.ceil(F.count("*") / 64).alias("parts"))
        counts = stored(counts, "leaders")
        part = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")
        # of known size: while it is small, the texts aren't shuffled to find its own
        turns = stored(survivors.join(counts, "a").select("a", "b", part.alias("part")), "turns")
        partners = turns.join(self.texts.withColumnRenamed("_id", "b"), "b")
        leaders = (counts.join(self.texts.withColumnRenamed("_id", "a"), "a")
                   .select("a", F.lit(None).cast("long").alias("b"), F.explode(
                       F.sequence(F.lit(0), (F.col("parts") - 1).cast("int"))).alias("part"),
                       "_text"))
        links = stored(
            leaders.unionByName(partners.select("a", "b", "part", "_text"))
            .repartition("a", "part")
            .sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
            .mapInArrow(_confirmed(self.shingle, self.percent), "a long, b long"), "links")
        discard(pairs, survivors, counts, turns)
        self.connect(links.select(F.col("b").alias("u"), F.col("a").alias("v")))

    def connect(self, links: DataFrame) -> None:
        # the links found so far are in the labels, as stars
        edges = links if self.labels is None else links.unionByName(
            self.labels.select(F.col("node").alias("u"), F.col("component").alias("v")))
        self.labels = components(edges)

    def star(self, keyed: DataFrame) -> DataFrame:
        """Compare every bucket's members with its smallest one; returns the
        rows of buckets with more than one member."""
        least = stored(keyed.groupBy("key").agg(F.min("_id").alias("a"), F.max("_id").alias("z"))
                       .where("a < z").select("key", "a"), "bucket-leads")
        shared = stored(keyed.join(least, "key"), "buckets")
        self.add(shared.where(F.col("_id") != F.col("a")).select("a", F.col("_id").alias("b")))
        discard(least)
        return shared.withColumn("led", F.col("_id") == F.col("a")).drop("a")

    def mixed(self, shared: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows of buckets that still hold several components, with the largest
        one and the number of members: those of bounded size, and the others."""
        now = stored(self.label(shared), "bucket-labels")
        parts = now.groupBy("key", "label").agg(F.count("*").alias("n"))
        stats = stored(parts.groupBy("key").agg(
            F.count("*").alias("parts"), F.sum("n").alias("members"),
            F.max("n").alias("mains"),
            F.max_by("label", F.struct("n", "label")).alias("main"))
            .where("parts > 1").select("key", "main", "mains", "members"), "bucket-stats")
        rows = now.join(stats, "key")
        return (rows.where(F.col("members") <= LARGE_BUCKET),
                rows.where(F.col("members") > LARGE_BUCKET))

    def across(self, rows: DataFrame, first: bool) -> None:
        """Links across the components of buckets, two blocks at a time."""
        def blocks(n):
            return F.ceil(n / BLOCK).cast("int")

        # blocks of their own for the largest component, if that makes fewer copies
        mains, members, others = (F.col("mains"), F.col("members"),
                                  F.col("members") - F.col("mains"))
        apart = mains * blocks(others) + others * (blocks(others) + blocks(mains)) \
            < members * blocks(members)
        own = rows.withColumns({
            "_main": apart & (F.col("label") == F.col("main")),
            "_first": F.when(apart, blocks(others)).otherwise(blocks(members)),
            "_more": F.when(apart, blocks(mains)).otherwise(0)})
        mixed = F.xxhash64("_id")
        own = own.select("key", "band", "_id", "label", "_main", "_first", "_more", F.when(
            F.col("_main"), F.col("_first") + F.pmod(mixed, F.col("_more")))
            .otherwise(F.pmod(mixed, F.col("_first"))).cast("int").alias("block"))
        dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("_first") - 1 + F.when(
            F.col("_main"), 0).otherwise(F.col("_more")))))
        dealt = stored(dealt.select("key", "band", "_id", "label", "block",
                                    F.least("block", "other").alias("i"),
                                    F.greatest("block", "other").alias("j")), "dealt")
        # of known size: while they are few, the other rows aren't shuffled;
        # else the joins on the id share one exchange of the texts
        own = stored(dealt.select("_id").distinct(), "dealt-ids")
        full = (dealt.join(self.classes.join(own, "_id", "left_semi"), "_id")
                .join(self.texts.join(own, "_id", "left_semi"), "_id")
                .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"))
        links = stored(full.mapInArrow(_block_links(
            self.shingle, self.percent, self.miss, self.bands, self.rows, first),
            "u long, v long"), "links")
        discard(dealt, own)
        self.connect(links)

    def lead(self, rows: DataFrame) -> DataFrame:
        """Compare the members with one more leader of each bucket."""
        leads = stored(rows.where("not led and label != main").groupBy("key").agg(
            F.min(F.struct("_id", "label")).alias("lead")).select(
                "key", F.col("lead._id").alias("c"), F.col("lead.label").alias("lc")), "bucket-turns")
        pairs = rows.join(leads, "key").where("label != lc")
        self.add(pairs.select(F.least("_id", "c").alias("a"), F.greatest("_id", "c").alias("b")))
        return rows.join(leads, "key").withColumn(
            "led", F.col("led") | (F.col("_id") == F.col("c"))).drop(
                "label", "main", "mains", "members", "c", "lc")

    def run(self) -> DataFrame:
        keyed = self.band_keys()
        for level in range(SPLIT_LEVELS + 1):
            shared = self.star(keyed)
            for leaders in range(ROUNDS + 1):
                few, many = self.mixed(shared)
                if not few.isEmpty():
                    self.across(few, first=level == 0)
                if leaders == ROUNDS or many.isEmpty():
                    break
                shared = stored(self.lead(many), "buckets")
            left = not many.isEmpty()
            if level == 0:
                if not left:
                    return self.labels
                large = many.select("key", "band", "_id")
            if not left or level == SPLIT_LEVELS:
                break
            # split what is left by every later band
            others = self.band_keys().select("_id", F.col("band").alias("other"),
                                             F.col("key").alias("more"))
            keyed = stored(many.join(others, "_id").where("other > band").select(
                "_id", F.col("other").alias("band"), F.xxhash64("key", "more").alias("key")),
                f"split{level}")
        # the pairs that share no later band
        for rows in self.mixed(large):
            if not rows.isEmpty():
                self.across(rows, first=True)
        return self.labels


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS,
                    percent: int = THRESHOLD, miss: float = MISS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_hash: one row for each input
    row. ``kept`` marks the first document of a component."""
    texts = docs.select(id_of(id_col).alias("_id"), text_of(text_col).alias("_text"))
    keyed = texts.withColumn("_h", F.xxhash64("_text"))
    bound_batches(docs.sparkSession)
    signed = stored(keyed.mapInArrow(
        _signatures(shingle, bands * rows),
        "_id long, _h long, n long, s1 long, s2 long, sig binary"), "signatures")
    if not signed.groupBy("_id").count().where("count > 1").isEmpty():
        discard(signed)
        return _numbered(keyed, shingle, bands, rows, percent, miss)
    # classes of equal sets, each with its smallest id
    sets = stored(signed.where("n > 0").groupBy("n", "s1", "s2")
                  .agg(F.min("_id").alias("rep")), "sets")
    member = stored(signed.select("_id", "_h", "n", "s1", "s2")
                    .join(sets, ["n", "s1", "s2"], "left")
                    .select("_id", "_h", "n", F.coalesce("rep", "_id").alias("rep")), "members")
    classes = stored(signed.join(sets.select(F.col("rep").alias("_id")), "_id", "left_semi")
                     .select("_id", "n", "sig"), "classes")
    discard(signed, sets)
    labels = _Search(texts, classes, shingle, bands, rows, percent, miss).run()
    out = member.join(labels, member["rep"] == labels["node"], "left").select(
        "_id", "_h", "n", F.coalesce("component", "rep").alias("component"))
    return out.select(F.nullif(F.col("_id"), F.lit(NO_ID)).alias("doc_id"),
                      F.col("n").alias("n_shingles"),
                      F.nullif(F.col("component"), F.lit(NO_ID)).alias("component_id"),
                      (F.col("_id") == F.col("component")).alias("kept"),
                      F.col("_h").alias("text_hash"))


def _numbered(keyed: DataFrame, *options) -> DataFrame:
    """The search for ids that repeat: distinct (id, text hash) pairs are
    numbered in their order, and the numbers searched in place of the ids."""
    nodes = stored(keyed.groupBy("_id", "_h").agg(F.min("_text").alias("_text")), "texts")
    ranks, ranged = running_total(nodes.select("_id", "_h", F.lit(1).alias("_one")),
                                  ["_id", "_h"], "_one", "_node", "numbers")
    ranks = stored(ranks.select("_id", "_h", "_node"), "numbered")
    discard(ranged)
    found = near_duplicates(nodes.join(ranks, ["_id", "_h"]).select("_node", "_text"),
                            "_node", "_text", *options)
    found = found.select(F.col("doc_id").alias("_node"), "n_shingles",
                         F.col("component_id").alias("_first"), "kept")
    first = ranks.select(F.col("_node").alias("_first"), F.col("_id").alias("_component"))
    judged = stored(ranks.join(found, "_node").join(first, "_first"), "judged")
    return keyed.select("_id", "_h").join(judged, ["_id", "_h"]).select(
        F.nullif(F.col("_id"), F.lit(NO_ID)).alias("doc_id"), "n_shingles",
        F.nullif(F.col("_component"), F.lit(NO_ID)).alias("component_id"), "kept",
        F.col("_h").alias("text_hash"))


def first_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each
    component. Of rows equal in id and text, the one whose columns have the
    smallest hash stays."""
    kept = stored(
        near_duplicates(docs.select(id_col, text_col), id_col, text_col, **options).where("kept")
        .groupBy(F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), F.col("text_hash").alias("_h"))
        .agg(F.count("*").alias("_n")), "kept")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        id_of(id_col).alias("_id"), F.xxhash64(text_of(text_col)).alias("_h"))
    single = keyed.join(kept.where("_n = 1"), ["_id", "_h"], "left_semi").select("row.*")
    repeated = kept.where("_n > 1")
    if repeated.isEmpty():
        return single
    one = (keyed.join(repeated, ["_id", "_h"], "left_semi").groupBy("_id", "_h")
           .agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row")))
    return single.unionByName(one.select("row.*"))
