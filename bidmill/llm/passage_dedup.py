"""Substring dedup: passages that repeat across documents, by anchors at
difference-cover positions.

A window is ``window`` consecutive words. For a period p, the cover D holds a
pair of residues with every difference modulo p, so for two copies of a window
at any word positions i and j some shift s < p puts both i + s and j + s on
cover positions. Hashing only the ``window - p + 1`` words from cover positions
(3 of 7) therefore gives every pair of equal windows an aligned anchor.

1. Anchors are counted by their smallest and largest document; those of one
   document are dropped.
2. Each document's windows round a repeated anchor are extended to the full
   window, hashed.
3. A window whose smallest document is not its own is a later copy; the words
   of all such windows go.

All work is keyed by hashes, pre-aggregated before the shuffle, and joins read
stored tables on both sides, so a passage held by a third of the documents is
split by AQE's skew join. No pairs of documents are formed.

Defined cases: a NULL text has no words; a NULL doc_id counts as the smallest
id; rows that repeat a doc_id are judged one by one and are never each other's
copies; fewer than ``window`` words: nothing is removed; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidmill.llm import textscan as ts
from bidmill.llm.store import discard, id_of, stored, text_of

WINDOW = 13
PERIOD = 7


def difference_cover(period: int) -> list[int]:
    """Small set of residues whose differences give every residue (greedy)."""
    cover, reached = [0], {0}
    while len(reached) < period:
        def gain(c):
            return len({(c - x) % period for x in cover} | {(x - c) % period for x in cover}
                       | reached)
        best = max((c for c in range(period) if c not in cover), key=lambda c: (gain(c), -c))
        cover.append(best)
        reached = {(a - b) % period for a in cover for b in cover}
    return sorted(cover)


def _anchors(window: int, period: int, with_position: bool):
    cover, length = np.array(difference_cover(period)), window - period + 1

    def run(batches):
        for batch in batches:
            ids = batch.column("_id").to_numpy()
            for row, buf, off in ts.blocks(batch.column("_text")):
                starts, ends, first = ts.words(buf, off)
                found = ts.run_hashes(ts.span_hashes(buf, starts, ends), length)
                counts = np.diff(first)
                doc = np.repeat(np.arange(len(counts)), counts)
                at = np.arange(len(starts)) - np.repeat(first[:-1], counts)
                # windows of a document of at least `window` words only
                use = np.isin(at % period, cover) & (at + length <= counts[doc]) \
                    & (counts[doc] >= window)
                use = np.flatnonzero(use)
                cols = [pa.array(found[use].view(np.int64)), pa.array(ids[row + doc[use]])]
                names = ["anchor", "_id"]
                if with_position:
                    cols.append(pa.array(at[use].astype(np.int32)))
                    names.append("at")
                yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def _windows(window: int, period: int):
    """Hash the windows round the repeated anchors of each document."""
    def run(batches):
        for batch in batches:
            ids, hashes = batch.column("_id").to_numpy(), batch.column("_h").to_numpy()
            hits = batch.column("hits")
            hit_off = hits.offsets.to_numpy().astype(np.int64)
            hit_at = hits.values.to_numpy().astype(np.int64)
            for row, buf, off in ts.blocks(batch.column("_text")):
                starts, ends, first = ts.words(buf, off)
                whole = ts.run_hashes(ts.span_hashes(buf, starts, ends), window)
                counts = np.diff(first)
                n = len(counts)
                near = np.zeros(len(starts) + 1, dtype=np.int64)
                own = hit_off[row:row + n + 1]
                doc = np.repeat(np.arange(n), np.diff(own))
                at = hit_at[own[0]:own[-1]]
                fits = at < counts[doc]
                doc, at = doc[fits], at[fits]
                # windows that start up to period - 1 words before the anchor
                lo = first[doc] + np.maximum(at - (period - 1), 0)
                hi = first[doc] + np.minimum(at, counts[doc] - window) + 1
                good = lo < hi
                np.add.at(near, lo[good], 1)
                np.add.at(near, hi[good], -1)
                pick = np.flatnonzero(np.cumsum(near)[:-1] > 0)
                doc = np.searchsorted(first, pick, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(whole[pick].view(np.int64)), pa.array(ids[row + doc]),
                     pa.array(hashes[row + doc]),
                     pa.array((pick - first[doc]).astype(np.int32))],
                    names=["window", "_id", "_h", "start"])
    return run


def _without(window: int):
    def run(batches):
        for batch in batches:
            texts, gone = batch.column("_text"), batch.column("gone")
            n_words, n_removed, kept = [], [], []
            for text, starts in zip(texts, gone):
                tokens = (text.as_py() or "").encode().split()
                drop = np.zeros(len(tokens) + 1, dtype=np.int64)
                if starts.is_valid:
                    at = np.unique(starts.values.to_numpy())
                    drop[at] += 1
                    np.add.at(drop, at + window, -1)
                drop = np.cumsum(drop)[:-1] > 0
                n_words.append(len(tokens))
                n_removed.append(int(drop.sum()))
                left = [w for w, d in zip(tokens, drop) if not d] if drop.any() else tokens
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), pa.array(n_words, pa.int64()),
                 pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"])
    return run


def remove_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                             window: int = WINDOW, period: int = PERIOD) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by a space)."""
    if not 1 <= period <= window:
        raise ValueError("period must lie between 1 and the window")
    keyed = docs.select(F.col(id_col).cast("long").alias("_key"), id_of(id_col).alias("_id"),
                        text_of(text_col).alias("_text"))
    slim = keyed.select("_id", "_text")
    # anchors held by at least two documents
    repeated = stored(
        slim.mapInArrow(_anchors(window, period, False), "anchor long, _id long")
        .groupBy("anchor").agg(F.min("_id").alias("lo"), F.max("_id").alias("hi"))
        .where("lo < hi").select("anchor"), "anchors")
    hits = stored(
        slim.mapInArrow(_anchors(window, period, True), "anchor long, _id long, at int")
        .join(repeated, "anchor").groupBy("_id").agg(F.collect_list("at").alias("hits")), "hits")
    windows = stored(
        slim.join(hits, "_id").withColumn("_h", F.xxhash64("_text"))
        .mapInArrow(_windows(window, period), "window long, _id long, _h long, start int"),
        "windows")
    discard(repeated, hits)
    first = stored(windows.groupBy("window").agg(F.min("_id").alias("lo"), F.max("_id").alias("hi"))
                   .where("lo < hi").select("window", "lo"), "first-windows")
    gone = stored(windows.join(first, "window").where("_id > lo")
                  .groupBy("_id", "_h").agg(F.collect_list("start").alias("gone")), "later-windows")
    discard(windows, first)
    return (keyed.withColumn("_h", F.xxhash64("_text")).join(gone, ["_id", "_h"], "left")
            .select("_key", "_text", "gone")
            .mapInArrow(_without(window),
                        "doc_id long, n_words long, n_removed long, kept_text string"))
