"""Runs of words that repeat with a period, and texts without the repeats.

A run is a stretch of words with smallest period q (words q apart are equal),
at least ``exponent * q`` and at least ``min_length`` words long, that neither
neighbour extends.

Each word is appended to a suffix automaton. The prefix that it ends is then
accessed as in a link-cut tree: the path of suffix links to the root takes the
new end as last occurrence. Nodes of one last occurrence form a path, kept as
a segment of suffix lengths: of prefix x, the lengths above ``cut[x]`` still
end last at x, shorter ones went to the access ``cutter[x]`` or a later one. An
access walks such segments downwards. If the lengths up to m ended last at x
before and the new end is i, then the m words before x equal the m words before
i; with the distance i - x within m they overlap or touch and the stretch from
x - m to i is a square of period i - x or more. m is the longest such suffix,
so the stretch can't be extended to the left, and the last i that gives the
same start and period is its right end: squares with the same start and period
are one run. An earlier copy at a smaller distance would be the last occurrence
instead, so the period is the smallest.

A run of at least ``exponent`` periods repeats its first windows one period
later. Words outside stretches of repeated windows (by hash, so that no equal
window is missed) belong to no run; the automaton reads the other words, as
exact ids, each stretch with a margin that holds its runs whole.

Every text is handled by itself, in one task; no shuffle, nothing is collected.

Defined cases: a NULL text is empty; an empty text, or one of fewer than
``min_length`` words, has no runs; in a very long text the automaton's memory
follows its repeated stretches (about 1 KB a word); ties between runs don't
matter, all are returned; repeated rows and rows without an id are rows of
their own; an empty table gives an empty result; other columns, whatever their
names, come back in ``row``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidmill.llm import textscan as ts
from bidmill.llm.store import text_of

MIN_LENGTH = 24
EXPONENT = 3
PASSES = 4           # narrowing passes of the window test
OUT_BYTES = 8 << 20  # texts of an output batch

FIELDS = ("start", "length", "period")
RUN_TYPE = pa.struct([(f, pa.int64()) for f in FIELDS])
RUNS = T.ArrayType(T.StructType([T.StructField(f, T.LongType()) for f in FIELDS]))


def squares(items: list[int], least: int, exponent: int) -> dict[tuple[int, int], int]:
    """{(start, period): end} of the stretches of at least ``exponent`` periods
    whose repeated suffix has ``least`` words or more."""
    n = len(items)
    after: list[dict[int, int]] = [{}]
    link, size, seen = [-1], [0], [0]      # by state; seen: an end on whose path it lies
    cut, cutter = [0] * (n + 1), [0] * (n + 1)   # by prefix
    found: dict[tuple[int, int], int] = {}
    last = 0
    for i, c in enumerate(items, 1):
        state = len(after)
        after.append({})
        size.append(i)
        seen.append(i)
        p = last
        while p >= 0 and c not in after[p]:
            after[p][c] = state
            p = link[p]
        up = 0
        if p >= 0:
            up = after[p][c]
            if size[up] != size[p] + 1:
                whole, up = up, state + 1
                after.append(dict(after[whole]))
                size.append(size[p] + 1)
                seen.append(seen[whole])
                while p >= 0 and after[p].get(c) == whole:
                    after[p][c] = up
                    p = link[p]
        link.append(up)
        if up > state:      # the state that was split hangs below its copy
            link.append(link[whole])
            link[whole] = up
        last = state
        m = size[up]
        if m < least:       # shorter suffixes give no run: their segments aren't kept
            continue
        x = seen[up]
        seen[up] = i
        while m >= least:
            while m <= cut[x]:
                x = cutter[x]
            if m >= (exponent - 1) * (i - x):
                found[x - m, i - x] = i
            below, then = cut[x], cutter[x]
            cut[x], cutter[x] = m, i
            m, x = below, then
    return found


def stretches(hashes: np.ndarray, least: int, exponent: int) -> list[tuple[int, int]]:
    """Disjoint word ranges that hold every run, each with a word of margin."""
    n = len(hashes)
    if n < least + 1:
        return []
    windows = ts.run_hashes(hashes, least)
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    again = np.flatnonzero(ranked[1:] == ranked[:-1])
    if not len(again):
        return []
    gap = np.zeros(len(windows), dtype=np.int64)
    gap[order[again + 1]] = order[again + 1] - order[again]
    # of a run, all windows but those that start in its first period repeat at
    # the period's distance or less, so a stretch of s windows holds periods of
    # at most (s + least - 1) / (exponent - 1)
    for _ in range(PASSES):
        at = np.flatnonzero(gap)
        if not len(at):
            return []
        first = np.concatenate(([True], np.diff(at) > 1))
        which = np.cumsum(first) - 1
        most = (np.bincount(which) + least - 1) // (exponent - 1)
        far = gap[at] > most[which]
        if not far.any():
            break
        gap[at[far]] = 0
    at = np.flatnonzero(gap)
    if not len(at):
        return []
    first = np.concatenate(([True], np.diff(at) > 1))
    start, count = at[first], np.bincount(np.cumsum(first) - 1)
    lo = np.maximum(start - (count + least - 1) // (exponent - 1) - 1, 0)
    hi = np.minimum(start + count + least, n)
    out: list[tuple[int, int]] = []
    for a, b in zip(lo.tolist(), hi.tolist()):
        while out and a <= out[-1][1]:
            before = out.pop()
            a, b = min(a, before[0]), max(b, before[1])
        out.append((a, b))
    return out


def runs_of(words: list[bytes], min_length: int = MIN_LENGTH,
            exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the words, by start and period."""
    if len(words) < min_length:
        return []
    least = -(-min_length * (exponent - 1) // exponent)
    hashes = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    out = []
    for lo, hi in stretches(hashes, least, exponent):
        ids: dict[bytes, int] = {}
        items = [ids.setdefault(w, len(ids)) for w in words[lo:hi]]
        out += [(lo + start, end - start, period)
                for (start, period), end in squares(items, least, exponent).items()
                if end - start >= min_length]
    return sorted(out, key=lambda r: (r[0], r[2]))


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words that no run contains after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def _collapsing(min_length: int, exponent: int):
    def run(batches):
        for batch in batches:
            texts = batch.column("_text").cast(pa.large_binary())
            rows, done, size = [], 0, 0
            for k, text in enumerate(texts):
                words = text.as_py().split()
                found = runs_of(words, min_length, exponent)
                kept = b" ".join(without_repeats(words, found))
                rows.append((len(words), found, kept))
                size += len(kept)
                if size >= OUT_BYTES or k + 1 == len(texts):
                    yield pa.RecordBatch.from_arrays([
                        batch.column("row").slice(done, len(rows)),
                        pa.array([r[0] for r in rows], pa.int64()),
                        pa.array([[dict(zip(FIELDS, x)) for x in r[1]]
                                  for r in rows], pa.list_(RUN_TYPE)),
                        pa.array([r[2] for r in rows], pa.large_binary()).cast(
                            pa.large_string()).cast(pa.string())],
                        names=["row", "n_words", "runs", "text"])
                    rows, done, size = [], k + 1, 0
    return run


def collapse_runs(docs: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH,
                  exponent: int = EXPONENT) -> DataFrame:
    """row (the other columns), n_words, runs (start, length, period, by start
    and period) and text: the words without the repeats, joined by one space."""
    if exponent < 2 or min_length < 2:
        raise ValueError("a run has at least two periods and two words")
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    row = F.struct(*rest) if rest else F.struct(F.lit(None).cast("string").alias("_none"))
    data = docs.select(row.alias("row"), text_of(text_col).alias("_text"))
    schema = T.StructType([data.schema["row"], T.StructField("n_words", T.LongType()),
                           T.StructField("runs", RUNS), T.StructField("text", T.StringType())])
    return data.mapInArrow(_collapsing(min_length, exponent), schema)
