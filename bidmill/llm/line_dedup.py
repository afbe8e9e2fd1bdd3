"""Line dedup over a suffix array of line-ID sequences.

1. A line's ID is its 64-bit hash; only non-blank lines count. Lines that occur
   once in the corpus can't lie in a repeated run and are left out.
2. Distributed prefix doubling: a suffix's rank for its first ``2h`` lines
   comes from the ranks of its first ``h`` lines and of the suffix ``h`` lines
   on. Rank = number of suffixes that sort before, a running total over the
   distinct rank pairs, so equal ranks are an interval of the suffix array
   whose common prefix has that length. Suffixes alone in their interval are
   dropped each round (their longest common prefix is below ``2h``), and the
   rounds end when none is left. The step that reaches ``min_lines`` is
   shortened so that the shortest run is exactly that long.
3. In each interval the first suffix (by doc_id, then line) stays; the others
   start later copies of it. A suffix keeps its deepest interval. Suffixes whose
   lines move in step with those of one earlier text join to a repeated run:
   start, length and first copy. A line is in a later copy of ``min_lines``
   lines exactly if it is in such a run, and the lines of all runs are deleted.
   A single line of ``min_chars`` or more is a run as well.

Intervals are counted before the shuffle and joined from stored tables, so a
line held by a third of the rows is split by AQE's skew join.

Defined cases: a NULL or empty text has no lines; blank lines never belong to a
run and are kept; rows that repeat a doc_id are ordered by the hash of their
text, and equal rows stand and fall together; a NULL doc_id counts as the
smallest id; a very long text takes one round more for each doubling of its
repeated part, and only its runs, not its lines, meet in the task that cuts it;
an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidmill.llm.store import WORD, discard, id_of, running_total, stored, text_of
from bidmill.session import bound_batches

MIN_LINES = 2
MIN_CHARS = 100
_PLACE = ["_id", "_h", "line"]


def numbered_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _h, line, key, chars): non-blank lines, numbered within the text."""
    text = text_of(text_col)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return (docs.select(id_of(id_col).alias("_id"), F.xxhash64(text).alias("_h"),
                        F.posexplode(lines).alias("line", "_line"))
            .select("_id", "_h", "line", F.xxhash64("_line").alias("key"),
                    F.length("_line").alias("chars")))


def _ranked(suffixes: DataFrame, keys: list[str], name: str, first: bool = True) -> DataFrame:
    """Suffixes that share ``keys`` with another, with ``rank``, the place of
    their interval in the suffix array, and ``first``, its smallest suffix."""
    least = [F.min(F.struct(*_PLACE)).alias("first")] if first else []
    many = suffixes.groupBy(*keys).agg(F.count("*").alias("_n"), *least).where("_n > 1")
    ranks, ranged = running_total(many, keys, "_n", "rank", f"{name}-ranks")
    ranks = stored(ranks.drop("_n"), f"{name}-intervals")
    out = stored(suffixes.join(ranks, keys).drop(*keys), f"{name}-suffixes")
    discard(ranged, ranks)
    return out


def later_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """(_id, _h, line, lines, first): for each doubled length, the suffixes
    that share it with an earlier one, and the first of those."""
    single = _ranked(numbered_lines(docs, id_col, text_col), ["key"], "lines", first=False)
    alone = single if min_lines <= 1 else single.where(F.col("chars") >= min_chars)
    least = stored(alone.groupBy("rank").agg(F.min(F.struct(*_PLACE)).alias("first")),
                   "first-lines")

    def later(suffixes, length):
        return stored(suffixes.where(F.struct(*_PLACE) > F.col("first")).select(
            *_PLACE, F.lit(length).alias("lines"), "first"), f"later{length}")

    found = later(alone.join(least, "rank"), 1)
    # equal rows have equal places: once each from here on
    now, length = stored(single.select(*_PLACE, "rank").distinct(), "prefix1"), 1
    discard(single, least)
    while not now.isEmpty():
        step = min(length, min_lines - length) if length < min_lines else length
        ahead = now.select("_id", "_h", (F.col("line") - step).alias("line"),
                           F.col("rank").alias("next"))
        wider = now.select(*_PLACE, F.col("rank").alias("own")).join(ahead, _PLACE)
        length += step
        longer = _ranked(wider, ["own", "next"], f"prefix{length}")
        discard(now)
        now = longer
        if length >= min_lines:
            found = found.unionByName(later(now, length))
    return found


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """(_id, _h, start, length, first_id, first_h, first_line): the runs of
    lines that an earlier text, or an earlier place of the same one, holds."""
    found = later_copies(docs, id_col, text_col, min_lines, min_chars).repartition("_id", "_h")
    deep = (found.groupBy(*_PLACE).agg(F.max(F.struct("lines", "first")).alias("m"))
            .select(*_PLACE, (F.col("line") + F.col("m.lines")).alias("end"),
                    F.col("m.first._id").alias("first_id"), F.col("m.first._h").alias("first_h"),
                    (F.col("m.first.line") - F.col("line")).alias("shift")))
    aligned = ["_id", "_h", "first_id", "first_h", "shift"]
    ordered = Window.partitionBy(*aligned).orderBy("line")
    before = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("line") <= before, 0).otherwise(1)
    return (deep.withColumn("_new", begins).withColumn("_run", F.sum("_new").over(ordered))
            .groupBy(*aligned, "_run")
            .agg(F.min("line").alias("start"), F.max("end").alias("end"))
            .select("_id", "_h", "start", (F.col("end") - F.col("start")).alias("length"),
                    "first_id", "first_h", (F.col("start") + F.col("shift")).alias("first_line")))


_CUT = T.StructType([T.StructField("text", T.StringType()), *[
    T.StructField(c, T.IntegerType()) for c in ("lines", "removed", "runs")]])


@F.pandas_udf(_CUT)
def _cut(texts: pd.Series, starts: pd.Series, lengths: pd.Series) -> pd.DataFrame:
    out = []
    for text, at, size in zip(texts, starts, lengths):
        lines = text.split("\n")
        full = [i for i, x in enumerate(lines) if x.strip(" \t\n\x0b\x0c\r")]
        gone = np.zeros(len(full) + 1, dtype=np.int64)
        if at is not None:
            at = np.asarray(at, dtype=np.int64)
            np.add.at(gone, at, 1)
            np.add.at(gone, at + np.asarray(size, dtype=np.int64), -1)
        gone = np.cumsum(gone)[:-1] > 0
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        drop = {full[i] for i in np.flatnonzero(gone)}
        out.append((text if not drop else
                    "\n".join(x for i, x in enumerate(lines) if i not in drop),
                    len(full), len(drop), runs))
    return pd.DataFrame(out, columns=["text", "lines", "removed", "runs"])


# a filter on what is left would else run it a second time, in workers of its own
_cut = _cut.asNondeterministic()


def remove_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """All rows of ``docs`` as struct ``row``, and ``cut``: the text that is
    left, the number of lines and removed lines, and the deleted maximal runs."""
    bound_batches(docs.sparkSession)
    gone = stored(repeated_runs(docs, id_col, text_col, min_lines, min_chars)
                  .groupBy("_id", "_h").agg(F.collect_list("start").alias("_at"),
                                            F.collect_list("length").alias("_size")),
                  "later-lines")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        id_of(id_col).alias("_id"), F.xxhash64(text_of(text_col)).alias("_h"),
                        text_of(text_col).alias("_text"))
    # texts move once at every size: a broadcast of the runs while they are few
    # would give way to this plan anyway
    return keyed.join(gone.hint("merge"), ["_id", "_h"], "left").select(
        "row", _cut("_text", "_at", "_size").alias("cut"))
