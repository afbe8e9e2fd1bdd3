"""Connected components of an edge table by alternating star contractions.

Each round replaces a node's links by links to its smallest neighbour, once
for its larger neighbours and once for its smaller ones; the result is a star
round the smallest node of each component. Rounds grow with the logarithm of
the longest path. Minima are pre-aggregated before the shuffle and joined back
from stored tables, so a node with very many links is split by the skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidmill.llm.store import discard, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (u, v) with u > v. Large star: v's and u's neighbours above a
    node go to the node's smallest neighbour (or itself); small star: those
    below it."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    least = stored(both.groupBy("u").agg(F.min("v").alias("m"))
                   .select("u", F.least("u", "m").alias("m")), "star-min")
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    result = stored(out.where("u > v").distinct(), "star-edges")
    discard(least)
    return result


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v) that is not its
    component's smallest. Self links and repeated links are allowed."""
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .where("u > v").distinct(), "edges")

    def mark(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = mark(now)
    while before[0]:
        large = _star(now, True)
        after = _star(large, False)
        discard(now, large)
        now, count = after, mark(after)
        if count == before:
            break
        before = count
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
