"""Change feed between two strategy snapshots.

Snapshots hold one row per strategy (primary key). They are versions of one
table (``sources/versions.py``), and all five statements read one difference of
two versions: buckets of equal hash are not read, and the others are joined
once, in full, on the unique key. No fan-out, no hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidmill.functions.timefn import queue_stamp
from bidmill.sources.versions import Manifest, VersionedTable


def strategies_by_algo(current: DataFrame, algos: DataFrame, algo_id: int | None = None) -> DataFrame:
    """Current snapshot with its algorithms; optionally one algorithm."""
    a = algos if algo_id is None else algos.where(F.col("algo_id") == algo_id)
    return a.join(current, "strategy_id")


def _repriced() -> Column:
    return (F.col("change") == "changed") & (
        (F.col("old.baseline_bid") != F.col("new.baseline_bid"))
        | (F.col("old.max_bid") != F.col("new.max_bid")))


def changed(feed: DataFrame) -> DataFrame:
    """In both snapshots with a changed baseline or max bid (NULL = unknown = unchanged)."""
    return feed.where(_repriced()).select("strategy_id")


def new_strategies(feed: DataFrame) -> DataFrame:
    """In the new snapshot, not in the old one."""
    return feed.where(F.col("change") == "new").select("strategy_id")


def deleted_strategies(feed: DataFrame) -> DataFrame:
    """In the old snapshot, not in the new one."""
    return feed.where(F.col("change") == "deleted").select("strategy_id")


def changed_with_algo(feed: DataFrame, algos: DataFrame) -> DataFrame:
    """Changed strategies with their algorithms."""
    return changed(feed).join(algos, "strategy_id").select("strategy_id", "algo_id")


def algos_to_run(feed: DataFrame, algos: DataFrame) -> DataFrame:
    """Distinct algorithms of changed or new strategies."""
    run = feed.where((F.col("change") == "new") | _repriced())
    return run.select("strategy_id").join(algos, "strategy_id").select("algo_id").distinct()


def algo_requests(feed: DataFrame, algos: DataFrame, run_ts) -> DataFrame:
    """Queue rows for the algorithms to run, stamped with the run time."""
    stamp = queue_stamp(run_ts)
    return algos_to_run(feed, algos).select(
        "algo_id", stamp.alias("create_ts"), stamp.alias("update_ts"),
        F.lit("pending").alias("status"))


def assign_algos(algos: VersionedTable, current: DataFrame, algo_ids=(1, 2)) -> Manifest:
    """Add (strategy, algo) for every current strategy and each given algo;
    pairs that the table's primary key has already are left out."""
    return algos.insert(current.select(
        "strategy_id", F.explode(F.array(*[F.lit(a) for a in algo_ids])).alias("algo_id")),
        unique=True)


def distinct_strategy_algo(preds: DataFrame) -> DataFrame:
    """A2: distinct (strategy_id, algo_id) of a predictions table."""
    return preds.select("strategy_id", "algo_id").distinct()
