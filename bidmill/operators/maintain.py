"""Stored prices kept up to date from the edits of their sources (U2, U3 into J2, A1, J1, M1, K1).

A rebuild joins every strategy to every domain of its line. Here the versions
of the strategy inputs and of the line predictions say what was edited since
the prices were last made, and only that runs through the plan again:

1. strategies whose input row differs, and strategies on a line whose
   predictions differ, are affected (from buckets of unequal hash alone);
2. their lines' predictions are read, bucket by bucket, and their candidates,
   bounds and prices are made by the same functions as in a rebuild;
3. the affected strategies' rows are replaced in the stored table, whose other
   buckets keep their files. A strategy that was deleted, or has no candidates
   any more, loses its rows.

The source versions that the prices reflect are committed with them, so a
refresh that dies is simply done again, and of two that run at once one wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidmill.joins import broadcast_if_small, is_small
from bidmill.operators import candidates as C
from bidmill.operators import pricing as P
from bidmill.session import written
from bidmill.sources.versions import Manifest, VersionedTable

BUCKETS = 64


def priced(inputs: DataFrame, lines: DataFrame, predictions: DataFrame, sites: DataFrame,
           pricing: str = "target_ecpm_seed_dampen") -> DataFrame:
    """Priced candidates of some strategies: strategy_id, site_domain_id,
    probability_score, algo_id, multiplier, baseline."""
    scored = written(P.scored_inputs(C.candidates(inputs, lines, predictions, sites), inputs),
                     "scored")
    out = P.PRICING[pricing](scored, small_groups=is_small(
        inputs.select("strategy_id", "min_bid", "max_bid", "target_ecpm")))
    return out.select("strategy_id", "site_domain_id", "probability_score", "algo_id",
                      "multiplier", "baseline")


def build(path: str, inputs: VersionedTable, predictions: VersionedTable, lines: DataFrame,
          sites: DataFrame) -> VersionedTable:
    """The stored prices of the newest sources, keyed by strategy."""
    i, p = inputs.manifest().version, predictions.manifest().version
    return VersionedTable.create(priced(inputs.read(i), lines, predictions.read(p), sites), path,
                                 ["strategy_id"], BUCKETS, {"inputs": i, "predictions": p})


def affected(inputs: VersionedTable, predictions: VersionedTable, since: dict[str, int],
             now: dict[str, int]) -> DataFrame:
    """strategy_id of the strategies that an edit reaches."""
    edited = inputs.changed_keys(since["inputs"], now["inputs"])
    lines = predictions.changed_keys(since["predictions"], now["predictions"])
    on_line = inputs.read(now["inputs"]).join(broadcast_if_small(lines), "line_id", "left_semi")
    return edited.unionByName(on_line.select("strategy_id")).distinct()


def refresh(prices: VersionedTable, inputs: VersionedTable, predictions: VersionedTable,
            lines: DataFrame, sites: DataFrame) -> Manifest:
    """Bring the stored prices to the newest versions of their sources."""
    def attempt(m: Manifest) -> Manifest:
        now = {"inputs": inputs.manifest().version, "predictions": predictions.manifest().version}
        if now == m.notes:
            return m
        which = written(affected(inputs, predictions, m.notes, now), "affected")
        rows = written(inputs.read_keys(now["inputs"], which), "affected-inputs")
        used = written(predictions.read_keys(now["predictions"], rows.select("line_id")),
                       "affected-predictions")
        new = written(priced(rows, lines, used, sites), "affected-prices")
        return prices.edit(
            lambda df: df.join(broadcast_if_small(which), "strategy_id", "left_anti")
            .unionByName(new), "refresh", keys=which, base=m, serial=True, notes=now)
    return prices.attempts(attempt)
