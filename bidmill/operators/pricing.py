"""Score -> price mapping per strategy (J1, M1-M5, A4, A5, W2); P12 is in pricefile.price_entries.

Each pricing function takes scored rows (keys, site_domain_id,
probability_score, target_ecpm, min_bid, max_bid) and returns them with
``multiplier`` and ``baseline``. The per-group constants (score bounds,
target, mean) come from a partially aggregated ``groupBy`` joined back on the
group key: the aggregate has one row per strategy. It is broadcast when the
caller has found it small, and written first otherwise, so that the join's
exchanges are right below its sorts and AQE can split a hot strategy. The
candidate rows are never buffered per group, which a whole-partition window
would do.

The reference fits a least-squares line through 50 evenly spaced points from
(min score, floor) to (max score, target); those points lie on one line, so
the fit is that line, and with one distinct score the prediction is the mean
of the two end prices. The closed form below is that result.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidmill.joins import DEFAULT_MAX_BYTES, broadcast_if_small
from bidmill.session import written

# Fixed value that must equal the reference's: the price floor of the active
# pricing function (also its baseline).
PRICE_FLOOR = 0.3

# missing-target rule: "legacy" keeps the -1.0 the request text produces;
# "default" prices a missing target as 1.0
MISSING_TARGET = {"legacy": -1.0, "default": 1.0}


def scored_inputs(cands: DataFrame, inputs: DataFrame, keys=("strategy_id",),
                  missing_target: str = "legacy", extra: tuple[str, ...] = (),
                  max_broadcast: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """Candidates with their strategy's target and bid bounds (inner join),
    plus any ``extra`` input columns. Inputs within the broadcast bound move
    to the candidates, which then aren't shuffled by strategy."""
    target = F.col("target_ecpm")
    if missing_target == "default":
        target = F.when(target == MISSING_TARGET["legacy"], F.lit(1.0)).otherwise(
            F.coalesce(target, F.lit(1.0)))
    else:
        # a NULL target in the table itself is defaulted to 1 (COALESCE in the join)
        target = F.coalesce(target, F.lit(1.0))
    inp = inputs.select(*keys, target.alias("target_ecpm"), "min_bid", "max_bid", *extra)
    return cands.join(broadcast_if_small(inp, max_broadcast), list(keys))


def _clean_score() -> Column:
    # NaN sorts above every number in Spark; the reference's min/max skip it
    return F.nanvl(F.col("probability_score"), F.lit(None).cast("double"))


def _line(lo: Column, hi: Column, y0: Column, y1: Column) -> Column:
    """Price on the line (lo, y0) -> (hi, y1) at the row's score (M4)."""
    s = F.col("probability_score")
    return F.when(hi == lo, (y0 + y1) / 2).otherwise(y0 + (y1 - y0) * (s - lo) / (hi - lo))


def score_bounds(scored: DataFrame, keys=("strategy_id",)) -> DataFrame:
    """A4: per-group min/max score, min target, min min_bid, max max_bid, mean score."""
    s = _clean_score()
    return scored.groupBy(*keys).agg(
        # the mean takes NaN scores along, as the reference's does
        F.min(s).alias("lo"), F.max(s).alias("hi"), F.avg("probability_score").alias("av"),
        F.min("target_ecpm").alias("t"),
        F.min("min_bid").alias("mn"), F.max("max_bid").alias("mx"))


def _with_bounds(scored: DataFrame, keys, small_groups: bool = False) -> DataFrame:
    """Attach the group constants. ``small_groups`` says the caller has
    checked the number of groups (at most the inputs' row count) against the
    broadcast bound. Otherwise the bounds are written first: joined straight
    back, the aggregate would sit between the exchange and the sort, and AQE
    couldn't split a hot group."""
    bounds = score_bounds(scored, keys)
    bounds = F.broadcast(bounds) if small_groups else written(bounds, "score-bounds")
    return scored.join(bounds, list(keys))


def price_dampen(scored: DataFrame, keys=("strategy_id",), floor: float = PRICE_FLOOR,
                 small_groups: bool = False) -> DataFrame:
    """M1 (the active function): multiplier = line(score) / floor; baseline = floor."""
    f = F.lit(floor)
    b = _with_bounds(scored, keys, small_groups)
    price = _line(F.col("lo"), F.col("hi"), f, F.col("t"))
    return b.select(*scored.columns, (price / f).alias("multiplier"), f.alias("baseline"))


def price_mean_seed(scored: DataFrame, keys=("strategy_id",), small_groups: bool = False) -> DataFrame:
    """M2: multiplier = score / mean score; baseline = target * mean / max."""
    b = _with_bounds(scored, keys, small_groups)
    return b.select(*scored.columns,
                    F.try_divide(F.col("probability_score"), F.col("av")).alias("multiplier"),
                    F.try_divide(F.col("t") * F.col("av"), F.col("hi")).alias("baseline"))


def price_min_max(scored: DataFrame, keys=("strategy_id",), small_groups: bool = False) -> DataFrame:
    """M3: the price itself on the line (lo, min min_bid) -> (hi, max max_bid); no baseline."""
    b = _with_bounds(scored, keys, small_groups)
    return b.select(*scored.columns,
                    _line(F.col("lo"), F.col("hi"), F.col("mn"), F.col("mx")).alias("multiplier"),
                    F.lit(None).cast("double").alias("baseline"))


# pluggable pricing: name -> function(scored, keys) -> priced
PRICING: dict[str, Callable[..., DataFrame]] = {
    "target_ecpm_seed_dampen": price_dampen,
    "target_ecpm_seed": price_mean_seed,
    "min_max_bid": price_min_max,
}
