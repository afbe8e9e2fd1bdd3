"""Pricing functions of the user's own (D1, D2), and line fits (M1, M3, M4).

A pricing function looks at a group (a strategy, or a request) and prices its
rows. It is declared in three parts, so that no group is ever one task: what
each row adds to the group's state, how states merge, and how a row is priced
once the state is known.

- ``GroupPricing`` declares the state as Spark aggregates (which merge by
  themselves) and the prices as expressions over the row and the state. State
  may be given in passes; a later one may use the columns of the earlier ones.
- ``PandasPricing`` declares three vectorised functions: ``map`` (rows -> one
  state row for each group), ``merge`` (state rows -> one for each group) and
  ``finish`` (rows with their group's state -> multiplier and baseline). A task
  maps its batches and merges the states as it goes, so a group has one state
  row for each task; those meet in one cell, whatever the group's size.

``register_pricing`` adds either to the names that the dequeue job takes.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidmill.operators import pricing as P
from bidmill.session import written

PRICED = ("multiplier", "baseline")


def _with_state(rows: DataFrame, state: DataFrame, keys: Sequence[str], small: bool) -> DataFrame:
    """The group's state on its rows. Written first unless it is small: the
    join's exchanges are then right below it, and AQE splits a hot group."""
    return rows.join(F.broadcast(state) if small else written(state, "pricing-state"), list(keys))


def _column(c: Column | str) -> Column:
    return F.expr(c) if isinstance(c, str) else c


@dataclasses.dataclass(frozen=True)
class GroupPricing:
    """``passes``: aggregates by name, pass by pass; ``multiplier`` and
    ``baseline``: expressions over a row's columns and its group's state.
    All as columns or as SQL text, which needs no session yet."""
    passes: Sequence[dict[str, Column | str]]
    multiplier: Column | str
    baseline: Column | str

    def __call__(self, scored: DataFrame, keys: Sequence[str] = ("strategy_id",),
                 small_groups: bool = False) -> DataFrame:
        rows = scored
        for state in self.passes:
            taken = set(state) & set(rows.columns)
            if taken:
                raise ValueError(f"the rows have columns named like the state: {sorted(taken)}")
            made = rows.groupBy(*keys).agg(
                *[_column(a).alias(name) for name, a in state.items()])
            rows = _with_state(rows, made, keys, small_groups)
        return rows.select(*scored.columns, *[_column(getattr(self, c)).cast("double").alias(c)
                                              for c in PRICED])


@dataclasses.dataclass(frozen=True)
class PandasPricing:
    """``state``: the columns of a state row; ``map`` and ``merge`` take a
    pandas DataFrame and the key names and return keys and state, ``finish``
    returns a DataFrame of multiplier and baseline."""
    state: T.StructType
    map: Callable[[pd.DataFrame, list[str]], pd.DataFrame]
    merge: Callable[[pd.DataFrame, list[str]], pd.DataFrame]
    finish: Callable[[pd.DataFrame], pd.DataFrame]

    def __call__(self, scored: DataFrame, keys: Sequence[str] = ("strategy_id",),
                 small_groups: bool = False) -> DataFrame:
        keys, state_map, merge, finish = list(keys), self.map, self.merge, self.finish
        columns = keys + self.state.fieldNames()
        schema = T.StructType([*[scored.schema[k] for k in keys], *self.state.fields])
        out = T.StructType([*scored.schema.fields,
                            *[T.StructField(c, T.DoubleType()) for c in PRICED]])
        names = scored.columns

        def partial(batches):
            held = None
            for rows in batches:
                if not len(rows):
                    continue
                made = state_map(rows, keys)[columns]
                held = made if held is None else merge(pd.concat([held, made]), keys)[columns]
            if held is not None:
                yield held

        def merged(states: pd.DataFrame) -> pd.DataFrame:
            return merge(states, keys)[columns]

        def price(batches):
            for rows in batches:
                if len(rows):
                    yield pd.concat([rows[names], finish(rows)[list(PRICED)]], axis=1)

        states = scored.mapInPandas(partial, schema).groupBy(*keys).applyInPandas(merged, schema)
        return _with_state(scored, states, keys, small_groups).mapInPandas(price, out)


def register_pricing(name: str, pricing: Callable[..., DataFrame]) -> None:
    """Make a pricing function known to ``price_requests`` by its name."""
    if name in P.PRICING:
        raise ValueError(f"pricing {name!r} is registered already")
    P.PRICING[name] = pricing


def unregister_pricing(name: str) -> None:
    P.PRICING.pop(name, None)


def line_fit(price: Column, weight: Column | None = None, floor: float = P.PRICE_FLOOR
             ) -> GroupPricing:
    """Weighted least squares of ``price`` on the score, any number of points
    for a group; the multiplier is the line's price over the floor. The sums
    are taken about the group's means, so nothing cancels. Points without a
    score, a price or a positive weight don't count; a group with one distinct
    score is priced at its mean, and one without points has no price. The line
    of the active pricing function is the case of two points."""
    x = F.nanvl(F.col("probability_score"), F.lit(None).cast("double"))
    y = F.nanvl(price.cast("double"), F.lit(None).cast("double"))
    w = F.lit(1.0) if weight is None else weight.cast("double")
    w = F.when(x.isNotNull() & y.isNotNull() & (w > 0), w)
    means = {"_w": F.sum(w), "_x": F.sum(w * x) / F.sum(w), "_y": F.sum(w * y) / F.sum(w),
             "_lo": F.min(F.when(w.isNotNull(), x)), "_hi": F.max(F.when(w.isNotNull(), x))}
    dx, dy = x - F.col("_x"), y - F.col("_y")
    sums = {"_xx": F.sum(w * dx * dx), "_xy": F.sum(w * dx * dy)}
    slope = F.when(F.col("_lo") < F.col("_hi"), F.try_divide("_xy", "_xx")).otherwise(0.0)
    at = F.col("_y") + F.when(F.col("_lo") < F.col("_hi"),
                              slope * (F.col("probability_score") - F.col("_x"))).otherwise(0.0)
    return GroupPricing([means, sums], at / floor, F.lit(floor))
