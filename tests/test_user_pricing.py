"""Declared pricing functions and line fits."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidmill.operators import pricing as P
from bidmill.operators import user_pricing as UP
from bidmill.plans import dequeue as DQ
from bidmill.plans.pricing_q import MEAN_SEED
from bidmill.sources import fixtures as X

SMALL = "/root/testdata/sf0.001"
SCORED = ("strategy_id long, site_domain_id long, probability_score double, target_ecpm double, "
          "min_bid double, max_bid double, paid double, seen long")


def _skewed(spark):
    """One strategy with most of the rows, one with a single score, one with NULLs."""
    rng = random.Random(4)
    rows = [(1 if i % 3 else 2 + i % 40, i, rng.random(), 2.0, 0.1, 5.0, 1 + rng.random(), i % 4)
            for i in range(3000)]
    rows += [(100, i, 0.25, 3.0, 0.1, 5.0, 1.0 + i, 1) for i in range(4)]
    rows += [(101, 1, None, 3.0, 0.1, 5.0, 2.0, 1), (101, 2, 0.5, 3.0, 0.1, 5.0, None, 1),
             (101, 3, 0.25, 3.0, 0.1, 5.0, 4.0, 0), (102, 1, None, 1.0, 0.1, 5.0, None, 1)]
    return spark.createDataFrame(rows, SCORED).repartition(6)


def _pandas_mean_seed():
    """Nested functions travel to the workers by value."""
    def map_rows(rows, keys):
        return rows.groupby(keys, as_index=False).agg(
            total=("probability_score", "sum"), n=("probability_score", "count"),
            top=("probability_score", "max"), target=("target_ecpm", "min"))

    def merge(states, keys):
        return states.groupby(keys, as_index=False).agg(
            total=("total", "sum"), n=("n", "sum"), top=("top", "max"), target=("target", "min"))

    def finish(rows):
        mean = rows["total"] / rows["n"]
        return pd.DataFrame({"multiplier": rows["probability_score"] / mean,
                             "baseline": rows["target"] * mean / rows["top"]})
    state = T.StructType([T.StructField(c, T.LongType() if c == "n" else T.DoubleType())
                          for c in ("total", "n", "top", "target")])
    return UP.PandasPricing(state, map_rows, merge, finish)


def _prices(df):
    return {(r.strategy_id, r.site_domain_id): (r.multiplier, r.baseline) for r in df.collect()}


@pytest.mark.parametrize("pricing", [MEAN_SEED, _pandas_mean_seed()], ids=["columns", "pandas"])
def test_declared_function_equals_the_built_in(spark, pricing):
    scored = _skewed(spark).where("strategy_id < 101")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        expected, got = _prices(P.price_mean_seed(scored)), _prices(pricing(scored))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert expected.keys() == got.keys()
    assert all(got[k] == pytest.approx(expected[k], rel=1e-9) for k in got)
    assert pricing(scored.limit(0)).count() == 0


def test_registered_functions_price_requests(spark):
    new = X.request_queue(spark, SMALL).where(F.col("status") == "new")
    UP.register_pricing("test_mean_seed", MEAN_SEED)
    try:
        with pytest.raises(ValueError):
            UP.register_pricing("test_mean_seed", MEAN_SEED)

        def run(name):
            out = DQ.price_requests(spark, SMALL, new, pricing=name)
            return {(r.dom_rec_id, r.site_domain_id): r.multiplier for r in out.collect()}
        got, expected = run("test_mean_seed"), run("target_ecpm_seed")
        assert got.keys() == expected.keys() and got
        assert all(got[k] == pytest.approx(expected[k]) for k in got)
    finally:
        UP.unregister_pricing("test_mean_seed")


def test_state_names_must_be_free(spark):
    own = UP.GroupPricing([{"paid": "max(paid)"}], "paid", "1")
    with pytest.raises(ValueError, match="paid"):
        own(_skewed(spark))


@pytest.mark.parametrize("weighted", [False, True])
def test_line_fits_equal_numpy(spark, weighted):
    scored = _skewed(spark)
    fit = UP.line_fit(F.col("paid"), F.col("seen") if weighted else None, floor=1.0)
    got = _prices(fit(scored))
    by = {}
    for r in scored.collect():
        by.setdefault(r.strategy_id, []).append(r)
    for s, rows in by.items():
        ok = [r for r in rows if r.probability_score is not None and r.paid is not None
              and (not weighted or r.seen > 0)]
        x, y = np.array([r.probability_score for r in ok]), np.array([r.paid for r in ok])
        w = np.array([r.seen for r in ok], dtype=float) if weighted else np.ones(len(ok))
        for r in rows:
            m = got[s, r.site_domain_id][0]
            if not len(ok):
                assert m is None
            elif len(set(x)) == 1:
                assert m == pytest.approx(np.average(y, weights=w))
            elif r.probability_score is not None:
                slope, start = np.polyfit(x, y, 1, w=np.sqrt(w))
                assert m == pytest.approx(slope * r.probability_score + start, rel=1e-8)


def test_two_points_are_the_active_function(spark):
    rows = [(1, 1, 0.2, 3.0, 0.1, 5.0, 0.3, 1), (1, 2, 0.8, 3.0, 0.1, 5.0, 3.0, 1)]
    scored = spark.createDataFrame(rows, SCORED)
    a, b = _prices(UP.line_fit(F.col("paid"))(scored)), _prices(P.price_dampen(scored))
    assert all(a[k] == pytest.approx(b[k]) for k in a)


def test_fits_far_from_zero_keep_their_digits(spark):
    rows = [(1, i, 1e8 + i / 1000, 1.0, 0.1, 5.0, 2.0 * i, 1) for i in range(100)]
    got = _prices(UP.line_fit(F.col("paid"), floor=1.0)(spark.createDataFrame(rows, SCORED)))
    assert all(got[1, i][0] == pytest.approx(2.0 * i, abs=1e-3) for i in range(100))
