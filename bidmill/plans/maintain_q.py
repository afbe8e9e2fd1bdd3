"""Prices kept up to date by deltas, against a full rebuild in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from bidmill.operators import maintain
from bidmill.plans.core import CANDIDATES_SQL, r6
from bidmill.plans.payloads_q import PRICED_SQL
from bidmill.plans.registry import query
from bidmill.session import scratch_path
from bidmill.sources import fixtures as X
from bidmill.sources.fixtures import FIXTURE_SQL, with_views

EDITED_INPUTS_SQL = """
select * replace (case when strategy_id % 97 = 0 then target_ecpm + 1 else target_ecpm end
                    as target_ecpm,
                  case when strategy_id % 101 = 0 then 450 else unique_count end as unique_count)
from first_inputs where strategy_id % 103 <> 0"""

EDITED_PREDICTIONS_SQL = """
select * replace (case when line_id % 23 = 5 then percentage_recommendations / 2
                       else percentage_recommendations end as percentage_recommendations)
from first_predictions where not (line_id % 23 = 7 and cumulative_users > 400)"""


@query("maintained_prices", with_views(
    "select strategy_id, site_domain_id, round(multiplier, 6) + 0.0 as multiplier, baseline "
    "from priced",
    ("first_inputs", FIXTURE_SQL["strategy_inputs"]), ("strategy_inputs", EDITED_INPUTS_SQL),
    "linez", ("first_predictions", FIXTURE_SQL["line_recommender_cumsum"]),
    ("line_recommender_cumsum", EDITED_PREDICTIONS_SQL), "site_domains",
    ("candidates", CANDIDATES_SQL), ("priced", PRICED_SQL)))
def q_maintained_prices(spark, sf_dir):
    """U2/U3 into A1 and M1: prices stored for the first versions, then some
    strategies and lines are edited and only what they reach is priced again."""
    inputs = X.versioned(spark, sf_dir, "strategy_inputs", X.strategy_inputs, ["strategy_id"])
    predictions = X.versioned(spark, sf_dir, "predictions", X.line_recommender_cumsum, ["line_id"])
    lines, sites = X.linez(spark, sf_dir), X.site_domains(spark, sf_dir)
    prices = maintain.build(scratch_path(spark, "prices"), inputs, predictions, lines, sites)
    s, line = F.col("strategy_id"), F.col("line_id")
    inputs.update("target_ecpm", F.col("target_ecpm") + 1, s % 97 == 0)
    inputs.update("unique_count", F.lit(450), s % 101 == 0)
    inputs.delete(s % 103 == 0)
    predictions.update("percentage_recommendations", F.col("percentage_recommendations") / 2,
                       line % 23 == 5)
    predictions.delete((line % 23 == 7) & (F.col("cumulative_users") > 400))
    made = maintain.refresh(prices, inputs, predictions, lines, sites)
    return prices.read(made.version).select("strategy_id", "site_domain_id",
                                            r6("multiplier").alias("multiplier"), "baseline")
