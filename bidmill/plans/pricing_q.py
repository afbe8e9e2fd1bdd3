"""Pricing through the registered surface: declared functions, line fits, and
every pricing function of the dequeue job."""

from __future__ import annotations

from pyspark.sql import functions as F

from bidmill.operators import user_pricing as UP
from bidmill.plans import dequeue as DQ
from bidmill.plans.core import cand_sql, r6, scored_df, small_groups
from bidmill.plans.registry import query
from bidmill.sources import fixtures as X

# M2 declared by its state: mean and largest score, target
MEAN_SEED = UP.GroupPricing(
    [{"mean": "avg(probability_score)", "top": "max(probability_score)",
      "target": "min(target_ecpm)"}],
    "try_divide(probability_score, mean)", "try_divide(target * mean, top)")

MEAN_SEED_SQL = """
select strategy_id, site_domain_id, round(probability_score / mean, 6) + 0.0 as multiplier,
       round(target_ecpm * mean / top, 6) + 0.0 as baseline
from candidates join strategy_inputs using (strategy_id)
join (select strategy_id, avg(probability_score) as mean, max(probability_score) as top
      from candidates group by strategy_id) g using (strategy_id)"""


@query("price_declared", cand_sql(MEAN_SEED_SQL))
def q_price_declared(spark, sf_dir):
    """M2 as a declared group function."""
    p = MEAN_SEED(scored_df(spark, sf_dir), small_groups=small_groups(spark, sf_dir))
    return p.select("strategy_id", "site_domain_id", r6("multiplier").alias("multiplier"),
                    r6("baseline").alias("baseline"))


@query("price_fitted", cand_sql("""
select strategy_id, site_domain_id,
       round((case when lo < hi then slope * probability_score + start else mean end) / 0.3e0, 6)
         + 0.0 as multiplier, 0.3e0 as baseline
from candidates join (
  select strategy_id, min(probability_score) as lo, max(probability_score) as hi, avg(y) as mean,
         regr_slope(y, probability_score) as slope, regr_intercept(y, probability_score) as start
  from (select strategy_id, probability_score,
               target_ecpm * (10 + site_domain_id % 7) / 10 as y
        from candidates join strategy_inputs using (strategy_id)) points
  group by strategy_id) fits using (strategy_id)"""))
def q_price_fitted(spark, sf_dir):
    """M1/M3/M4 for any number of points: a line through each strategy's own
    prices (its target, up to 60 % more by site)."""
    fit = UP.line_fit(F.col("target_ecpm") * (10 + F.col("site_domain_id") % 7) / 10)
    p = fit(scored_df(spark, sf_dir), small_groups=small_groups(spark, sf_dir))
    return p.select("strategy_id", "site_domain_id", r6("multiplier").alias("multiplier"), "baseline")


def _requested(pricing: str, oracle: str):
    def run(spark, sf_dir):
        new = X.request_queue(spark, sf_dir).where(F.col("status") == "new")
        p = DQ.price_requests(spark, sf_dir, new, pricing=pricing)
        return p.select("dom_rec_id", "strategy_id", "site_domain_id",
                        r6("multiplier").alias("multiplier"))
    run.__doc__ = f"The requests' prices by {pricing}, through the dequeue job."
    query(f"requested_{pricing}", cand_sql(f"""
select q.dom_rec_id, q.strategy_id, site_domain_id, round(multiplier, 6) + 0.0 as multiplier
from request_queue q join ({oracle}) p on p.strategy_id = q.strategy_id
where q.status = 'new'""", "dom_rec_queue", "request_queue"))(run)


_requested("target_ecpm_seed", """
select strategy_id, site_domain_id, probability_score / mean as multiplier
from candidates join (select strategy_id, avg(probability_score) as mean
                      from candidates group by strategy_id) g using (strategy_id)""")
_requested("min_max_bid", """
select strategy_id, site_domain_id,
       case when lo < hi then min_bid + (max_bid - min_bid) * (probability_score - lo) / (hi - lo)
            else (min_bid + max_bid) / 2 end as multiplier
from candidates join strategy_inputs using (strategy_id)
join (select strategy_id, min(probability_score) as lo, max(probability_score) as hi
      from candidates group by strategy_id) g using (strategy_id)""")
