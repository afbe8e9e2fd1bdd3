"""Candidate selection and pricing queries over the fixture tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidmill.operators import candidates as C
from bidmill.operators import pricing as P
from bidmill.joins import is_small
from bidmill.plans.registry import query
from bidmill.session import written
from bidmill.sources import fixtures as X
from bidmill.sources.fixtures import with_views

# --- shared SQL pieces for the oracle --------------------------------------

CAND_VIEWS = ("strategy_inputs", "linez", "line_recommender_cumsum", "site_domains")

CANDIDATES_SQL = """
with shown as (
  select site_domain_id, line_id, cumulative_users, percentage_recommendations as score
  from site_domains, line_recommender_cumsum
  where name = domain_name and line_id in (select line_id from linez)),
starts as (
  select strategy_id, arg_min(site_domain_id, (cumulative_users, site_domain_id)) as site_domain_id,
         arg_min(score, (cumulative_users, site_domain_id)) as score
  from shown join strategy_inputs using (line_id) group by strategy_id)
select strategy_id, site_domain_id, score as probability_score, algorithm_id as algo_id
from strategy_inputs join shown using (line_id)
where unique_count = -1 or cumulative_users <= unique_count
union
select strategy_id, site_domain_id, score, algorithm_id
from starts join strategy_inputs using (strategy_id)"""


def cand_sql(body: str, *extra) -> str:
    return with_views(body, *CAND_VIEWS, ("candidates", CANDIDATES_SQL), *extra)


def _cand_inputs(spark: SparkSession, sf_dir: str):
    return (X.strategy_inputs(spark, sf_dir), X.linez(spark, sf_dir),
            X.line_recommender_cumsum(spark, sf_dir), X.site_domains(spark, sf_dir))


def candidates_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.candidates(*_cand_inputs(spark, sf_dir))


def scored_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 output, written once: pricing reads it twice (group bounds and the
    rows), each time only the columns it needs, as the reference's score file
    is written once and read by the mapping step."""
    return written(P.scored_inputs(candidates_df(spark, sf_dir), X.strategy_inputs(spark, sf_dir)),
                   "scored")


def r6(c):
    # "+ 0.0" turns a rounded -0.0 into 0.0 (DuckDB keeps the sign, Spark does not)
    return F.round(c, 6) + F.lit(0.0)


# --- queries ----------------------------------------------------------------

@query("candidates", cand_sql(
    "select strategy_id, site_domain_id, round(probability_score, 6) as probability_score, "
    "algo_id from candidates"))
def q_candidates(spark, sf_dir):
    c = candidates_df(spark, sf_dir)
    return c.select("strategy_id", "site_domain_id", r6("probability_score").alias("probability_score"),
                    "algo_id")


@query("first_domain", with_views("""
select strategy_id, arg_min(site_domain_id, (cumulative_users, site_domain_id)) as site_domain_id,
       min(cumulative_users) as cumulative_users
from strategy_inputs join linez using (line_id) join line_recommender_cumsum using (line_id)
join site_domains on name = domain_name
group by strategy_id""", *CAND_VIEWS))
def q_first_domain(spark, sf_dir):
    return C.first_domain(*_cand_inputs(spark, sf_dir))


@query("capped_candidates", with_views("""
select i.strategy_id, s.site_domain_id, p.cumulative_users
from strategy_inputs i join linez l on i.line_id = l.line_id
join line_recommender_cumsum p on l.line_id = p.line_id
join site_domains s on p.domain_name = s.name
where p.cumulative_users <= i.unique_count or i.unique_count = -1""", *CAND_VIEWS))
def q_capped(spark, sf_dir):
    return C.capped_rows(*_cand_inputs(spark, sf_dir))


@query("candidate_join", with_views("""
select i.strategy_id, l.line_id, s.site_domain_id,
       round(p.percentage_recommendations, 6) as percentage_recommendations, p.cumulative_users
from strategy_inputs i join linez l on i.line_id = l.line_id
join line_recommender_cumsum p on l.line_id = p.line_id
join site_domains s on p.domain_name = s.name""", *CAND_VIEWS))
def q_candidate_join(spark, sf_dir):
    j = C.candidate_join(*_cand_inputs(spark, sf_dir))
    return j.withColumn("percentage_recommendations", r6("percentage_recommendations"))


@query("scored_inputs", cand_sql("""
select c.strategy_id, c.site_domain_id, round(c.probability_score, 6) as probability_score,
       coalesce(i.target_ecpm, 1) as target_ecpm, i.min_bid, i.max_bid
from candidates c join strategy_inputs i on c.strategy_id = i.strategy_id"""))
def q_scored(spark, sf_dir):
    s = scored_df(spark, sf_dir)
    return s.select("strategy_id", "site_domain_id", r6("probability_score").alias("probability_score"),
                    "target_ecpm", "min_bid", "max_bid")


@query("score_bounds", cand_sql("""
select c.strategy_id, round(min(probability_score), 6) as lo, round(max(probability_score), 6) as hi,
       round(avg(probability_score), 6) as av, min(i.target_ecpm) as target_ecpm,
       min(i.min_bid) as min_bid, max(i.max_bid) as max_bid
from candidates c join strategy_inputs i on c.strategy_id = i.strategy_id
group by c.strategy_id"""))
def q_score_bounds(spark, sf_dir):
    b = P.score_bounds(scored_df(spark, sf_dir))
    return b.select("strategy_id", r6("lo").alias("lo"), r6("hi").alias("hi"), r6("av").alias("av"),
                    F.col("t").alias("target_ecpm"), F.col("mn").alias("min_bid"),
                    F.col("mx").alias("max_bid"))


PRICE_DAMPEN_SQL = cand_sql("""
select strategy_id, site_domain_id,
       round((case when hi = lo then (0.3e0 + target_ecpm) / 2
                   else 0.3e0 + (target_ecpm - 0.3e0) * (probability_score - lo) / (hi - lo) end)
             / 0.3e0, 6) + 0.0 as multiplier, 0.3e0 as baseline
from (select c.strategy_id, c.site_domain_id, c.probability_score, i.target_ecpm,
             min(probability_score) over (partition by c.strategy_id) as lo,
             max(probability_score) over (partition by c.strategy_id) as hi
      from candidates c join strategy_inputs i on c.strategy_id = i.strategy_id) z""")


def small_groups(spark, sf_dir) -> bool:
    """Priced groups are strategies: at most the inputs' row count."""
    return is_small(X.strategy_inputs(spark, sf_dir).select("strategy_id", "min_bid", "max_bid",
                                                            "target_ecpm"))


def price_dampen_df(spark, sf_dir):
    return P.price_dampen(scored_df(spark, sf_dir), small_groups=small_groups(spark, sf_dir))


@query("price_dampen", PRICE_DAMPEN_SQL)
def q_price_dampen(spark, sf_dir):
    p = price_dampen_df(spark, sf_dir)
    return p.select("strategy_id", "site_domain_id", r6("multiplier").alias("multiplier"), "baseline")


@query("price_mean_seed", cand_sql("""
select strategy_id, site_domain_id, round(probability_score / av, 6) + 0.0 as multiplier,
       round(target_ecpm * av / hi, 6) + 0.0 as baseline
from (select c.strategy_id, c.site_domain_id, c.probability_score, i.target_ecpm,
             avg(probability_score) over (partition by c.strategy_id) as av,
             max(probability_score) over (partition by c.strategy_id) as hi
      from candidates c join strategy_inputs i on c.strategy_id = i.strategy_id) z"""))
def q_price_mean_seed(spark, sf_dir):
    p = P.price_mean_seed(scored_df(spark, sf_dir), small_groups=small_groups(spark, sf_dir))
    return p.select("strategy_id", "site_domain_id", r6("multiplier").alias("multiplier"),
                    r6("baseline").alias("baseline"))


@query("price_min_max", cand_sql("""
select strategy_id, site_domain_id,
       round(case when hi = lo then (mn + mx) / 2
                  else mn + (mx - mn) * (probability_score - lo) / (hi - lo) end, 6) + 0.0 as multiplier
from (select c.strategy_id, c.site_domain_id, c.probability_score,
             min(i.min_bid) over (partition by c.strategy_id) as mn,
             max(i.max_bid) over (partition by c.strategy_id) as mx,
             min(probability_score) over (partition by c.strategy_id) as lo,
             max(probability_score) over (partition by c.strategy_id) as hi
      from candidates c join strategy_inputs i on c.strategy_id = i.strategy_id) z"""))
def q_price_min_max(spark, sf_dir):
    p = P.price_min_max(scored_df(spark, sf_dir), small_groups=small_groups(spark, sf_dir))
    return p.select("strategy_id", "site_domain_id", r6("multiplier").alias("multiplier"))


@query("dimension_struct", cand_sql("""
select strategy_id, 1 as dimension_type_id, cast(site_domain_id as varchar) as first,
       '' as last, '' as unit, round(probability_score, 6) as probability_score, algo_id
from candidates"""))
def q_dimension_struct(spark, sf_dir):
    c = candidates_df(spark, sf_dir)
    s = c.select("strategy_id", C.dimension_struct_from(F.col("site_domain_id"))
                 .alias("dimension_value_structs"), "probability_score", "algo_id")
    # compared flattened: the struct is built, then read back field by field
    return s.select("strategy_id", "dimension_value_structs.dimension_type_id",
                    "dimension_value_structs.dimension_value.first",
                    "dimension_value_structs.dimension_value.last",
                    "dimension_value_structs.dimension_value.unit",
                    r6("probability_score").alias("probability_score"), "algo_id")


@query("dimension_array", cand_sql("""
select strategy_id, site_domain_id,
       '[{"dimension_type_id":1,"dimension_value":"' || site_domain_id || '"}]' as dimension_structs
from candidates"""))
def q_dimension_array(spark, sf_dir):
    """ARRAY(NAMED_STRUCT(type, x.dimension_value.first)) from the nested
    prediction struct, as the JSON text the score file carries."""
    c = candidates_df(spark, sf_dir)
    nested = c.select("strategy_id", "site_domain_id",
                      C.dimension_struct_from(F.col("site_domain_id")).alias("x"))
    arr = F.array(F.struct(F.col("x.dimension_type_id").alias("dimension_type_id"),
                           F.col("x.dimension_value.first").alias("dimension_value")))
    return nested.select("strategy_id", "site_domain_id", F.to_json(arr).alias("dimension_structs"))
