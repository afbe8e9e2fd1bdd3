"""Candidate domains per strategy.

Semantics: every strategy input joins its line, the line's domain predictions
and the site dictionary (all inner: a domain missing from the dictionary
vanishes before ranking; a name listed twice yields two rows). A row is kept
when it is the strategy's first domain by (cumulative_users, site_domain_id),
or when cumulative_users fits under the cap, or when there is no cap (-1).
Then whole-row distinct.

Plan shape (why not a window): the first domain of a strategy is the minimum
of the first domains of its lines, so it comes from a partially aggregated
``groupBy(line_id)`` on the prediction side (skew-safe, tiny shuffle). The
cap test is done once per distinct (line, cap) pair, and strategies join that
prefix on (line_id, cap), so the join produces output rows only instead of
every (strategy, domain) pair of a line. No shuffle or sort of the candidate
rows; a unit's rows are streamed by the task that its key was dealt to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidmill.joins import broadcast_if_small, is_small, once_and_repeated
from bidmill.session import written

SITE_DOMAIN_TYPE = 1  # dimension_type_id of a site domain
ROWS_PER_TASK = 500_000  # candidates that a task makes, on average


def predicted_domains(preds: DataFrame, lines: DataFrame, sites: DataFrame) -> DataFrame:
    """Predictions of known lines, resolved to dictionary ids (one scan)."""
    p = preds.select("line_id", "domain_name", "percentage_recommendations",
                     "cumulative_users")
    return (p.join(broadcast_if_small(lines.select("line_id")), "line_id")
             .join(broadcast_if_small(sites.select("site_domain_id", "name")),
                   F.col("domain_name") == F.col("name"))
             .drop("name"))


def first_domain_per_line(resolved: DataFrame) -> DataFrame:
    """line_id -> smallest (cumulative_users, site_domain_id) of the line, with
    its score, as ``first`` struct.

    One pass: ``min(struct)`` partially aggregated per map task (a sort-based
    aggregate, as the buffer is a struct), one row per line and task
    shuffled. The alternative, a numeric hash minimum then the rows at that
    minimum, reads the prediction side twice more; on remote storage those
    scans cost more than the in-task sort."""
    return resolved.groupBy("line_id").agg(
        F.min(F.struct("cumulative_users", "site_domain_id",
                       F.col("percentage_recommendations").alias("score"))).alias("first"))


def candidates(inputs: DataFrame, lines: DataFrame, preds: DataFrame, sites: DataFrame,
               keys: tuple[str, ...] = ("strategy_id",)) -> DataFrame:
    """A1 of U1: distinct (keys..., site_domain_id, probability_score, algo_id).

    ``keys`` identifies one priced unit; a batch of requests passes
    ("dom_rec_id", "strategy_id") so two requests for one strategy stay apart.

    The cap test runs once per distinct (line, cap) pair, not once per
    strategy: ``prefix`` holds, for every line and cap in use, the distinct
    domains under that cap and the line's first, and units join it on
    (line_id, cap). The work is the output plus (distinct caps x domains),
    where joining every strategy to every domain of its line and filtering
    afterwards would be (strategies x domains). A unit of one input row has
    no row twice, so its candidates aren't shuffled: the units are dealt by
    their keys, as many to a task as give ``ROWS_PER_TASK`` rows on average.
    Units of several rows take ``_of_repeated``.
    """
    inp = inputs.select(*keys, "line_id", F.col("unique_count").alias("cap"),
                        F.col("algorithm_id").alias("algo_id"))
    pairs = written(inp.select("line_id", "cap").distinct(), "caps")
    used = pairs.select("line_id").distinct()
    if is_small(pairs):
        pairs, used = F.broadcast(pairs), F.broadcast(used)
    resolved = predicted_domains(preds.join(used, "line_id", "left_semi"), lines, sites)
    resolved = written(resolved, "resolved")   # read by the first domains and the caps
    line_first = first_domain_per_line(resolved)
    # rows under the cap (or no cap, -1), of a NULL cap none, and the first domain
    capped = resolved.join(pairs, "line_id").where(
        (F.col("cap") == -1) | (F.col("cumulative_users") <= F.col("cap"))).select(
            "line_id", "cap", "site_domain_id",
            F.col("percentage_recommendations").alias("probability_score"))
    firsts = line_first.join(pairs, "line_id").select(
        "line_id", "cap", F.col("first.site_domain_id").alias("site_domain_id"),
        F.col("first.score").alias("probability_score"))
    prefix = written(capped.unionByName(firsts).distinct(), "prefix")

    once, repeated = once_and_repeated(inp.distinct(), keys)
    tasks = _tasks(once, prefix)
    own = prefix.withColumnsRenamed({"line_id": "_line", "cap": "_cap"})
    out = once.repartition(tasks, *keys).join(
        broadcast_if_small(own), (F.col("line_id") == F.col("_line"))
        & F.col("cap").eqNullSafe(F.col("_cap"))).select(
            *keys, "site_domain_id", "probability_score", "algo_id")
    if repeated is not None:
        out = out.unionByName(_of_repeated(repeated, resolved, line_first, keys))
    return out


def _tasks(units: DataFrame, prefix: DataFrame) -> int:
    """How many tasks the units' candidates need."""
    n = units.groupBy("line_id", "cap").agg(F.count(F.lit(1)).alias("_units")).withColumnsRenamed(
        {"line_id": "_line", "cap": "_cap"})
    m = prefix.groupBy("line_id", "cap").agg(F.count(F.lit(1)).alias("_domains"))
    rows = n.join(m, (F.col("line_id") == F.col("_line")) & F.col("cap").eqNullSafe(F.col("_cap"))) \
        .agg(F.sum(F.col("_units") * F.col("_domains"))).first()[0]
    return max(1, -(-(rows or 0) // ROWS_PER_TASK))


def _of_repeated(inp: DataFrame, resolved: DataFrame, line_first: DataFrame,
                 keys: tuple[str, ...]) -> DataFrame:
    """Candidates of units with several input rows (or a null in the key): a
    domain may come by more than one of them, and the unit's first domain is
    the smallest first of its lines."""
    small = is_small(inp)

    def dim(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    pairs = inp.select("line_id", "cap").where(F.col("cap").isNotNull()).distinct()
    prefix = resolved.join(dim(pairs), "line_id").where(
        (F.col("cap") == -1) | (F.col("cumulative_users") <= F.col("cap")))
    capped = prefix.join(dim(inp), ["line_id", "cap"]).select(
        *keys, "site_domain_id", F.col("percentage_recommendations").alias("probability_score"),
        "algo_id")
    with_first = inp.join(line_first, "line_id")
    unit_first = with_first.groupBy(*keys).agg(F.min("first").alias("unit_first"))
    firsts = (with_first.join(dim(unit_first), list(keys))
                        .where(F.col("first") == F.col("unit_first"))
                        .select(*keys, F.col("first.site_domain_id").alias("site_domain_id"),
                                F.col("first.score").alias("probability_score"), "algo_id"))
    return capped.unionByName(firsts).distinct()


def first_domain(inputs: DataFrame, lines: DataFrame, preds: DataFrame,
                 sites: DataFrame) -> DataFrame:
    """W1 with row_n = 1: each strategy's first domain (ties by id)."""
    resolved = predicted_domains(preds, lines, sites)
    line_first = first_domain_per_line(resolved)
    first = (inputs.select("strategy_id", "line_id").join(line_first, "line_id")
                   .groupBy("strategy_id").agg(F.min("first").alias("first")))
    return first.select("strategy_id",
                        F.col("first.site_domain_id").alias("site_domain_id"),
                        F.col("first.cumulative_users").alias("cumulative_users"))


def capped_rows(inputs: DataFrame, lines: DataFrame, preds: DataFrame,
                sites: DataFrame) -> DataFrame:
    """The capped branch alone (cumulative_users <= cap or no cap), by
    the same per-(line, cap) prefix as ``candidates``."""
    resolved = predicted_domains(preds, lines, sites)
    inp = inputs.select("strategy_id", "line_id", F.col("unique_count").alias("cap"))
    small = is_small(inp)
    pairs = inp.select("line_id", "cap").where(F.col("cap").isNotNull()).distinct()
    prefix = resolved.join(F.broadcast(pairs) if small else pairs, "line_id").where(
        (F.col("cap") == -1) | (F.col("cumulative_users") <= F.col("cap")))
    return prefix.join(F.broadcast(inp) if small else inp, ["line_id", "cap"]).select(
        "strategy_id", "site_domain_id", "cumulative_users")


def candidate_join(inputs: DataFrame, lines: DataFrame, preds: DataFrame,
                   sites: DataFrame) -> DataFrame:
    """J2 alone: every joined row before ranking (rows multiply on duplicate names)."""
    resolved = predicted_domains(preds, lines, sites)
    inp = inputs.select("strategy_id", "line_id")
    return resolved.join(inp, "line_id").select(
        "strategy_id", "line_id", "site_domain_id", "percentage_recommendations",
        "cumulative_users")


def unresolved_candidates(strategies: DataFrame, lines: DataFrame, preds: DataFrame,
                          engine_id: int, strategy_ids: list[int] | None) -> DataFrame:
    """J3 + P9: strategies of one bidding engine (optionally an id list),
    their lines and the raw predictions, with no dictionary lookup."""
    s = strategies.where(F.col("bidding_engine_id") == engine_id)
    if strategy_ids is not None:
        s = s.where(F.col("strategy_id").isin(strategy_ids))
    return (s.select("strategy_id", "line_id")
             .join(broadcast_if_small(lines.select("line_id")), "line_id")
             .join(preds, "line_id")
             .select("strategy_id",
                     dimension_struct_from(F.col("domain_name")).alias("dimension_value_structs"),
                     F.col("percentage_recommendations").alias("probability_score")))


def dimension_struct_from(value) -> "F.Column":
    """{dimension_type_id: 1, dimension_value: {first: value, last: '', unit: ''}}."""
    return F.struct(
        F.lit(SITE_DOMAIN_TYPE).alias("dimension_type_id"),
        F.struct(value.cast("string").alias("first"), F.lit("").alias("last"),
                 F.lit("").alias("unit")).alias("dimension_value"))
