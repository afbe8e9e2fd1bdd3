"""Scans with planted bad lines: the rejects, and the good rows as ever."""

from __future__ import annotations

from pyspark.sql import functions as F

from bidmill.plans.core import cand_sql
from bidmill.plans.payloads_q import _export, entries_sql, num_text_sql, pay_sql
from bidmill.plans.registry import query
from bidmill.plans.tables_q import SCORES_SCHEMA, SCORES_SQL, _export_scores
from bidmill.session import scratch_path
from bidmill.sources import fixtures as X
from bidmill.sources import rejects as RJ

# bad lines for some strategies: (condition, line, reason) as Spark and DuckDB
# both read it; || and chr() are the same in both
BAD_SCORES = (
    ("strategy_id % 50 = 0", "strategy_id || chr(1) || '-1'", "7 fields expected"),
    ("strategy_id % 53 = 0", "strategy_id || chr(1) || '-1' || chr(1) || '[]' || chr(1) || 'high' "
     "|| chr(1) || '1.5' || chr(1) || '20240517' || chr(1) || '1'", "probability_score: not double"),
    ("strategy_id % 59 = 0", "strategy_id || chr(1) || '-1' || chr(1) || 'no list' || chr(1) "
     "|| '0.5' || chr(1) || '1.5' || chr(1) || '20240517' || chr(1) || '1'",
     "dimension_structs: no list of numbers"),
    ("strategy_id % 61 = 0", "'x' || strategy_id || chr(1) || '-1' || chr(1) || '[]' || chr(1) "
     "|| '0.5' || chr(1) || '1.5' || chr(1) || '20240517' || chr(1) || '1'",
     "strategy_id: not bigint"))
BAD_PRICES = (
    ("strategy_id % 50 = 0", "'bad' || strategy_id || chr(9) || strategy_id || ':abc:0.3'",
     "strategy_id || ':abc:0.3'", "multiplier: not double"),
    ("strategy_id % 53 = 0", "'bad' || strategy_id || ' no tab'", "'bad' || strategy_id || ' no tab'",
     "2 columns expected"),
    ("strategy_id % 59 = 0", "'bad' || strategy_id || chr(9) || strategy_id || ':1.5'",
     "strategy_id || ':1.5'", "strategy:multiplier:baseline expected"),
    ("strategy_id % 61 = 0", "'bad' || strategy_id || chr(9) || strategy_id || ':1.5:'",
     "strategy_id || ':1.5:'", "baseline: not double"))


def _planted(spark, sf_dir, bad) -> str:
    """A folder of bad lines, one for each strategy that a condition names."""
    ids = X.strategy_inputs(spark, sf_dir).select(F.col("strategy_id").cast("string").alias("sid"),
                                                  "strategy_id")
    path, lines = scratch_path(spark, "bad-lines"), None
    for where, line, *_ in bad:
        own = ids.where(where).selectExpr(f"{line.replace('strategy_id', 'sid')} as value")
        lines = own if lines is None else lines.unionByName(own)
    lines.write.text(path)
    return path


def _rejects_sql(shown) -> str:
    return " union all ".join(f"select {text} as text, '{reason}' as reason "
                              f"from strategy_inputs where {where}" for where, text, reason in shown)


def _scores(spark, sf_dir):
    return RJ.split(RJ.checked_scores(spark, SCORES_SCHEMA, _export_scores(spark, sf_dir),
                                      _planted(spark, sf_dir, BAD_SCORES)))


@query("score_rejects", cand_sql(_rejects_sql(BAD_SCORES)))
def q_score_rejects(spark, sf_dir):
    """S1 + F1: planted bad lines come out with their reason."""
    return _scores(spark, sf_dir)[1].select("text", "reason")


@query("scan_scores_checked", cand_sql(SCORES_SQL))
def q_scan_scores_checked(spark, sf_dir):
    """The good rows of the same scan are those of the file alone."""
    return _scores(spark, sf_dir)[0].withColumn("probability_score", F.round("probability_score", 6))


def _prices(spark, sf_dir):
    data, header = _export(spark, sf_dir)
    return RJ.split(RJ.checked_price_lines(spark, header, data,
                                           _planted(spark, sf_dir, BAD_PRICES)))


@query("price_rejects", cand_sql(_rejects_sql((w, text, why) for w, _, text, why in BAD_PRICES)))
def q_price_rejects(spark, sf_dir):
    """S2 + F4: bad lines and bad entries of a price file."""
    return _prices(spark, sf_dir)[1].select("text", "reason")


@query("parse_prices_checked", pay_sql(f"""
select cast(strategy_id as varchar) as strategy_id, 'site_domain_id2' as dimension, key as value,
       round(cast({num_text_sql('multiplier')} as double), 6) + 0.0 as multiplier, baseline
from ({entries_sql('site_domain_id2')}) e"""))
def q_parse_prices_checked(spark, sf_dir):
    """the good entries of the same scan."""
    return _prices(spark, sf_dir)[0].select(
        "strategy_id", "dimension", "value",
        (F.round("multiplier", 6) + F.lit(0.0)).alias("multiplier"), "baseline")
