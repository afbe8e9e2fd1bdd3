"""Incremental re-pricing against a rebuild."""

import pytest
from pyspark.sql import functions as F

from bidmill.operators import maintain
from bidmill.session import scratch_path
from bidmill.sources import fixtures as X
from bidmill.sources.versions import VersionedTable

SMALL = "/root/testdata/sf0.001"


@pytest.fixture()
def sources(spark):
    return (X.versioned(spark, SMALL, "strategy_inputs", X.strategy_inputs, ["strategy_id"]),
            X.versioned(spark, SMALL, "predictions", X.line_recommender_cumsum, ["line_id"]),
            X.linez(spark, SMALL), X.site_domains(spark, SMALL))


def _rows(df):
    return sorted((r.strategy_id, r.site_domain_id, r.algo_id, round(r.multiplier, 9), r.baseline)
                  for r in df.collect())


def _equals_rebuild(prices, sources):
    inputs, predictions, lines, sites = sources
    whole = maintain.priced(inputs.read(), lines, predictions.read(), sites)
    assert _rows(prices.read()) == _rows(whole)


def test_refresh_equals_rebuild(spark, sources):
    inputs, predictions, lines, sites = sources
    prices = maintain.build(scratch_path(spark, "prices"), *sources)
    assert maintain.refresh(prices, *sources).version == 1            # nothing was edited
    before = prices.read()
    old = _rows(before)
    one = before.select("strategy_id").first()[0]
    inputs.update("target_ecpm", F.lit(3.5), F.col("strategy_id") == one)
    made = maintain.refresh(prices, *sources)
    assert len(made.touched) == 1                                     # one bucket of prices
    _equals_rebuild(prices, sources)
    line = inputs.read().where(F.col("strategy_id") == one).first().line_id
    predictions.update("percentage_recommendations", F.col("percentage_recommendations") / 3,
                       F.col("line_id") == line)
    inputs.delete(F.col("strategy_id") % 10 == 1)
    inputs.insert(inputs.read(1).where(F.col("strategy_id") == one)
                  .withColumn("strategy_id", F.lit(700_001)))
    maintain.refresh(prices, *sources)
    _equals_rebuild(prices, sources)
    assert prices.read().where("strategy_id = 700001").count() > 0
    assert prices.manifest().notes == {"inputs": inputs.manifest().version,
                                       "predictions": predictions.manifest().version}
    assert _rows(before) == old                                       # the first readers' rows
    predictions.delete(F.lit(True))
    maintain.refresh(prices, *sources)
    assert prices.read().count() == 0


def test_only_touched_lines_are_read(spark, sources):
    inputs, predictions, _, _ = sources
    line = predictions.read().first().line_id
    keys = spark.createDataFrame([(line,)], "line_id long")
    found = predictions.read_keys(1, keys)
    assert {r.line_id for r in found.collect()} == {line}
    read = {f.rsplit("/b=", 1)[1].split("/")[0] for f in found.inputFiles()}
    assert len(read) == 1 and len(predictions.manifest().parts) > 1
    predictions.update("cumulative_users", F.col("cumulative_users") + 1, F.col("line_id") == line)
    hit = maintain.affected(inputs, predictions, {"inputs": 1, "predictions": 1},
                            {"inputs": 1, "predictions": 2}).collect()
    expected = inputs.read().where(F.col("line_id") == line).select("strategy_id").collect()
    assert sorted(hit) == sorted(expected)


def test_concurrent_refresh_is_done_once(spark, sources):
    inputs, predictions, lines, sites = sources
    prices = maintain.build(scratch_path(spark, "prices"), *sources)
    base = prices.manifest()
    inputs.update("target_ecpm", F.lit(2.5), F.col("strategy_id") % 5 == 0)
    late = VersionedTable(spark, prices.path)
    late.attempts = lambda attempt, first=[base]: VersionedTable.attempts(   # starts from version 1
        late, lambda m: attempt(first.pop() if first else m))
    maintain.refresh(prices, *sources)
    assert maintain.refresh(late, *sources).version == 2              # lost, then nothing to do
    _equals_rebuild(prices, sources)
