"""Physical-plan properties the design relies on (read from explain output)."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from bidmill.operators import candidates as C
from bidmill.operators import requests as R
from bidmill.sources import fixtures as X
from bidmill.sources import sinks
from bidmill.sources.tables import table

SMALL = "/root/testdata/sf0.001"


def _plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_scan_reads_only_needed_columns(spark):
    li = table(spark, SMALL, "lineitem").select("l_suppkey", "l_partkey", "l_quantity") \
        .where(F.col("l_quantity") > 10)
    plan = _plan(li)
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double>" in plan
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in plan


def test_candidates_have_no_window_and_broadcast_dimensions(spark):
    args = (X.strategy_inputs(spark, SMALL), X.linez(spark, SMALL),
            X.line_recommender_cumsum(spark, SMALL), X.site_domains(spark, SMALL))
    plan = _plan(C.candidates(*args))
    assert "Window" not in plan
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_partition_pruning_on_predictions(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(1, -1), (2, 7)], "strategy_id long, algo_id int")
    sinks.overwrite_partitions(df, path, ["algo_id"], clear_stale=True)
    plan = _plan(spark.read.parquet(path).where(F.col("algo_id") == -1))
    assert "PartitionFilters: [isnotnull(algo_id" in plan and "(algo_id#" in plan


def test_claim_is_one_aggregation_without_join(spark):
    q = spark.createDataFrame([(1, "new"), (2, "in_process")], "dom_rec_id long, status string")
    plan = _plan(R.claim_next(q))
    assert "Join" not in plan and "HashAggregate" in plan
