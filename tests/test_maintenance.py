"""Retention, time stamps, queue claims and the partition-overwrite rules."""

import pytest
from pyspark.sql import functions as F

from bidmill.functions import timefn as TF
from bidmill.operators import requests as R
from bidmill.operators import retention as RT
from bidmill.sources import sinks


def test_expired_and_statement(spark):
    parts = spark.createDataFrame([("algo_id=901/dt=20160509",), ("algo_id=901/dt=20160609",)],
                                  "partition string")
    exp = RT.expired_partitions(parts, F.lit("20160601"))
    assert [r.partition for r in exp.collect()] == ["algo_id=901/dt=20160509"]
    st = RT.drop_statements(exp, ["output_log", "output_log_test"]).collect()
    assert {r.statement for r in st} == {
        "alter table output_log drop if exists partition(algo_id=901,dt=20160509);",
        "alter table output_log_test drop if exists partition(algo_id=901,dt=20160509);"}


def test_retention_units(spark):
    df = spark.createDataFrame([("2016-07-01",)], "d string")
    assert df.select(RT.retention_cutoff(F.col("d"), 2, "m")).first()[0] == "20160430"
    assert df.select(RT.retention_cutoff(F.col("d"), 3, "d")).first()[0] == "20160628"
    with pytest.raises(ValueError):
        RT.retention_cutoff(F.col("d"), 1, "h")


def test_time_stamps(spark):
    t = "2024-05-17 09:41:26"
    row = spark.range(1).select(TF.up_to_date(t), TF.up_to_second(t), TF.up_to_hundredth(t),
                                TF.prefix(t), TF.queue_stamp(t)).first()
    assert tuple(row) == ("20240517", "20240517094126", "2024051709412600",
                          "2024051709412600_", "2024051709412600")
    frac = spark.range(1).select(TF.up_to_hundredth("2024-05-17 09:41:26.496")).first()[0]
    assert frac == "2024051709412650"   # rounded to hundredths, not truncated


def _queue(spark, rows):
    return spark.createDataFrame(rows, "dom_rec_id long, status string")


def test_claims(spark):
    q = _queue(spark, [(3, "new"), (1, "processed"), (2, "new")])
    assert R.claim_next(q).first().dom_rec_id == 2
    assert R.claim_next(_queue(spark, [(1, "processed")])).first().dom_rec_id is None
    busy = _queue(spark, [(3, "new"), (4, "in_process")])
    assert R.claim_next(busy).first().dom_rec_id is None
    assert R.claim_batch(busy, 5).count() == 0
    assert [r.dom_rec_id for r in R.claim_batch(q, 5).orderBy("dom_rec_id").collect()] == [2, 3]


def test_dynamic_overwrite_rules(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.createDataFrame([(1, -1), (2, 1)], "x long, algo_id int")
    sinks.overwrite_partitions(base, path, ["algo_id"], clear_stale=True)
    empty = base.where(F.lit(False))
    sinks.overwrite_partitions(empty, path, ["algo_id"])          # replaces nothing
    assert spark.read.parquet(path).count() == 2
    sinks.overwrite_partitions(spark.createDataFrame([(9, 1)], "x long, algo_id int"), path, ["algo_id"])
    got = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert got == [(1, -1), (9, 1)]                                # only partition 1 replaced


def test_apply_retention_in_chunks(spark, tmp_path):
    """Expired partitions dropped in several multi-spec statements; text
    partition values are quoted."""
    path = str(tmp_path / "log")
    rows = [(i, -1, 20240100 + d, "x" if d % 2 else "y") for i, d in enumerate(range(1, 8))]
    df = spark.createDataFrame(rows, "id long, algo_id int, dt int, src string")
    df.write.partitionBy("algo_id", "dt").json(path)
    name = "bidmill_test_retention"
    RT.create_partitioned_table(spark, name, "id bigint, src string, algo_id int, dt int",
                                ["algo_id", "dt"], path)
    RT.repair_table(spark, name)
    parts = RT.list_partitions(spark, name)
    assert parts.count() == 7
    expired = RT.expired_partitions(parts, F.lit("20240105"))
    assert RT.apply_retention(spark, name, expired, chunk=2) == 4
    left = sorted(r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect())
    assert left == ["algo_id=-1/dt=20240105", "algo_id=-1/dt=20240106", "algo_id=-1/dt=20240107"]
    assert RT._spec("a=1/b=x") == "PARTITION (a=1, b='x')"
