"""Row edits on snapshots, id assignment on append, and the dims parser."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bidmill.functions.text import parse_dims
from bidmill.operators.snapshots import delete_where, insert_values, update_where
from bidmill.sources import sinks

SNAP = "strategy_id long, baseline_bid decimal(10,4), max_bid decimal(10,4)"


def _snap(spark):
    return spark.createDataFrame([(1, Decimal("1.0001"), Decimal("2.0000")),
                                  (2, Decimal("3.3333"), None)], SNAP)


def test_update_keeps_decimal_type_and_rounds_half_up(spark):
    out = update_where(_snap(spark), F.col("strategy_id") == 1, "baseline_bid",
                       F.col("baseline_bid") * F.lit(Decimal("1.05")))
    assert str(out.schema["baseline_bid"].dataType) == "DecimalType(10,4)"
    got = {r.strategy_id: r.baseline_bid for r in out.collect()}
    assert got == {1: Decimal("1.0501"), 2: Decimal("3.3333")}   # 1.050105 -> 1.0501


def test_delete_keeps_unknown_rows(spark):
    out = delete_where(_snap(spark), F.col("max_bid") > F.col("baseline_bid"))
    assert [r.strategy_id for r in out.collect()] == [2]          # NULL condition: kept


def test_insert_values(spark):
    out = insert_values(_snap(spark), [(3, Decimal("1.01"), Decimal("2.02"))])
    assert out.count() == 3


def test_append_with_ids_continues_after_the_maximum(spark, tmp_path):
    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "v string").repartition(2)
    first = sinks.append_with_ids(rows, spark, "q", id_col="request_id", path=None)
    path = first.inputFiles()[0].rsplit("/", 1)[0]
    ids1 = [r.request_id for r in first.collect()]
    assert len(set(ids1)) == 3
    second = sinks.append_with_ids(rows, spark, "q", id_col="request_id", path=path)
    ids = [r.request_id for r in second.collect()]
    assert len(ids) == 6 and len(set(ids)) == 6
    assert min(i for i in ids if i not in ids1) > max(ids1)


def test_parse_dims_strict_and_lenient(spark):
    df = spark.createDataFrame([('[{"dimension_type_id":1,"dimension_value":"12"}]',),
                                ('[{"dimension_type_id":1,"dimension_value":"x"}]',)], "t string")
    lenient = [r.d[0].dimension_value for r in df.select(parse_dims("t", lenient=True).alias("d")).collect()]
    assert lenient == [12, None]
    with pytest.raises(Exception):
        df.select(parse_dims("t").alias("d")).collect()
