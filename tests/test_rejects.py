"""Scans with a reject channel."""

import pytest
from pyspark.sql import functions as F

from bidmill.operators import pricefile as PF
from bidmill.plans.tables_q import SCORES_SCHEMA
from bidmill.sources import rejects as RJ
from bidmill.sources import sinks

DIMS = '[{"dimension_type_id":1,"dimension_value":"12"}]'


def _file(spark, tmp_path, lines, name="lines"):
    path = f"file://{tmp_path}/{name}"
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def _row(*fields):
    return "\u0001".join(fields)


BAD = [(_row("1", "-1"), "7 fields expected"),
       (_row("1", "-1", "[]", "x", "1", "2", "3"), "probability_score: not double"),
       (_row("1", "a", "[]", "x", "1", "2", "3"), "algo_id: not int"),        # the first reason
       (_row("", "-1", "[]", "0.5", "1", "2", "3"), "strategy_id: missing"),
       (_row("1", "-1", "{}x", "0.5", "1", "2", "3"), "dimension_structs: no list of numbers"),
       (_row("1", "-1", "[]", "0.5", "1", "2", "3", "4"), "7 fields expected"),
       (_row("99999999999999999999", "-1", "[]", "0.5", "1", "2", "3"), "strategy_id: not bigint")]


def test_scores_split_into_good_and_rejects(spark, tmp_path):
    good = [(5, -1, DIMS, 0.25, 1.5, 20240517, 7), (6, 2, DIMS, float("nan"), None, None, None)]
    path = f"file://{tmp_path}/scores"
    sinks.write_delimited(spark.createDataFrame(good, SCORES_SCHEMA), path)
    bad = _file(spark, tmp_path, [x for x, _ in BAD])
    rows, rejects = RJ.split(RJ.checked_scores(spark, SCORES_SCHEMA, path, bad))
    assert rows.schema.simpleString() == SCORES_SCHEMA.simpleString()
    assert sorted(map(str, rows.collect())) == sorted(
        map(str, spark.createDataFrame(good, SCORES_SCHEMA).collect()))
    got = rejects.orderBy("seq").collect()
    assert sorted((r.text, r.reason) for r in got) == sorted(BAD)
    assert all(f"{tmp_path}/lines/part-" in r.file and r.block == 0 for r in got)
    assert len({r.seq for r in got}) == len(BAD)
    assert {r.reason: r.lines for r in RJ.reasons(rejects).collect()}["7 fields expected"] == 2
    with pytest.raises(RJ.BadInput, match="expected|not|missing|list"):
        RJ.split(RJ.checked_scores(spark, SCORES_SCHEMA, path, bad), strict=True)
    RJ.split(RJ.checked_scores(spark, SCORES_SCHEMA, path), strict=True)


def test_price_lines_split_into_good_and_rejects(spark, tmp_path):
    header = f"file://{tmp_path}/header"
    PF.write_header(spark, PF.header_for(["a", "b"]), header)
    lines = ["k1\tv1\t7:1.5:0.3,8:x:0.3,9:2:0.3", "k2\tv2\t7:1.5", "k3 v3", "k4\tv4\t:1:2,5:1:z",
             "", "k5\tv5\t"]
    path = _file(spark, tmp_path, lines)
    rows, rejects = RJ.split(RJ.checked_price_lines(spark, header, path))
    assert sorted(tuple(r) for r in rows.select("strategy_id", "dimension", "value", "multiplier",
                                                 "baseline").collect()) == [
        ("7", "a", "k1", 1.5, 0.3), ("7", "b", "v1", 1.5, 0.3),
        ("9", "a", "k1", 2.0, 0.3), ("9", "b", "v1", 2.0, 0.3)]
    assert sorted((r.text, r.pos, r.reason) for r in rejects.collect()) == [
        ("", 0, "strategy:multiplier:baseline expected"),
        ("5:1:z", 1, "baseline: not double"), ("7:1.5", 0, "strategy:multiplier:baseline expected"),
        ("8:x:0.3", 1, "multiplier: not double"), (":1:2", 0, "strategy_id: missing"),
        ("k3 v3", 0, "3 columns expected")]


def test_an_empty_file_has_neither(spark, tmp_path):
    rows, rejects = RJ.split(RJ.checked_scores(spark, SCORES_SCHEMA, _file(spark, tmp_path, [])))
    assert rows.count() == 0 and rejects.count() == 0
    assert rejects.select(F.col("reason")).collect() == []
