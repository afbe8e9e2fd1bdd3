"""Price file: header, line parse, merge rules, paging and the round trip."""

from pyspark.sql import functions as F

from bidmill.operators import pricefile as PF


def _lines(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n long, text string")
    return df.select(F.struct(F.lit("f"), F.lit(0), F.col("n")).alias("line_no"), "text")


def test_header(spark):
    h = spark.createDataFrame([(PF.SITE_DOMAIN_HEADER,)], "text string")
    rows = [tuple(r) for r in PF.parse_header(h).orderBy("idx").collect()]
    assert rows == [(0, "site_domain_id2", "Long", False),
                    (1, "strategy_id:bid_price_multiplier", "Array", True)]


def test_line_parse(spark):
    p = PF.parse_price_lines(_lines(spark, ["10\t5:1.2:0.3,6:2.2:0.3"]), 1, [(0, "site_domain_id2")])
    got = sorted((r.strategy_id, r.dimension, r.value, r.multiplier) for r in p.collect())
    assert got == [("5", "site_domain_id2", "10", 1.2), ("6", "site_domain_id2", "10", 2.2)]
    assert {r.baseline for r in PF.merged_baselines(p).collect()} == {0.3}


def test_last_wins_in_a_line(spark):
    p = PF.parse_price_lines(_lines(spark, ["10\t5:1.2:0.3,5:9.9:0.4"]), 1, [(0, "d")])
    assert PF.merged_multipliers(p).first().multiplier == 9.9
    assert PF.merged_baselines(p).first().baseline == 0.4


def test_merge_across_lines(spark):
    p = PF.parse_price_lines(_lines(spark, ["10\t5:1:0.3", "10\t5:2:0.4"]), 1, [(0, "d")])
    assert PF.merged_multipliers(p).first().multiplier == 2.0   # last line wins
    assert PF.merged_baselines(p).first().baseline == 0.3       # first line wins


def _entries(spark, n_strategies):
    rows = [(f"k{k}", s, 1.0 + s / 1000.0 + k, 0.3) for k in range(3) for s in range(n_strategies)]
    return spark.createDataFrame(rows, "key string, strategy_id long, multiplier double, baseline double")


def test_lines_merge_back(spark):
    lines = PF.price_lines(_entries(spark, 25))
    assert lines.count() == 3
    text = lines.select(F.struct(F.lit("f"), F.col("key")).alias("line_no"),
                        F.col("line").alias("text"))
    m = PF.merged_multipliers(PF.parse_price_lines(text, 1, [(0, "d")]))
    got = sorted((r.value, int(r.strategy_id), r.multiplier) for r in m.collect())
    assert got == sorted((f"k{k}", s, 1.0 + s / 1000.0 + k) for k in range(3) for s in range(25))


def test_large_key_is_one_line_of_many_tasks(spark):
    priced = spark.range(50_000).selectExpr(
        "array(named_struct('dimension_value', 'k')) as dims", "id as strategy_id",
        "1.0 + id as multiplier", "0.3D as baseline").withColumn(
            "multiplier", F.col("multiplier").cast("double"))
    setting = "spark.sql.adaptive.coalescePartitions.enabled"   # this much data would be one task's
    spark.conf.set(setting, "false")
    try:
        entries = PF.price_entries(priced.coalesce(1))
        assert entries.select(F.spark_partition_id()).distinct().count() > 1
        line = PF.price_lines(entries).collect()
        assert len(line) == 1 and line[0].line.count(",") == 49_999
    finally:
        spark.conf.set(setting, "true")


def test_small_multiplier_survives_the_file(spark):
    e = spark.createDataFrame([("k", 1, 3e-12, 0.3)],
                              "key string, strategy_id long, multiplier double, baseline double")
    text = PF.price_lines(e).select(F.lit(1).alias("line_no"), F.col("line").alias("text"))
    assert PF.parse_price_lines(text, 1, [(0, "d")]).first().multiplier == 3e-12


def test_two_dimension_columns(spark, tmp_path):
    dims = F.array(F.struct(F.lit("7").alias("dimension_value")),
                   F.struct(F.lit("9").alias("dimension_value")))
    priced = spark.createDataFrame([(1, 2.0, 0.3)],
                                   "strategy_id long, multiplier double, baseline double")
    data, header = str(tmp_path / "d"), str(tmp_path / "h")
    PF.export_price_file(PF.price_lines(PF.price_entries(priced.withColumn("dims", dims))), data)
    PF.write_header(spark, PF.header_for(["site_domain_id2", "city_id"]), header)
    out = PF.merged_multipliers(PF.read_price_file(spark, data, header)).collect()
    assert sorted((r.dimension, r.value, r.multiplier) for r in out) == [
        ("city_id", "9", 2.0), ("site_domain_id2", "7", 2.0)]


def test_part_numbers_order_lines_beyond_five_digits(spark, tmp_path):
    for part, value in (("part-99999", 1.0), ("part-100000", 2.0)):
        (tmp_path / f"{part}-x.txt").write_text(f"k\t1:{value}:0.3\n")
    parsed = PF.parse_price_lines(PF.read_lines(spark, str(tmp_path)), 1, [(0, "d")])
    assert PF.merged_multipliers(parsed).first().multiplier == 2.0


def test_file_round_trip(spark, tmp_path):
    e = _entries(spark, 6)
    data, header = str(tmp_path / "data"), str(tmp_path / "header")
    PF.export_price_file(PF.price_lines(e), data)
    PF.write_header(spark, PF.header_for(["site_domain_id2"]), header)
    m = PF.merged_multipliers(PF.read_price_file(spark, data, header))
    assert m.count() == 18
    assert {r.dimension for r in m.collect()} == {"site_domain_id2"}
