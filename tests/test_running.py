"""The skew-safe running sum equals a window running sum, hot key included."""

import pandas as pd
from pyspark.sql import functions as F

from bidmill.operators.running import running_sum


def test_running_sum_matches_window_with_hot_key(spark):
    rows = [(0, i, float(i % 7 + 1)) for i in range(3000)]            # one hot key
    rows += [(k, i, float((k * i) % 5)) for k in range(1, 60) for i in range(k % 9 + 1)]
    rows += [(None, i, 1.0) for i in range(2000)]              # NULL key group, several partitions
    df = spark.createDataFrame(rows, "k long, o long, v double").repartition(5)
    out = running_sum(df, "k", [F.col("v").desc(), F.col("o").asc()], "v", "cum", num_partitions=16)
    got = out.toPandas().sort_values(["k", "o"], na_position="first").reset_index(drop=True)
    pdf = pd.DataFrame(rows, columns=["k", "o", "v"])
    pdf["kk"] = pdf["k"].fillna(-1)
    pdf = pdf.sort_values(["kk", "v", "o"], ascending=[True, False, True])
    pdf["cum"] = pdf.groupby("kk")["v"].cumsum()
    exp = pdf.sort_values(["k", "o"], na_position="first").reset_index(drop=True)
    assert len(got) == len(exp)
    assert (got["cum"].to_numpy() == exp["cum"].to_numpy()).all()
    # the hot key really was spread over several partitions
    parts = df.repartitionByRange(16, "k", F.col("v").desc(), "o") \
        .where(F.col("k") == 0).select(F.spark_partition_id()).distinct().count()
    assert parts > 1
