"""Ordered running sum inside groups that stays balanced when one group is huge.

``sum(v) over (partition by k order by o rows unbounded preceding)`` puts a
whole group into one task. Here the rows are range-partitioned on (k, o), so a
hot group is spread over many partitions in its own order; each partition sums
locally (a window over partition and key), and a carry table with one row per
partition adds the totals of the earlier partitions that hold the same group.
The carry table is bounded by the number of partitions, so it is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidmill.session import written


def running_sum(df: DataFrame, key: str, order: list[Column], value: str, out: str,
                num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = running sum of ``value`` per ``key`` in ``order`` (rows
    frame); rows with a NULL key form one group, a NULL or NaN value adds 0."""
    spark = df.sparkSession
    ranged = (df.repartitionByRange(num_partitions, F.col(key), *order) if num_partitions
              else df.repartitionByRange(F.col(key), *order))
    # written once: all uses below see the same partition numbers
    placed = written(ranged.withColumn("_pid", F.spark_partition_id()), "running-sum")
    amount = F.coalesce(F.nanvl(F.col(value).cast("double"), F.lit(0.0)), F.lit(0.0))
    inside = (Window.partitionBy("_pid", key).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = placed.withColumn("_lcum", F.sum(amount).over(inside))

    # the part of each key that lies in each partition: a few keys per
    # partition continue from the one before, only those need a carry
    parts = placed.groupBy("_pid", key).agg(F.sum(amount).alias("_sum"))
    edges = placed.groupBy("_pid").agg(F.min(F.struct(F.col(key))).alias("_first"),
                                       F.max(F.struct(F.col(key))).alias("_last"))
    ends = edges.select("_pid", F.col(f"_first.{key}").alias("_first_key"),
                        F.col(f"_last.{key}").alias("_last_key"))
    # a partition's last key and its sum there; a key that fills partitions p..q
    # is the last key of p..q-1, and of q unless others follow it there
    tails = ends.join(parts, (ends["_pid"] == parts["_pid"])
                      & ends["_last_key"].eqNullSafe(parts[key])).select(
        ends["_pid"], "_last_key", "_sum")
    through = tails.withColumn("_through", F.sum("_sum").over(
        Window.partitionBy("_last_key").orderBy("_pid")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # one row for each partition, in order: does its first key go on from the
    # partition before?
    prior = F.lag(F.struct("_last_key", "_through")).over(Window.orderBy("_pid"))
    before = (ends.select("_pid", "_first_key").join(
        through.select("_pid", "_last_key", "_through"), "_pid").withColumn("_prior", prior)
        .where(F.col("_prior").isNotNull()
               & F.col("_prior._last_key").eqNullSafe(F.col("_first_key")))
        .select("_pid", F.col("_first_key").alias("_key"),
                F.col("_prior._through").alias("_carry")))
    carry = F.broadcast(before)
    joined = local.join(carry, (local["_pid"] == carry["_pid"])
                        & local[key].eqNullSafe(carry["_key"]), "left")
    return joined.select(*[local[c] for c in df.columns],
                         (local["_lcum"] + F.coalesce("_carry", F.lit(0.0))).alias(out))
