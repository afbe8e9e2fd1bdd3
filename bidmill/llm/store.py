"""Tables cut out of the lineage, and document keys.

``stored`` writes a DataFrame as parquet below ``spark.checkpoint.dir`` (a
folder that all executors share) and returns a scan of it. The shuffle files
behind the write are released when it ends, so an operator's disk need is its
largest step, not the sum of its steps. A lost executor costs only the tasks of
the running step.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidmill.session import ensure_checkpoint_dir, shuffles_released

# text NULL counts as empty, doc_id NULL as smaller than every other id
NO_ID = -(2 ** 63)
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-tables/{name}-{uuid.uuid4().hex}"
    with shuffles_released(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that no later step reads."""
    for df in tables:
        path = getattr(df, "_stored_at", None)
        if path:
            jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState()
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf.newHadoopConf()).delete(place, True)


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def id_of(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


def running_total(df: DataFrame, order: list[str], value: str, out: str,
                  name: str) -> tuple[DataFrame, DataFrame]:
    """Add ``out``: the sum of ``value`` over all rows before this one in
    ``order``. Returns the table and the small per-partition totals.

    Rows are range-partitioned on the order and summed inside each partition,
    then shifted by the totals of the earlier partitions (one row each), so no
    window spans the whole table. ``order`` should identify rows: equal rows
    stay in one partition.
    """
    n = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = stored(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()),
                    name)
    totals = stored(ranged.groupBy("_part").agg(F.sum(value).alias("_total")), name + "-totals")
    # one row for each of the n partitions
    before = totals.select("_part", F.coalesce(F.sum("_total").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_before"))
    local = F.coalesce(F.sum(value).over(
        Window.partitionBy("_part").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    summed = (ranged.withColumn(out, local).join(F.broadcast(before), "_part")
              .withColumn(out, F.col(out) + F.col("_before")).drop("_part", "_before"))
    return summed, ranged
