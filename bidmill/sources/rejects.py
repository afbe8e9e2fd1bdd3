"""Text scans with a reject channel.

A score file or a price file is parsed once: every line, or list entry, gets
its typed columns and the first reason against it, if there is one. ``split``
stores both kinds side by side and reads back the good rows, with the types of
the plain scans, and the rejects with file, position, text and reason. A strict
scan raises on the first reject instead of going on without it. Nothing is
dropped silently: good rows plus rejects are all the lines.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidmill.functions.text import DIMS_TYPE
from bidmill.operators import pricefile as PF
from bidmill.session import scratch_path, setting

REJECT_COLUMNS = ("file", "block", "seq", "pos", "text", "reason")


class BadInput(ValueError):
    """A strict scan met a line that doesn't parse."""


def _lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Lines with their place: file, start of the block that a task reads, and
    an increasing number inside it."""
    return spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.col("value").alias("text"))


def _first(reasons: list[tuple[Column, str]]) -> Column:
    return F.coalesce(*[F.when(bad, F.lit(text)) for bad, text in reasons],
                      F.lit(None).cast("string"))


def _unlike(text: Column, dtype: T.DataType) -> Column:
    """A value that is there and isn't of the type."""
    return text.isNotNull() & text.try_cast(dtype).isNull()


def checked_scores(spark: SparkSession, schema: T.StructType, *paths: str, sep: str = "\u0001",
                   dims_col: str = "dimension_structs", key_col: str = "strategy_id") -> DataFrame:
    """S1 + F1: score file lines with the columns of ``schema`` and ``reason``."""
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in schema]
                       + [T.StructField("_corrupt", T.StringType())])
    fields = F.from_csv("text", raw.simpleString()[len("struct<"):-1].replace(":", " "),
                        {"sep": sep, "columnNameOfCorruptRecord": "_corrupt"})
    rows = _lines(spark, *paths).withColumn("_f", fields)
    dims = F.from_json(F.col(f"_f.{dims_col}"), DIMS_TYPE)
    numbers = F.coalesce(F.forall(dims, lambda d: d["dimension_type_id"].isNotNull()
                                  & d["dimension_value"].try_cast("long").isNotNull()), F.lit(False))
    reasons = [(F.col("_f._corrupt").isNotNull(), f"{len(schema)} fields expected")]
    reasons += [(_unlike(F.col(f"_f.{f.name}"), f.dataType),
                 f"{f.name}: not {f.dataType.simpleString()}")
                for f in schema if not isinstance(f.dataType, T.StringType)]
    reasons += [(F.col(f"_f.{key_col}").isNull(), f"{key_col}: missing"),
                (F.col(f"_f.{dims_col}").isNotNull() & ~numbers, f"{dims_col}: no list of numbers")]
    return rows.select(
        "file", "block", "seq", F.lit(0).alias("pos"), "text", _first(reasons).alias("reason"),
        *[F.col(f"_f.{f.name}").try_cast(f.dataType).alias(f.name) for f in schema])


def checked_price_lines(spark: SparkSession, header_path: str, *paths: str) -> DataFrame:
    """S2 + F4: price file entries by dimension (strategy_id, dimension, value,
    multiplier, baseline) and ``reason``; a line that has not the header's
    columns is one reject. ``text`` is the line or the entry."""
    arr, dims = PF.header_layout(spark, header_path)
    width = len(dims) + 1
    parts = F.split(F.col("text"), "\t")
    lines = _lines(spark, *paths).where(F.trim("text") != "").withColumn(
        "_whole", F.size(parts) == width)
    # cut below the generator: once for each line, not for each of its entries
    by_line = lines.select(
        "file", "block", "seq", "_whole", F.when(F.col("_whole"), F.array(*[
            F.struct(F.lit(name).alias("dimension"), F.get(parts, i).alias("value"))
            for i, name in dims])).alias("_dims"),
        F.when(F.col("_whole"), F.split(F.get(parts, arr), ","))
        .otherwise(F.array("text")).alias("_entries"))
    entries = by_line.select("file", "block", "seq", "_whole", "_dims",
                             F.posexplode("_entries").alias("pos", "text"))
    e = F.split(F.col("text"), ":")
    fields = entries.withColumns({"strategy_id": F.get(e, 0), "_m": F.get(e, 1),
                                  "_b": F.get(e, 2), "_n": F.size(e)})
    reason = _first([(~F.col("_whole"), f"{width} columns expected"),
                     (F.col("_n") != 3, "strategy:multiplier:baseline expected"),
                     (F.col("strategy_id") == "", "strategy_id: missing"),
                     (F.col("_m").try_cast("double").isNull(), "multiplier: not double"),
                     (F.col("_b").try_cast("double").isNull(), "baseline: not double")])
    checked = fields.withColumn("reason", reason)
    return checked.select(
        "file", "block", "seq", "pos", "text", "reason", "strategy_id",
        F.explode(F.when(F.col("reason").isNull(), F.col("_dims")).otherwise(
            F.array(F.lit(None).cast(checked.schema["_dims"].dataType.elementType)))).alias("_d"),
        F.col("_m").try_cast("double").alias("multiplier"),
        F.col("_b").try_cast("double").alias("baseline")).select(
            "*", "_d.dimension", "_d.value").drop("_d")


def split(checked: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects) of a checked scan, parsed and stored once."""
    spark, path = checked.sparkSession, scratch_path(checked.sparkSession, "checked")
    bad = F.col("reason").isNotNull()
    # a good row is its columns: its line isn't stored a second time. Both kinds
    # are written side by side, so the rows aren't sorted by kind
    kept = checked.select(*[F.when(bad, F.col(c)).alias(c) if c in REJECT_COLUMNS else F.col(c)
                            for c in checked.columns], bad.alias("bad"))
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "2"):
        kept.write.partitionBy("bad").parquet(path, compression="zstd")
    stored = spark.read.schema(T.StructType([*checked.schema.fields, T.StructField(
        "bad", T.BooleanType())])).parquet(path)
    rejects = stored.where("bad").select(*REJECT_COLUMNS)
    if strict:
        first = rejects.head(1)
        if first:
            raise BadInput(f"{first[0].file}: {first[0].reason}: {first[0].text!r}")
    good = [c for c in checked.columns if c not in REJECT_COLUMNS]
    return stored.where("not bad").select(*good), rejects


def reasons(*channels: DataFrame) -> DataFrame:
    """How many lines each reason took."""
    return reduce(DataFrame.unionByName, channels).groupBy("reason").agg(
        F.count(F.lit(1)).alias("lines"))
