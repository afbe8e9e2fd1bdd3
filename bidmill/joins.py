"""Join helpers: broadcast only behind a size check.

A side counts as small when its rows times an estimate of their width fit
``max_bytes``. The plan's own statistics answer first (base files and narrow
projections of them need no job); where they say too much, which they do for
joins and aggregates, a partially aggregated ``count`` decides. Nothing is
remembered between calls: a table may have grown. Above the bound the join
stays a shuffle join, where AQE may still broadcast from run-time sizes and
splits skewed keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_BYTES = 64 << 20

_FIXED_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4,
                T.DateType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8,
                T.TimestampNTZType: 8, T.DecimalType: 16}


def row_width(schema: T.StructType) -> int:
    """Estimated bytes of a row; text and nested values count as 64 bytes."""
    return 8 + sum(_FIXED_WIDTH.get(type(f.dataType), 64) for f in schema.fields)


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate (an upper bound for scans and filters)."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size))


def is_small(df: DataFrame, max_bytes: int = DEFAULT_MAX_BYTES) -> bool:
    # the estimate is the size of compressed files: ids in order and texts made
    # of them take 1 or 2 bytes of a file for 80 in memory
    if planned_bytes(df) * 64 <= max_bytes:
        return True
    rows = df.agg(F.count(F.lit(1))).first()[0]
    return rows * row_width(df.schema) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    return F.broadcast(df) if is_small(df, max_bytes) else df


def once_and_repeated(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose key occurs once and is whole, and the others: rows that share
    a key or have a null in it (None if there are none)."""
    null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    others = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") > 1) | null) \
        .select(*[F.col(k).alias(f"_{k}") for k in keys])
    if others.isEmpty():
        return df, None
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return df.join(others, same, "left_anti"), df.join(others, same, "left_semi")
