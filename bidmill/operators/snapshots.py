"""Row edits on snapshot tables (K13-K15): UPDATE and DELETE as projections.

``sources/versions.py`` applies them to the files that hold hits and commits
the result as a new version of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def update_where(df: DataFrame, cond: Column, column: str, value: Column) -> DataFrame:
    """SET column = value WHERE cond; the result keeps the column's type
    (a decimal(10,4) stays decimal(10,4), rounded half up)."""
    dtype = df.schema[column].dataType
    return df.withColumn(column, F.when(cond, value.cast(dtype)).otherwise(F.col(column)))


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """DELETE WHERE cond; rows where cond is NULL stay."""
    return df.where(~F.coalesce(cond, F.lit(False)))


def insert_values(df: DataFrame, rows: list[tuple]) -> DataFrame:
    """INSERT VALUES (literal rows appended to a table)."""
    return df.unionByName(df.sparkSession.createDataFrame(rows, df.schema))
