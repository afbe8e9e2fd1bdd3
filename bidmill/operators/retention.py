"""Table maintenance: create, repair, list, expire, drop and rename.

Partition names and drop statements are DataFrames. Catalog changes
(``MSCK REPAIR``, ``DROP PARTITION``, ``RENAME``) are metadata operations the
driver issues anyway; the expired partitions go into one ``DROP PARTITION``
statement per chunk of specs, not one statement per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: retention units in hours
# (a month counts as 31 days); other units are rejected.
UNIT_HOURS = {"m": 31 * 24, "d": 24}


def retention_cutoff(run_date: Column, n: int, units: str) -> Column:
    """First dt (yyyyMMdd) to keep when keeping ``n`` units back from run_date."""
    if units not in UNIT_HOURS:
        raise ValueError("units must be 'm' or 'd'")
    days = n * UNIT_HOURS[units] // 24
    return F.date_format(F.date_sub(F.to_date(run_date), days), "yyyyMMdd")


def create_partitioned_table(spark: SparkSession, name: str, ddl: str, partition_cols: list[str],
                             path: str, fmt: str = "json") -> None:
    """An external table over ``path``."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING {fmt} PARTITIONED BY "
              f"({', '.join(partition_cols)}) LOCATION '{path}'")


def repair_table(spark: SparkSession, name: str) -> None:
    """Register partition folders written outside the catalog."""
    spark.sql(f"MSCK REPAIR TABLE {name}")


def list_partitions(spark: SparkSession, name: str) -> DataFrame:
    """Partition names that carry both dt= and algo_id=."""
    p = spark.sql(f"SHOW PARTITIONS {name}")
    return p.where(F.col("partition").contains("dt=") & F.col("partition").contains("algo_id="))


def expired_partitions(parts: DataFrame, cutoff: Column) -> DataFrame:
    """Partitions whose dt is strictly before the cutoff."""
    dt = F.regexp_extract(F.col("partition"), r"dt=([0-9]+)", 1).cast("int")
    return parts.where(dt < cutoff.cast("int"))


def drop_statements(expired: DataFrame, tables: list[str]) -> DataFrame:
    """One ``alter table .. drop if exists partition(..)`` per table and
    expired partition (all tables, where the reference stopped after the first)."""
    spec = F.regexp_replace(F.col("partition"), "/", ",")
    per_table = expired.select(F.explode(F.array(*[F.lit(t) for t in tables])).alias("table_name"),
                               "partition")
    return per_table.select(
        "table_name", "partition",
        F.concat(F.lit("alter table "), F.col("table_name"), F.lit(" drop if exists partition("),
                 spec, F.lit(");")).alias("statement"))


def _spec(partition: str) -> str:
    kv = [p.split("=", 1) for p in partition.split("/")]
    return "PARTITION (" + ", ".join(f"{k}={v}" if v.lstrip("-").isdigit() else f"{k}='{v}'"
                                     for k, v in kv) + ")"


def apply_retention(spark: SparkSession, name: str, expired: DataFrame, chunk: int = 500) -> int:
    """Drop the expired partitions of one table; returns how many."""
    names = [r.partition for r in expired.select("partition").toLocalIterator()]
    for i in range(0, len(names), chunk):
        specs = ", ".join(_spec(p) for p in names[i:i + chunk])
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {specs}")
    return len(names)


def rename_table(spark: SparkSession, old: str, new: str) -> None:
    """K25."""
    spark.sql(f"DROP TABLE IF EXISTS {new}")
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")
