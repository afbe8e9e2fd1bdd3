"""Writers and readers for the tables the job keeps.

Written tables live below the shared checkpoint folder (see session.py), so a
lost executor re-reads them instead of recomputing the lineage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidmill.session import scratch_path, setting, shuffles_released


def write_table(df: DataFrame, spark: SparkSession, name: str, fmt: str = "parquet",
                mode: str = "overwrite", partition_by: list[str] | None = None,
                path: str | None = None, **options) -> str:
    path = path or scratch_path(spark, name)
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)
    return path


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str],
                         fmt: str = "parquet", sort_by: list[str] | None = None,
                         clear_stale: bool = False) -> None:
    """K1: dynamic partition overwrite. Only partitions present in ``df`` are
    replaced; an empty ``df`` replaces nothing (the reference's behaviour).
    ``clear_stale=True`` replaces the whole table instead.
    ``sort_by`` orders rows inside each file (O1) without a global sort."""
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    w = out.write.format(fmt).partitionBy(*partition_by).mode("overwrite")
    if not clear_stale:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.save(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)


def read_relational(spark: SparkSession, path: str | None = None, url: str | None = None,
                    dbtable: str | None = None, partition_column: str | None = None,
                    lower: int | None = None, upper: int | None = None,
                    num_partitions: int | None = None, properties: dict | None = None) -> DataFrame:
    """A relational table, parallel over a numeric key when read over JDBC
    (connection details are the caller's options), or its parquet copy."""
    if url is not None:
        r = spark.read.format("jdbc").option("url", url).option("dbtable", dbtable)
        if partition_column is not None:
            r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
                  .option("upperBound", upper).option("numPartitions", num_partitions))
        for k, v in (properties or {}).items():
            r = r.option(k, v)
        return r.load()
    return spark.read.parquet(path)


def append_with_ids(rows: DataFrame, spark: SparkSession, name: str, id_col: str,
                    path: str | None = None) -> DataFrame:
    """Append rows to a table with an increasing surrogate id, read back.

    Ids are the table's current maximum plus ``monotonically_increasing_id``:
    unique and increasing within a run, computed inside each task (no global
    row numbering through one partition); not gap-free. The selected row
    count is observed during the write (A11).
    """
    path = path or scratch_path(spark, name)  # a new table
    if table_exists(spark, path):
        existing = spark.read.parquet(path)
        base = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long")).scalar()
    else:
        base = F.lit(0).cast("long")
    obs = Observation(f"{name}_append")
    stamped = rows.select((base + F.monotonically_increasing_id() + 1).alias(id_col), "*") \
        .observe(obs, F.count(F.lit(1)).alias("rows"))
    with shuffles_released(spark):
        stamped.write.mode("append").parquet(path, compression="zstd")
    out = spark.read.parquet(path)
    out.observed_rows = obs.get.get("rows", 0)  # type: ignore[attr-defined]
    return out


def truncate(df_schema: T.StructType, spark: SparkSession, path: str, fmt: str = "parquet",
             partition_by: list[str] | None = None) -> None:
    """Replace whatever is at ``path`` with an empty table of the schema."""
    w = spark.createDataFrame([], df_schema).write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_json_log(df: DataFrame, path: str, partition_by: list[str] | None = None,
                   mode: str = "append", digits: int = 10,
                   compression: str | None = None, days: str | None = None) -> None:
    """K8: one JSON object per row, doubles rounded to ``digits`` decimals.

    ``days`` names an array of (dt, heads): the row is an object for each of
    the heads (``json_head``), which goes on with the row's other columns."""
    if days is not None:
        own = T.StructType([f for f in df.schema if f.name not in (days, *(partition_by or ()))])
        parts = df.select(_json_tail(own, digits).alias("_tail"), days,
                          *[p for p in partition_by if p in df.columns])
        parts = parts.select("*", F.explode(days).alias("_day")).select("*", "_day.*")
        lines = F.concat(joined("heads", F.concat("_tail", F.lit("\n"))), "_tail")
        write_lines(parts, lines, path, partition_by, mode, compression)
        return
    w = df.select(*_log_columns(df.schema, digits)).write.mode(mode).options(**FAST_GZIP)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path, compression=compression)


def _log_columns(schema: T.StructType, digits: int) -> list[Column]:
    return [F.round(F.col(f.name), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType) else F.col(f.name) for f in schema.fields]


def json_head(schema: T.StructType, digits: int = 10) -> Column:
    """A log object's first columns, the object still open."""
    text = F.to_json(F.struct(*_log_columns(schema, digits)))
    # at least one name, so that what follows begins with a comma
    return F.when(text == "{}", F.lit(f'{{"{schema[0].name}":null')).otherwise(
        F.substring(text, F.lit(1), F.length(text) - 1))


def _json_tail(schema: T.StructType, digits: int) -> Column:
    text = F.to_json(F.struct(*_log_columns(schema, digits)))
    return F.when(text == "{}", F.lit("}")).otherwise(
        F.concat(F.lit(","), F.substring(text, F.lit(2), F.length(text))))


def joined(texts: str, between: Column) -> Column:
    """``array_join`` with a text of the row's own between the array's."""
    return F.call_function("array_join", F.col(texts), between)


FAST_GZIP = {"zlib.compress.level": "BEST_SPEED"}
OPEN_FILES = "64"  # partitions that a task writes side by side; more are sorted first


def write_lines(df: DataFrame, lines: Column, path: str, partition_by: list[str],
                mode: str = "errorifexists", compression: str | None = None,
                alike: bool = True) -> None:
    """Text of one or more whole lines from each row, in the order of the rows:
    they aren't sorted by partition, a task has a file open for each. Lines that
    are much ``alike`` are packed four times as fast at gzip's first level, into
    a quarter more bytes."""
    level = FAST_GZIP if alike else {}
    with setting(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", OPEN_FILES):
        df.select(lines.alias("value"), *partition_by).write.mode(mode) \
            .partitionBy(*partition_by).options(**level).text(path, compression=compression)


def write_delimited(df: DataFrame, path: str, sep: str = "\u0001",
                    compression: str | None = None) -> None:
    """K6: delimited text, no header (complex columns as JSON text first)."""
    cols = [F.to_json(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(f.name)
            for f in df.schema.fields]
    df.select(*cols).write.mode("overwrite").options(**FAST_GZIP).option("sep", sep) \
        .option("header", "false").csv(path, compression=compression)
