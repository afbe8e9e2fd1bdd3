"""Raw input tables: one parquet file per table under a scale-factor folder."""

from __future__ import annotations

from collections import OrderedDict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


# reading a parquet footer for the schema is a Spark job of its own, so the
# last few hundred schemas are kept, by path and file version
_SCHEMAS: OrderedDict[tuple[str, str], T.StructType] = OrderedDict()
_KEPT_SCHEMAS = 256


def parquet_at(spark: SparkSession, path: str) -> DataFrame:
    key = (path, file_version(spark, path))
    schema = _SCHEMAS.get(key)
    if schema is None:
        schema = _SCHEMAS[key] = spark.read.parquet(path).schema
        if len(_SCHEMAS) > _KEPT_SCHEMAS:
            _SCHEMAS.popitem(last=False)
    return spark.read.schema(schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; callers select the columns they need so the scan
    is pruned (ReadSchema) and their filters reach the reader."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return parquet_at(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def file_version(spark: SparkSession, path: str) -> str:
    """Length and change time of a file, or of all files of a folder, from
    Spark's own file system layer (any store that Spark reads)."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(place):
        return "absent"
    own = fs.getFileStatus(place)
    files = fs.listStatus(place) if own.isDirectory() else [own]
    return ",".join(sorted(f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}"
                           for f in files))


def version(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = TABLES) -> str:
    """The versions of some tables under ``sf_dir`` (cache key part)."""
    return "|".join(f"{n}={file_version(spark, f'{sf_dir.rstrip("/")}/{n}.parquet')}"
                    for n in names)
