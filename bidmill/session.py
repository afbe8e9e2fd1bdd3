"""Session settings and the shared scratch location.

Everything that writes an intermediate table (the sink queries, the streaming
sink, lineage cuts) goes under the folder named by ``spark.checkpoint.dir``.
On a cluster that is a shared file system set by the operator; a folder of our
own is made only on a local master that names none (tests, a laptop).
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Session settings the plans are written for. AQE re-plans joins at run time
# (broadcast when a side turns out small, split skewed partitions) and
# coalesces the shuffle partitions to the advisory size.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# the one setting whose default would change results
NEEDED_CONF = {"spark.sql.session.timeZone": "UTC"}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "bidmill", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", "16g")
    # checkpoint files of DataFrames that are gone are deleted by the cleaner
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Set what results depend on, unless the caller's session has set it."""
    given = spark.sparkContext.getConf()
    for key, value in NEEDED_CONF.items():
        if not given.contains(key):
            spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir`` and make sure
    DataFrame ``checkpoint()`` writes below it. Without one, a local master
    gets a temporary folder; any other master is an error, since executors on
    other machines would not see it."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            root = current.rsplit("/", 1)[0]
        elif sc.master.startswith("local[") or sc.master == "local":
            root = tempfile.mkdtemp(prefix="bidmill-ckpt-")
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.conf.set("spark.checkpoint.dir", root)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for one written table below the shared checkpoint folder:
    no call rewrites what an earlier call's lazy result reads."""
    return f"{ensure_checkpoint_dir(spark)}/bidmill-tables/{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


_BATCH_BYTES, _MOST_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def bound_batches(spark: SparkSession) -> None:
    """Whole texts go to Python a few MB at a time, unless the caller's session
    says how much: an executor holds each batch several times over, in the JVM
    and in the worker. It is set for good, as results are run after their
    operator returns."""
    if spark.conf.get(_BATCH_BYTES, None) is None:
        spark.conf.set(_BATCH_BYTES, _MOST_BYTES)


def shuffles_released(spark: SparkSession):
    """The shuffle files behind a write are deleted when it ends, not when the
    driver's garbage collector finds their plan."""
    return setting(spark, _CLEANUP, "true")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as parquet in a folder of its own and read back:
    the lineage is cut, and a join on it has its exchange right below."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_released(spark):
        df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)
