"""Session set-up and the shared work folder."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  They can be changed while a session runs, so a
# session built elsewhere can be brought in line too.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot never compiles methods above 8000 bytes of byte code; a wide
    # projection fused into one such method would run interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def settle(spark: SparkSession) -> SparkSession:
    """Bring an existing session to UTC with adaptive execution."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "tarmac", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session; `conf` keys use underscores for dots (`spark_ui_enabled="false"`)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return settle(builder.getOrCreate())


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder for intermediate tables, below `spark.checkpoint.dir`.

    The setting names storage all executors share.  Only a local session may go
    without it; there the warehouse folder does.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tarmac-work"
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


@contextmanager
def file_by_file(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside read each file in a task of its own, so that rows keep the layout of files.

    A file is not packed with others, as opening it counts as much as a whole split; one
    above the size of a split is read in pieces.
    """
    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def measured(df: DataFrame, label: str, packed: bool = False) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    The plan is then cut at a real table: a lost executor costs no recomputation,
    and the planner knows the true size, so it broadcasts the table where it is
    below `spark.sql.autoBroadcastJoinThreshold` and shuffles it where it is not.
    `packed` is for large tables: zstd in place of the session's codec.
    """
    path = scratch(df.sparkSession, label)
    (df.write.option("compression", "zstd") if packed else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of jobs whose results are stored, which it does when their plans are collected."""
    gc.collect()
    spark._jvm.System.gc()


def forget(stored: DataFrame) -> None:
    """Delete a stored table that has been read for the last time."""
    for folder in {f.rpartition("/")[0] for f in stored.inputFiles()}:
        delete(stored.sparkSession, folder)


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
