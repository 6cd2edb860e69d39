"""Tables kept in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_own_folder: list[str] = []
#: Paths of the tables that this process has kept and not yet removed.
_kept: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only where that is unset and all runs in one process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _own_folder:
            _own_folder.append(tempfile.mkdtemp(prefix="dosegrid-"))
        found = _own_folder[0]
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def noted(path: str) -> str:
    """The path, which `clear` removes."""
    _kept.append(path)
    return path


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written as a table in the shared folder and read back: what follows sees the same rows whatever executors are lost. The table stays until `clear`, as results that are not yet computed may read it."""
    spark, path = df.sparkSession, noted(fresh_path(df.sparkSession, name))
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")  # shuffle files go as soon as the table is there
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> int:
    """Remove all tables that were kept on the way to results, when these have been written or collected; how many there were."""
    n = len(_kept)
    for path in _kept:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    _kept.clear()
    return n
