"""Writing intermediate tables that several later steps read."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; unset, a folder in the session's warehouse.

    A warehouse in a local folder is shared in local mode only; elsewhere it is refused.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        warehouse = spark.conf.get(WAREHOUSE_DIR)
        local = spark.sparkContext.master.split("[")[0] == "local"
        if not local and warehouse.split(":", 1)[0] in ("file", warehouse):
            raise ValueError(f"set {CHECKPOINT_DIR}: executors may not share the warehouse in {warehouse}")
        folder = f"{warehouse}/_checkpoints"
    return folder.rstrip("/")


def staging_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_folder(spark)}/staged/{spark.sparkContext.applicationId}"


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(target)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the staging folder, deleted with whatever it holds when the application ends."""
    path = f"{staging_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _delete_at_exit(spark, path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a columnar table in the shared folder and read it back.

    This cuts the lineage: a lost executor costs its running tasks only, and every later step reads
    just the columns it needs, with known sizes. The application's tables go when it ends, or
    earlier by ``release``.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for frame in frames:
        spark = frame.sparkSession
        folder = staging_folder(spark).split(":", 1)[-1].lstrip("/")
        for file in frame.inputFiles()[:1]:
            path = file.rsplit("/", 1)[0]
            if folder not in path:
                raise ValueError(f"{path} is not a staged table")
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            conf = spark.sparkContext._jsc.hadoopConfiguration()
            target.getFileSystem(conf).delete(target, True)


def drop_shuffles(spark: SparkSession) -> None:
    """Have executors delete the shuffle files of finished jobs now, not when the driver next collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
