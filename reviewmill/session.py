"""Session helpers: the shared folder for written intermediates, and lineage cuts."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
WAREHOUSE_SETTING = "spark.sql.warehouse.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session's configuration.

    ``spark.checkpoint.dir`` comes first; without it, a folder set on the context, then a sub-folder of
    the warehouse. A warehouse on a local disk is refused where the executors run on other machines.
    """
    context = spark.sparkContext
    folder, current = spark.conf.get(CHECKPOINT_SETTING, None), context.getCheckpointDir()
    if folder is None:
        if current is not None:
            return current
        warehouse = spark.conf.get(WAREHOUSE_SETTING, "spark-warehouse")
        on_disk = ":" not in warehouse or warehouse.startswith("file:")
        if on_disk and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors can reach")
        folder = f"{warehouse.rstrip('/')}/_intermediate"
    if current is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and go on from there.

    A lost executor then costs no recomputation, and later reads take only the columns they need.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy_disks(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of what no one refers to any more.

    Spark does that when the driver's memory is tidied up, which else happens by chance; what a finished query
    refers to goes with the second time only, on both sides.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that was written by :func:`scratch_path`, wherever it is stored."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def written_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path`` that a write has completed; none where there is no such path."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(target):
        return []
    folders = [status.getPath() for status in files.listStatus(target) if status.isDirectory()]
    return [folder.getName() for folder in folders if files.exists(hadoop.Path(folder, "_SUCCESS"))]
