"""Written intermediate tables.

``settle`` cuts lineage by writing a frame to the folder all executors share
and reading it back. Nothing depends on a block that only one executor holds,
so a lost executor costs a re-read, and the copy is columnar, so a later scan
still prunes columns.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
#: Where tables of the catalog are kept; taken when no checkpoint folder is set.
WAREHOUSE_SETTING = "spark.sql.warehouse.dir"
#: Says that a ``file:`` folder is a mount that all machines share, so it is not tried.
SHARED_MOUNT_SETTING = "spark.daymart.sharedMount"
#: (application, folder) of the folders that its executors were seen to share.
_SEEN_SHARED: set[tuple[str, str]] = set()


def _scratch_root(spark: SparkSession) -> str:
    context = spark.sparkContext
    # Executors of local-cluster are processes of their own, as those of any cluster.
    one_process = re.fullmatch(r"local(\[.*\])?", context.master)
    shared = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if not shared and one_process:
        # One process, one machine: a temporary folder is the shared folder.
        context.setCheckpointDir(tempfile.mkdtemp(prefix="daymart-"))
        shared = context.getCheckpointDir()
    # Executors write tables of the catalog, so they reach the folder of these.
    shared = shared or spark.conf.get(WAREHOUSE_SETTING, None)
    if not shared:
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that every executor can reach")
    root = f"{shared.rstrip('/')}/daymart-{context.applicationId}"
    if not one_process and _is_machine_local(spark, shared):
        # A path of one machine by its name may be a mount that all of them share.
        if (context.applicationId, shared) not in _SEEN_SHARED:
            _try_folder(spark, shared, root)
            _SEEN_SHARED.add((context.applicationId, shared))
    return root


def _is_machine_local(spark: SparkSession, path: str) -> bool:
    """Whether a folder is on the disks of one machine; a bare path follows the default store."""
    scheme = urlsplit(path).scheme or urlsplit(spark.conf.get("spark.hadoop.fs.defaultFS", "file:")).scheme
    allowed = spark.conf.get(SHARED_MOUNT_SETTING, "false") == "true"
    return scheme in ("", "file") and not allowed


def _try_folder(spark: SparkSession, shared: str, root: str) -> None:
    """Fail unless tasks find in ``root`` what other tasks wrote there, and the driver lists all of it.

    Tells of the executors that run a task of it, so there are several tasks for each core.
    """
    path = f"{root}/trial-{uuid.uuid4().hex}"
    problem, found = None, 0
    try:
        tasks = 4 * spark.sparkContext.defaultParallelism
        spark.range(0, tasks, 1, tasks).write.parquet(path)
        found = spark.read.schema("id long").parquet(path).distinct().count()
    except Exception as failed:  # whatever a task meets that does not see the folder
        problem, tasks = failed, -1
    if found != tasks:
        raise RuntimeError(
            f"{shared} is a folder that the driver and the executors do not share; set {CHECKPOINT_SETTING} to one"
        ) from problem


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; never one handed out before."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the stored copy."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's settled tables.

    Call it when the results built on them have been written.
    """
    root = _scratch_root(spark)
    try:
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(root)
    except (ImportError, ValueError, OSError):
        # A store that only Spark knows.
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        return
    if system.get_file_info(path).type != fs.FileType.NotFound:
        system.delete_dir(path)
