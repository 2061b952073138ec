"""Where intermediate data may live: only on storage that all executors share."""

from __future__ import annotations

import tempfile
from pyspark.sql import SparkSession

from tidemark.functions.names import unique


#: Of local sessions without a shared folder, by application; the session's settings stay as they are.
_temporary: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``. Only a local
    session without that setting gets a temporary folder."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if context.applicationId not in _temporary:
            _temporary[context.applicationId] = "file:" + tempfile.mkdtemp(prefix="tidemark-")
        folder = _temporary[context.applicationId]
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{unique(purpose)}"


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete one file or folder through the file system it is on."""
    system, target = _file_system(spark, path)
    return system.delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    system, target = _file_system(spark, path)
    return system.exists(target)


def qualified(spark: SparkSession, path: str) -> str:
    """The path as file listings spell it."""
    system, target = _file_system(spark, path)
    return system.makeQualified(target).toString()


def paths_like(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern of the file system, from listing folders."""
    system, target = _file_system(spark, pattern)
    return [status.getPath().toString() for status in system.globStatus(target) or ()]


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder, with the folders above the new place."""
    system, new = _file_system(spark, target)
    system.mkdirs(new.getParent())
    if not system.rename(_file_system(spark, source)[1], new):
        raise OSError(f"cannot move {source} to {target}")


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    system, target = _file_system(spark, path)
    system.create(target, True).close()


def make_folder(spark: SparkSession, path: str) -> None:
    system, target = _file_system(spark, path)
    system.mkdirs(target)
