"""Trees that are replaced as a whole: written aside, then named by one empty marker file.

``folder/<version>`` holds a tree, ``folder/_versions/<version>`` says that it is complete. The marker is
made after the tree, in one step on any file system, so a reader sees an old tree or the new one,
also while a job writes and after one was killed. Versions sort by name, the last one is current.
"""

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MARKERS = "_versions"


def _files(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, sorted; nothing if there is none."""
    files, folder = _files(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(folder)) if files.exists(folder) else []


def remove(spark: SparkSession, path: str) -> None:
    files, at = _files(spark, path)
    files.delete(at, True)


def new_version() -> str:
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def commit(spark: SparkSession, folder: str, version: str) -> None:
    """Make a written version the current one; nothing happens if it was committed before."""
    files, marker = _files(spark, f"{folder}/{MARKERS}/{version}")
    files.createNewFile(marker)


def versions(spark: SparkSession, folder: str) -> list[str]:
    """Complete versions, the current one last."""
    return [v for v in names(spark, f"{folder}/{MARKERS}") if not v.startswith(".")]


def replace(spark: SparkSession, folder: str, write: Callable[[str], None], keep: int = 2) -> str:
    """Let ``write`` fill a new version and make it current; returns its path.

    The ``keep`` newest complete versions stay, for readers that still read them. What killed jobs
    left goes with the older ones.
    """
    version = new_version()
    write(f"{folder}/{version}")
    commit(spark, folder, version)
    remove_old(spark, folder, keep)
    return f"{folder}/{version}"


def remove_old(spark: SparkSession, folder: str, keep: int = 2) -> None:
    kept = versions(spark, folder)[-keep:]
    for old in [v for v in names(spark, folder) if v != MARKERS and kept and v < kept[0]]:
        remove(spark, f"{folder}/{MARKERS}/{old}")  # first, so that no marker names a part of a tree
        remove(spark, f"{folder}/{old}")


def current(spark: SparkSession, folder: str) -> str:
    """Path of the current version."""
    found = versions(spark, folder)
    if not found:
        raise FileNotFoundError(f"no complete version in {folder}")
    return f"{folder}/{found[-1]}"


def read_current(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(current(spark, folder))
