"""Intermediate data: work tables in the shared folder, and cached frames."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def join_path(base: str, *parts: str) -> str:
    """Path below ``base``, kept as text so that URI schemes survive."""
    return "/".join([base.rstrip("/"), *parts])


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate data, below the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of this machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidewatch-")
    return join_path(root, f"{name}-{uuid.uuid4().hex}")


def _hadoop_path(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system its path names."""
    location, files = _hadoop_path(spark, path)
    files.delete(location, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text as one file, replacing what is there, on whatever file system."""
    location, files = _hadoop_path(spark, path)
    files.delete(location, True)
    out = files.create(location, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text under another name first, so that readers find all of it or none."""
    write_text(spark, f"{path}.part", text)
    location, files = _hadoop_path(spark, path)
    files.delete(location, False)
    if not files.rename(_hadoop_path(spark, f"{path}.part")[0], location):
        raise OSError(f"could not rename {path}.part")


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file as a whole."""
    location, files = _hadoop_path(spark, path)
    source = files.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def folder_exists(spark: SparkSession, path: str) -> bool:
    location, files = _hadoop_path(spark, path)
    return files.exists(location)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path."""
    location, files = _hadoop_path(spark, path)
    return [entry.getPath().getName() for entry in files.listStatus(location)
            if entry.isDirectory()]


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly in a folder."""
    location, files = _hadoop_path(spark, path)
    return [entry.getPath().getName() for entry in files.listStatus(location) if entry.isFile()]


class WorkTables:
    """Frames written out and read back, so that what follows reads columns and
    partitions of a table instead of running the plan again, also after executors
    were lost."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._paths: list[str] = []

    def write(self, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        path = work_folder(self._spark, name)
        self._paths.append(path)
        df.write.partitionBy(*partition_by).parquet(path)
        return self._spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def drop(self) -> None:
        """Delete the tables; frames that read them stop working."""
        for path in self._paths:
            delete_folder(self._spark, path)
        self._paths.clear()


def cached(df: DataFrame) -> DataFrame:
    """Keep a frame that several results read in memory, spilling to disk."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
