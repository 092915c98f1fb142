"""The few file-system calls the sinks need, through the Hadoop client the session already uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return bool(fs.exists(target))


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``; empty when it does not exist."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def delete_tree(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    if fs.exists(target):
        fs.delete(target, True)
